"""Column names and types shared by all stages."""

from __future__ import annotations

from pyspark.sql import types as T

# Message shapes and the order in which provenance lists them.
PERSONAL, BANK, LOCATION, NETWORK, PROFESSIONAL = (
    "personal",
    "bank",
    "location",
    "network",
    "professional",
)
SOURCES = (PERSONAL, BANK, LOCATION, NETWORK, PROFESSIONAL)
UNKNOWN = "unknown"
EMPTY = "empty"
NON_OBJECT = "non_object"

#: Rows as a Kafka source delivers them.
KAFKA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

KAFKA_METADATA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("key", T.StringType()),
    ]
)

#: ``data`` stays JSON text: shapes are told apart by which keys are present.
BRONZE = T.StructType(
    [
        T.StructField("kafka_metadata", KAFKA_METADATA),
        T.StructField("data", T.StringType()),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)

# The JSON keys of each shape that end up in the golden record.
SHAPE_FIELDS = {
    PERSONAL: ("name", "last_name", "sex", "email", "telfnumber"),
    BANK: ("IBAN", "salary"),
    LOCATION: ("fullname", "city", "address"),
    NETWORK: ("IPv4",),
    PROFESSIONAL: ("company", "company address", "company_telfnumber", "company_email", "job"),
}

# Names and order of the golden fields.
#: The 20 fields of a golden record (``_id`` is the passport) and two helper columns:
#: ``n_sources`` lets the completeness filter reach the parquet scan, and
#: ``sex_is_scalar`` remembers that ``sex`` arrived as plain text, not as a list.
GOLDEN = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("consolidated_at", T.StringType()),
        T.StructField("data_sources", T.ArrayType(T.StringType())),
        T.StructField("uploaded_2_SQL", T.BooleanType()),
        T.StructField("name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("sex", T.ArrayType(T.StringType())),
        T.StructField("email", T.StringType()),
        T.StructField("telfnumber", T.StringType()),
        T.StructField("fullname", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("IPv4", T.StringType()),
        T.StructField("IBAN", T.StringType()),
        T.StructField("salary", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("company address", T.StringType()),
        T.StructField("company_telfnumber", T.StringType()),
        T.StructField("company_email", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("n_sources", T.IntegerType()),
        T.StructField("sex_is_scalar", T.BooleanType()),
    ]
)
#: Golden fields that carry message content (used by the coalescing merge).
GOLDEN_CONTENT = tuple(
    f
    for f in GOLDEN.fieldNames()
    if f not in ("_id", "consolidated_at", "data_sources", "uploaded_2_SQL", "n_sources")
)

# Tables and their columns.
#: Relational tables.
TABLES = {
    "person": "id bigint, passport string, name string, last_name string, full_name string, "
    "sex string, email string, phone string",
    "address": "id bigint, street_name string, city string, ip_address string",
    "person_address": "address_id bigint, person_id bigint, type string",
    "bank": "id bigint, person_id bigint, iban string, salary string",
    "work": "id bigint, person_id bigint, company string, position string, phone string, "
    "email string",
}
