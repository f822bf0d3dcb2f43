"""Inputs that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import keys as K
from goldweft.operators import latest as L
from goldweft.operators import link as LK
from goldweft.operators import surrogate as U
from goldweft.operators.decode import decode_envelope
from goldweft.plans import consolidate as E
from goldweft.plans.load import build_tables
from goldweft.sources import feed
from goldweft.sources.kafka import as_kafka_rows, documents_as_kafka_rows
from goldweft.sources.staging import materialize

# The stamp that queries inject, and messages that arrive in the second batch.
STAMP = "2024-01-01T00:00:00"
LATE_NAME = '"name":"MACHINERY"'
REPEATED_SEX = '"sex":["F"]'
SECOND_BATCH_SEQ = 3_000_000_000


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.messages(spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(messages(spark, sf_dir))


def dealt_classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Classified messages with their ``task``, and the number of tasks."""
    dealt, tasks = feed.dealt_messages(spark, sf_dir)
    return C.classify(dealt), tasks


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt, tasks = dealt_classified(spark, sf_dir)
    return L.latest_by_key(dealt, "seq", tasks)


def stamp():
    return F.lit(STAMP)


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt, tasks = feed.dealt_messages(spark, sf_dir)
    return E.consolidate(dealt, "seq", stamp(), tasks)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden projection of every passport, complete or not."""
    return G.golden_projection(E.link(latest(spark, sf_dir), complete_only=False), stamp())


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.by_passport(latest(spark, sf_dir)).filter(LK.COMPLETE_IDENTITY)


def old_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_of(messages(spark, sf_dir))


def _first_of(m: DataFrame) -> DataFrame:
    return m.filter(
        (F.col("seq") < SECOND_BATCH_SEQ) & ~F.col("data").contains(LATE_NAME)
    )


def new_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything later, the late people, and a repetition of some personal messages."""
    return _second_of(messages(spark, sf_dir))


def _second_of(m: DataFrame) -> DataFrame:
    return m.filter(
        (F.col("seq") >= SECOND_BATCH_SEQ)
        | F.col("data").contains(LATE_NAME)
        | F.col("data").contains(REPEATED_SEX)
    )


def old_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden records of the first batch; those with a city count as uploaded."""
    dealt, tasks = feed.dealt_messages(spark, sf_dir)
    g = E.consolidate(_first_of(dealt), "seq", stamp(), tasks)
    return g.withColumn("uploaded_2_SQL", F.col("city").isNotNull())


def new_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt, tasks = feed.dealt_messages(spark, sf_dir)
    return E.consolidate(_second_of(dealt), "seq", stamp(), tasks)


def kafka_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events and plain documents as one Kafka topic set."""
    events = as_kafka_rows(feed.read_table(spark, sf_dir, "events"))
    documents = documents_as_kafka_rows(feed.read_table(spark, sf_dir, "documents"))
    return events.unionByName(documents)


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the events, inserted at their own time."""
    rows = as_kafka_rows(feed.read_table(spark, sf_dir, "events"))
    return decode_envelope(rows, F.col("timestamp"))


def feed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message feed in bronze form."""
    return messages(spark, sf_dir).select(
        F.struct(
            F.lit("people").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("seq").alias("offset"),
            F.lit(None).cast("bigint").alias("timestamp"),
            F.lit(None).cast("string").alias("key"),
        ).alias("kafka_metadata"),
        "data",
        F.expr("TIMESTAMP '2024-01-01 00:00:00Z' AS inserted_at"),
    )


def relational(spark: SparkSession, sf_dir: str, all_banks: bool = False) -> dict[str, DataFrame]:
    """Tables of all golden records; with ``all_banks`` one bank row per bank message."""
    tables = build_tables(materialize(golden(spark, sf_dir), "golden"))
    if all_banks:
        keyed = classified(spark, sf_dir).filter(f"shape = '{S.BANK}' AND link_key IS NOT NULL")
        rows = keyed.selectExpr(
            "link_key AS passport", "seq", "doc.IBAN AS iban", "doc.salary AS salary"
        )
        banks = K.resolve_person_fk(rows, tables["person"])
        numbered = U.assign_surrogate_ids(materialize(banks, "banks"), "passport", ("seq",))
        tables["bank"] = numbered.select("id", "person_id", "iban", "salary")
    return tables
