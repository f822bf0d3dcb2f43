"""Golden records -> rows of the relational tables.

Two rule sets exist.  ``bulk`` takes every complete record and writes '' for null.
``strict`` rejects records without names or sex, derives the full name and fills
address defaults.  ``json`` (golden JSON files) is ``strict`` without the rejections and
with the bulk reading of ``sex``.  All functions are projections and filters on golden
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldweft.functions.payload import sex_scalar
from goldweft.functions.text import build_fullname, clean_street, filled, text

# Address types and the defaults of the strict rules.
HOME, WORK = "Home", "Work"
UNKNOWN_CITY = "Unknown"
NO_IP = "0.0.0.0"

#: Rule sets that build the full name from its parts and default the address fields.
PARTS = ("strict", "json")

_STREET = "`company address`"


def skip_missing_passport(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    """Records that have an id; the strict rules also refuse an empty one."""
    return golden.filter(filled("_id") if mode in PARTS else "_id IS NOT NULL")


def person_columns(mode: str = "bulk") -> dict[str, str]:
    """Table columns as SQL over golden columns."""
    parts = mode in PARTS
    return {
        "passport": "_id",
        "name": text("name"),
        "last_name": text("last_name"),
        "full_name": build_fullname("name", "last_name") if parts else text("fullname"),
        "sex": text(sex_scalar(mode="strict" if mode == "strict" else "bulk")),
        "email": text("email"),
        "phone": text("telfnumber"),
    }


def has_home(mode: str = "bulk") -> str:
    if mode in PARTS:
        return filled("address")
    return f"({filled('address')} OR {filled('city')} OR {filled('IPv4')})"


def has_work_address(mode: str = "bulk") -> str:
    """Tested on the raw street: one of line breaks only still counts."""
    return f"({filled(_STREET)} AND {filled('city')})" if mode in PARTS else filled(_STREET)


def home_columns(mode: str = "bulk") -> dict[str, str]:
    if mode in PARTS:
        return {
            "street_name": text("address"),
            "city": f"coalesce(city, '{UNKNOWN_CITY}')",
            "ip_address": f"CASE WHEN {filled('IPv4')} THEN IPv4 ELSE '{NO_IP}' END",
        }
    return {
        "street_name": clean_street("address"),
        "city": text("city"),
        "ip_address": text("IPv4"),
    }


def work_address_columns(mode: str = "bulk") -> dict[str, str]:
    if mode in PARTS:
        return {"street_name": text(_STREET), "city": text("city"), "ip_address": f"'{NO_IP}'"}
    return {"street_name": clean_street(_STREET), "city": "''", "ip_address": "''"}


def has_bank() -> str:
    return f"({filled('IBAN')} OR {filled('salary')})"


def bank_columns() -> dict[str, str]:
    return {"iban": text("IBAN"), "salary": text("salary")}


def has_work(mode: str = "bulk") -> str:
    if mode in PARTS:
        return filled("company")
    fields = ("company", "job", "company_telfnumber", "company_email")
    return f"({' OR '.join(filled(f) for f in fields)})"


def work_columns() -> dict[str, str]:
    return {
        "company": text("company"),
        "position": text("job"),
        "phone": text("company_telfnumber"),
        "email": text("company_email"),
    }


def aliased(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def person_projection(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    return golden.selectExpr(*aliased(person_columns(mode)))


def home_address_projection(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    return golden.filter(has_home(mode)).selectExpr(
        "_id AS passport", f"'{HOME}' AS type", *aliased(home_columns(mode))
    )


def work_address_projection(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    return golden.filter(has_work_address(mode)).selectExpr(
        "_id AS passport", f"'{WORK}' AS type", *aliased(work_address_columns(mode))
    )


def address_union(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    """Home and work rows, without duplicates removed."""
    return home_address_projection(golden, mode).unionByName(
        work_address_projection(golden, mode)
    )


def bank_projection(golden: DataFrame) -> DataFrame:
    return golden.filter(has_bank()).selectExpr("_id AS passport", *aliased(bank_columns()))


def work_projection(golden: DataFrame, mode: str = "bulk") -> DataFrame:
    return golden.filter(has_work(mode)).selectExpr("_id AS passport", *aliased(work_columns()))


def strict_row_validation(golden: DataFrame) -> DataFrame:
    """Add ``reject_reason``: why the strict rules refuse a record; null for a good one."""
    return golden.withColumn(
        "reject_reason",
        F.expr(
            f"CASE WHEN NOT {filled('_id')} THEN 'missing_passport'"
            f" WHEN NOT {filled('name')} OR NOT {filled('last_name')} THEN 'missing_name'"
            f" WHEN NOT {filled(sex_scalar(mode='strict'))} THEN 'missing_sex' END"
        ),
    )


def passport_fallback(golden: DataFrame) -> DataFrame:
    """:func:`strict_row_validation` of records whose ``passport`` stands in for a missing
    ``_id``.  ``repeated`` marks all acceptable records of a passport but one: those with an
    ``_id`` of their own come first, then the order of a hash of the record.
    """
    own = filled("_id")
    columns = [F.col(f"`{c}`") for c in golden.columns]
    named = golden.withColumns(
        {
            "_id": F.expr(f"CASE WHEN {own} THEN _id ELSE passport END"),
            "_order": F.struct(F.expr(f"NOT {own}"), F.xxhash64(*columns)),
        }
    )
    judged = strict_row_validation(named)
    # Refused records are not compared; each goes to a group of its own.
    group = "CASE WHEN reject_reason IS NULL THEN _id ELSE CAST(_order AS string) END"
    rank = F.row_number().over(
        Window.partitionBy(F.expr(group), F.col("reject_reason").isNull()).orderBy("_order")
    )
    repeated = F.col("reject_reason").isNull() & (F.col("_rank") > 1)
    return judged.withColumn("_rank", rank).withColumn("repeated", repeated).drop("_order", "_rank")
