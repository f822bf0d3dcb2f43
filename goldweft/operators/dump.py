"""Relational tables -> one flat row per person, bank, work and address combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.operators.rows import HOME, WORK


def _covering(keys: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``right`` plus an empty row for every key it lacks, found on the bare keys.

    A left outer join cannot be split on its right side, where one person may own a
    large share of all rows.  Against the covered table the left join is an inner join,
    which adaptive execution may split on either side.
    """
    present = right.select(key).distinct()
    missing = keys.join(present, key, "left_anti")
    return right.unionByName(missing, allowMissingColumns=True)


def _person_keys(person: DataFrame) -> DataFrame:
    return person.select(F.col("id").alias("person_id"))


def _bank(bank: DataFrame) -> DataFrame:
    return bank.select(
        "person_id", F.col("iban").alias("bank_iban"), F.col("salary").alias("bank_salary")
    )


def _work(work: DataFrame) -> DataFrame:
    return work.select(
        "person_id",
        F.col("company").alias("work_company"),
        F.col("position").alias("work_position"),
        F.col("phone").alias("work_phone"),
        F.col("email").alias("work_email"),
    )


def _located(tables: dict[str, DataFrame], kind: str, columns: dict[str, str]) -> DataFrame:
    """Addresses of one kind by person.  The kind is tested on the association before
    the join; an association without its address keeps its row with nulls."""
    links = tables["person_address"].filter(F.col("type") == kind)
    address = tables["address"].select(
        F.col("id").alias("address_id"), *[F.col(c).alias(a) for c, a in columns.items()]
    )
    return links.join(address, "address_id", "left").select("person_id", *columns.values())


# Column names of the flat data set.
PERSON_COLUMNS = {
    "passport": "person_passport",
    "name": "person_name",
    "last_name": "person_last_name",
    "full_name": "person_full_name",
    "sex": "person_sex",
    "email": "person_email",
    "phone": "person_phone",
}
HOME_COLUMNS = {"street_name": "home_street", "city": "home_city", "ip_address": "home_ip"}
WORK_COLUMNS = {"street_name": "work_street", "city": "work_city"}
FLAT_COLUMNS = (
    *PERSON_COLUMNS.values(),
    "bank_iban",
    "bank_salary",
    "work_company",
    "work_position",
    "work_phone",
    "work_email",
    *HOME_COLUMNS.values(),
    *WORK_COLUMNS.values(),
)


def _persons(person: DataFrame) -> DataFrame:
    return person.select(
        F.col("id").alias("person_id"),
        *[F.col(c).alias(a) for c, a in PERSON_COLUMNS.items()],
    )


def _fan_out(person: DataFrame, *parts: DataFrame) -> DataFrame:
    """Persons with every part, all by person id: the ids are unique in ``person``."""
    keys = _person_keys(person)
    out = _persons(person)
    for part in parts:
        out = out.join(_covering(keys, part, "person_id"), "person_id")
    return out


def dump_bank(tables: dict[str, DataFrame]) -> DataFrame:
    joined = _fan_out(tables["person"], _bank(tables["bank"]))
    return joined.select("person_passport", "bank_iban", "bank_salary")


def dump_work(tables: dict[str, DataFrame]) -> DataFrame:
    joined = _fan_out(tables["person"], _work(tables["work"]))
    return joined.select(
        "person_passport", "work_company", "work_position", "work_phone", "work_email"
    )


def dump_home(tables: dict[str, DataFrame]) -> DataFrame:
    joined = _fan_out(tables["person"], _located(tables, HOME, HOME_COLUMNS))
    return joined.select("person_passport", *HOME_COLUMNS.values())


def flat_person_dataset(tables: dict[str, DataFrame]) -> DataFrame:
    """The 18-column flat data set; a work address has no IP column.

    All joins use the person id, so the person side is shuffled once.
    """
    joined = _fan_out(
        tables["person"],
        _bank(tables["bank"]),
        _work(tables["work"]),
        _located(tables, HOME, HOME_COLUMNS),
        _located(tables, WORK, WORK_COLUMNS),
    )
    return joined.select(*FLAT_COLUMNS)

