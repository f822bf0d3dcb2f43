"""Foreign keys and existence checks against the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def person_ids(person: DataFrame) -> DataFrame:
    """One id per passport; of repeated passports the greatest id."""
    return person.groupBy("passport").agg(F.max("id").alias("person_id"))


def _hashed(df: DataFrame) -> DataFrame:
    """Joining on the key and its hash makes Spark shuffle the aggregated side anew.

    Both inputs are then plain exchanges, which is what adaptive execution needs to
    split a passport that holds a large share of the rows.
    """
    return df.withColumn("passport_hash", F.xxhash64("passport"))


def resolve_person_fk(rows: DataFrame, person: DataFrame) -> DataFrame:
    """Add ``person_id`` by passport; rows without a person are left out."""
    on = ["passport", "passport_hash"]
    return _hashed(rows).join(_hashed(person_ids(person)), on).drop("passport_hash")


def unresolved_persons(rows: DataFrame, person: DataFrame) -> DataFrame:
    """The rows :func:`resolve_person_fk` leaves out."""
    known = person.select("passport").distinct()
    on = ["passport", "passport_hash"]
    return _hashed(rows).join(_hashed(known), on, "left_anti").drop("passport_hash")


def resolve_address_fk(persons: DataFrame, addresses: DataFrame) -> DataFrame:
    """Link rows ``address_id, person_id, type``.

    ``persons``: passport, person_id.  ``addresses``: id, passport, type; of repeated
    (passport, type) pairs the greatest id.
    """
    latest = addresses.groupBy("passport", "type").agg(F.max("id").alias("address_id"))
    return persons.join(latest, "passport").select("address_id", "person_id", "type")


def skip_existing_persons(
    incoming: DataFrame, person: DataFrame, position: str | None = None
) -> DataFrame:
    """Incoming records whose passport has no person yet.

    With ``position``, repeats inside the batch are skipped too: the first one stays.
    """
    if position:
        fields = [c for c in incoming.columns if c != position]
        first = incoming.groupBy("_id").agg(
            F.min_by(F.struct(*[F.col(f"`{c}`") for c in fields]), position).alias("row")
        )
        incoming = first.select("row.*")
    # Distinct costs no exchange of its own: it uses the one the join needs.
    known = person.select(F.col("passport").alias("_id")).distinct()
    return incoming.join(known, "_id", "left_anti")


def semi_consumed(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id is in ``ids``: a semi join where others send literal id lists."""
    return rows.join(ids.select(key), key, "left_semi")
