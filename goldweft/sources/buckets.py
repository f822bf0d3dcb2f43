"""Tables that grow by deltas, laid out by a hash of their key.

A table has a fixed number of buckets.  A run appends the rows it has for a bucket below
``state/<table>/batch_id=<n>/bucket=<b>``, and the commit row lists, for each bucket, the
batches that make it up; readers merge them and open no other bucket.  A bucket of
:data:`DELTAS` batches is rewritten whole by the next run that touches it, so what a read
has to merge stays bounded.  Nothing is changed in place: an uncommitted run leaves only
folders that no list names, and its repetition overwrites them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Batches of a bucket before it is merged into one.
DELTAS = 8

Parts = dict[str, dict[int, list[int]]]
Merge = Callable[[DataFrame], DataFrame]


def by_key(*shapes: str) -> Merge:
    """Rows of one key as one, with the greatest of each column in ``shapes``."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(*[F.max(s).alias(s) for s in shapes])

    return merge


def newest(key: str, version: str = "version") -> Merge:
    """The row of each key with the greatest version."""

    def merge(rows: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        return rows.groupBy(F.col(key).alias("merged_key")).agg(F.max_by(row, version).alias("row")).select("row.*")

    return merge


def distinct(rows: DataFrame) -> DataFrame:
    return rows.distinct()


class Buckets:
    """The tables of one store as a commit lists them, and what a run adds to them."""

    def __init__(self, spark: SparkSession, path: str, parts: Parts, size: int):
        self.spark, self.path, self.size = spark, path, size
        self.parts = {name: {b: list(batches) for b, batches in rows.items()} for name, rows in parts.items()}

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(self.size)).cast("int")

    def of(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets of ``rows``; as many numbers as there are buckets come to the driver."""
        return sorted(r.bucket for r in rows.select(self.bucket(key).alias("bucket")).distinct().collect())

    def _folder(self, name: str, batch: int, bucket: int) -> str:
        return f"{self.path}/{name}/batch_id={batch}/bucket={bucket}"

    def raw(self, name: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        """All rows of the given buckets (of all, if None), not merged."""
        listed = self.parts.get(name, {})
        wanted = listed if buckets is None else [b for b in buckets if b in listed]
        paths = [self._folder(name, batch, b) for b in wanted for batch in listed[b]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, name: str, schema: T.StructType, merge: Merge, buckets: list[int] | None = None) -> DataFrame:
        return merge(self.raw(name, schema, buckets))

    def add(self, name: str, batch: int, rows: DataFrame, key: str, merge: Merge) -> list[int]:
        """Write ``rows`` as a delta of ``batch``; buckets with many deltas are merged with
        them.  Gives the buckets written."""
        touched = self.of(rows, key)
        if not touched:
            return touched
        listed = self.parts.setdefault(name, {})
        full = [b for b in touched if len(listed.get(b, [])) >= DELTAS]
        if full:
            # One row a key either way: merging the other buckets' new rows changes nothing.
            rows = merge(rows.unionByName(self.raw(name, rows.schema, full)))
        # Rebalanced, so that a bucket of many rows gets several files and small ones few tasks.
        spread = rows.withColumn("bucket", self.bucket(key)).hint("rebalance", "bucket")
        spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch_id={batch}")
        for b in touched:
            listed[b] = [batch] if b in full else [*listed.get(b, []), batch]
        return touched
