"""Where pipeline runs keep their results: partitioned parquet plus a commit table.

Every run writes below ``<table>/batch_id=<n>`` and then appends one row to the commit
table; readers only see committed batches, so golden records, tables and statistics of
a run appear together.  Running a batch again overwrites its own folders, or does
nothing if the batch is committed.

Golden batches hold only the records a run touched.  The current state is the newest
row per passport, so a small run writes little however large the store is.  A batch
may also be written whole (``full``), which moves the reading start forward.

A store of retained runs keeps its tables in buckets instead (``sources.buckets``); the
commit row lists which batches make up each bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweft import schemas as S
from goldweft.plans import retained
from goldweft.sources.buckets import Buckets

_COMMIT = (
    "batch_id bigint, base bigint, ids map<string,bigint>, query string, query_batch bigint,"
    " buckets int, parts map<string,map<string,array<bigint>>>"
)


class Store:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        """``buckets``: into how many the tables of retained runs are cut, once and for all."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets

    # -- commits: a handful of rows, one per run ---------------------------------

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_COMMIT).json(f"{self.path}/commits")
        except Exception as error:  # the folder appears with the first commit
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def last_commit(self):
        """The newest commit row, or None."""
        commits = self._commits()
        return None if commits is None else commits.orderBy(F.desc("batch_id")).first()

    def is_committed(self, batch_id: int) -> bool:
        last = self.last_commit()
        return last is not None and last.batch_id >= batch_id

    def number_of(self, batch_id: int, query: str | None = None) -> int | None:
        """The number under which to write a batch, None if it is committed already.

        Batches of a streaming query are known by the query's id and their number in it, so
        a new checkpoint, which counts from 0 again, goes on above the last commit.  Without
        a query the caller's numbers count, which must grow.
        """
        if query is None:
            return None if self.is_committed(batch_id) else batch_id
        commits = self._commits()
        if commits is None:
            return 0
        own = F.col("query") == query
        seen = commits.agg(
            F.max("batch_id").alias("last"),
            F.max(F.when(own, F.col("query_batch"))).alias("newest"),
            F.count_if(own & (F.col("query_batch") == batch_id)).alias("same"),
        ).first()
        if seen.same:
            return None
        if seen.newest is not None and seen.newest > batch_id:
            raise ValueError(f"batch {batch_id} of query {query} is missing, {seen.newest} is committed")
        return seen.last + 1

    def commit(
        self,
        batch_id: int,
        ids: dict[str, int],
        full: bool = False,
        query: str | None = None,
        query_batch: int | None = None,
        state: Buckets | None = None,
    ) -> None:
        last = self.last_commit()
        base = batch_id if full or last is None else last.base
        size = parts = None
        if state is not None:
            size = state.size
            parts = {name: {str(b): batches for b, batches in rows.items()} for name, rows in state.parts.items()}
        row = self.spark.createDataFrame([(batch_id, base, ids, query, query_batch, size, parts)], _COMMIT)
        row.coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def state(self, last=None) -> Buckets:
        """The bucketed tables as of the last commit (or of the commit row given)."""
        last = last or self.last_commit()
        if last is None or last.buckets is None:
            return Buckets(self.spark, f"{self.path}/state", {}, self.buckets)
        parts = {name: {int(b): batches for b, batches in rows.items()} for name, rows in last.parts.items()}
        return Buckets(self.spark, f"{self.path}/state", parts, last.buckets)

    def is_retained(self) -> bool:
        last = self.last_commit()
        return last is not None and last.buckets is not None

    # -- tables ------------------------------------------------------------------

    def write(self, name: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def read(self, name: str, schema, since: int | None = None) -> DataFrame:
        """Rows of all committed batches (from ``since`` on), with ``batch_id``."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        last = self.last_commit()
        if last is None:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).parquet(f"{self.path}/{name}")
        rows = rows.filter(F.col("batch_id") <= last.batch_id)
        return rows if since is None else rows.filter(F.col("batch_id") >= since)

    def table(self, name: str) -> DataFrame:
        last = self.last_commit()
        if last is not None and last.buckets is not None:
            return retained.table(retained.current(self.state(last)), name)
        return self.read(f"tables/{name}", S.TABLES[name]).drop("batch_id")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in S.TABLES}

    def _golden_rows(self, *columns: str) -> DataFrame:
        last = self.last_commit()
        rows = self.read("golden", S.GOLDEN, since=None if last is None else last.base)
        return rows.select(*columns) if columns else rows

    def golden(self, of: DataFrame | None = None) -> DataFrame:
        """Current golden records; with ``of`` only those whose ``_id`` is in it, picked
        before anything else is shuffled or compared."""
        last = self.last_commit()
        if last is not None and last.buckets is not None:
            current = retained.current(self.state(last)).select(*S.GOLDEN.fieldNames())
            return current if of is None else current.join(of.select("_id"), "_id", "left_semi")
        rows = self._golden_rows()
        if of is not None:
            rows = rows.join(of.select("_id"), "_id", "left_semi")
        fields = F.struct(*[f"`{c}`" for c in S.GOLDEN.fieldNames()])
        newest = rows.groupBy(F.col("_id").alias("passport")).agg(
            F.max_by(fields, "batch_id").alias("row")
        )
        return newest.select("row.*")

    def passports(self) -> DataFrame:
        """``_id`` of every golden record; reads no other column."""
        if self.is_retained():
            return self.golden().select("_id")
        return self._golden_rows("_id").distinct()

    def last_ids(self) -> dict[str, int]:
        """Greatest surrogate id per table so far."""
        last = self.last_commit()
        return dict(last.ids) if last is not None and last.ids else {}
