"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft.sources.staging import materialize

#: The six ASCII characters that separate words: space and U+0009 to U+000D.
SPACES = r"[ \t\n\x0B\f\r]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; cuts the lineage."""
    return materialize(df, name)


def words(text: str | Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def count_words(text: str | Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


#: Bytes of text for each bucket that one Python worker holds at once.
BUCKET_BYTES = 128 << 20


def buckets(docs: DataFrame, text: str = "text", per: int | None = None) -> int:
    """Into how many buckets the entries of these texts are dealt: one for ``per`` bytes
    (:data:`BUCKET_BYTES`), at least as many as the session has shuffle partitions.  One number
    comes to the driver."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // (per or BUCKET_BYTES)))


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column in UTF-8, null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, one row at least.

    Bounds what a task keeps in memory at once, however long a batch's texts are.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)
