"""Dense surrogate ids without a global sort.

Rows are ordered by the MD5 of their business key, then by the key.  The first four
hex digits of the MD5 cut that order into at most 65,536 even buckets, so an id is
``base + rows in earlier buckets + rank in the bucket``.  Everything is a function of
the key: no sampled range bounds, and a re-run or a lost executor gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweft.sources.staging import materialize

# Hex digits per bucket name; 16 ** 4 buckets bound the broadcast below.
BUCKET_DIGITS = 4


def running_ids(
    df: DataFrame, key: str, counts: dict[str, str], tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Add one bigint column per entry of ``counts`` (name -> SQL of a number): the running
    total over the whole of ``df`` in MD5 order, the row itself included.

    All counters share one shuffle.
    """
    counted = df.selectExpr(
        "*",
        f"md5(CAST({key} AS binary)) AS _md5",
        *[f"CAST({sql} AS bigint) AS _n_{name}" for name, sql in counts.items()],
    ).selectExpr("*", f"substring(_md5, 1, {BUCKET_DIGITS}) AS _bucket")
    if tie_break:
        return _split_ids(df, counted, key, counts, tie_break)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 rows, whatever the size of df: one task and a broadcast are safe.
    offsets = (
        counted.groupBy("_bucket")
        .agg(*[F.sum(f"_n_{name}").alias(f"_t_{name}") for name in counts])
        .select(
            "_bucket",
            *[
                F.coalesce(F.sum(f"_t_{name}").over(earlier), F.lit(0)).alias(f"_o_{name}")
                for name in counts
            ],
        )
    )
    so_far = (
        Window.partitionBy("_bucket")
        .orderBy("_md5", key, *tie_break)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.select(
        "*", *[F.sum(f"_n_{name}").over(so_far).alias(f"_r_{name}") for name in counts]
    )
    return ranked.join(F.broadcast(offsets), "_bucket").selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"_o_{name} + _r_{name} AS {name}" for name in counts]
    )


def _split_ids(
    df: DataFrame, counted: DataFrame, key: str, counts: dict[str, str], tie_break: tuple[str, ...]
) -> DataFrame:
    """:func:`running_ids` for keys that repeat, one of which may hold a large share of all
    rows.

    A range partitioning by (bucket, key, tie-break) cuts such a key as well.  Its bounds
    are sampled, so the parts are numbered and written before totals are taken: the ids do
    not depend on where the cuts lie.  One row of totals per part goes through one task.
    """
    order = ("_md5", key, *tie_break)
    spark = df.sparkSession
    parts = materialize(
        counted.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()),
        "numbered",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(*[F.sum(f"_n_{name}").alias(f"_t_{name}") for name in counts])
        .select(
            "_part",
            *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in counts],
        )
    )
    so_far = (
        Window.partitionBy("_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = parts.select(
        "*", *[F.sum(f"_n_{name}").over(so_far).alias(f"_r_{name}") for name in counts]
    )
    # As many rows as shuffle partitions.
    return ranked.join(F.broadcast(offsets), "_part").selectExpr(
        *[f"`{c}`" for c in df.columns], *[f"_o_{name} + _r_{name} AS {name}" for name in counts]
    )


def max_id(table: DataFrame, column: str = "id") -> Column:
    """Greatest id in a table, 0 for an empty one, as a scalar subquery."""
    return table.groupBy().agg(F.coalesce(F.max(column), F.lit(0).cast("bigint"))).scalar()


def assign_surrogate_ids(
    df: DataFrame,
    key: str,
    tie_break: tuple[str, ...] = (),
    base: Column | int = 0,
    id_column: str = "id",
) -> DataFrame:
    """Number the rows ``base + 1 .. base + n`` in MD5 order of the business key."""
    base = F.lit(base) if isinstance(base, int) else base
    numbered = running_ids(df, key, {id_column: "1"}, tie_break)
    return numbered.withColumn(id_column, F.col(id_column) + base)
