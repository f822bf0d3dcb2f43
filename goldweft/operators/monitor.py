"""Counts, bounds and health figures of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft.operators import classify as C
from goldweft.operators import golden as G

# Messages per throughput block, rows of the latest-messages report.
BLOCK = 100
LATEST = 3


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy().agg(F.count("*").alias(name))


def one_row(parts: list[DataFrame]) -> DataFrame:
    """One-row DataFrames with different columns as one row, without a cross join."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    return together.groupBy().agg(*[F.sum(c).alias(c) for c in together.columns])


def collection_status(bronze: DataFrame, golden: DataFrame) -> DataFrame:
    """``collection``, ``documents`` for both collections."""
    return _count(bronze, "documents").select(F.lit("raw").alias("collection"), "documents").union(
        _count(golden, "documents").select(F.lit("golden").alias("collection"), "documents")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    names = {"person": "persons", "bank": "banks", "work": "works", "address": "addresses"}
    return one_row([_count(tables[t], n) for t, n in names.items()])


def pending_gate(bronze: DataFrame, golden: DataFrame) -> DataFrame:
    """Whether there is anything to process; without raw data the golden count is 0."""
    counts = one_row([_count(bronze, "raw_count"), _count(golden, "golden_count")])
    return counts.select(
        (F.col("raw_count") > 0).alias("has_new_data"),
        "raw_count",
        F.when(F.col("raw_count") > 0, F.col("golden_count")).otherwise(0).alias("golden_count"),
    )


def ingest_bounds(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy().agg(
        F.min("inserted_at").alias("first_inserted"), F.max("inserted_at").alias("last_inserted")
    )


def latest_messages(bronze: DataFrame, n: int = LATEST) -> DataFrame:
    """The newest documents; sorted per task, only ``n`` rows per task meet."""
    meta = F.col("kafka_metadata")
    return (
        bronze.orderBy(F.desc("inserted_at"), F.desc(meta["offset"]), F.desc(meta["partition"]))
        .limit(n)
        .select(meta["offset"].alias("offset"), "data", "inserted_at")
    )


def throughput_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Elapsed time and messages per second for every ``block`` offsets of a partition."""
    seconds = F.col("elapsed_us") / F.lit(1e6)
    return (
        rows.groupBy("partition", F.floor(F.col("offset") / block).alias("block"))
        .agg(
            F.count("*").alias("messages"),
            (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))).alias(
                "elapsed_us"
            ),
        )
        .select(
            "partition",
            "block",
            "messages",
            "elapsed_us",
            F.when(F.col("elapsed_us") > 0, F.col("messages") / seconds).alias("msg_per_sec"),
        )
    )


def pipeline_health(bronze: DataFrame, as_of: Column, stale_after_seconds: int = 3600) -> DataFrame:
    """Totals, age of the last insert, insertion rate, projected volume and freshness."""
    figures = bronze.groupBy().agg(
        F.count("*").alias("total_documents"),
        F.min(F.unix_micros("inserted_at")).alias("first_us"),
        F.max(F.unix_micros("inserted_at")).alias("last_us"),
    )
    minutes = (F.col("last_us") - F.col("first_us")) / F.lit(6e7)
    rate = F.when(minutes > 0, F.col("total_documents") / minutes)
    age = (F.unix_micros(as_of) - F.col("last_us")) / F.lit(1e6)
    return figures.select(
        "total_documents",
        age.alias("last_insert_age_sec"),
        rate.alias("docs_per_min"),
        (rate * F.lit(1440.0)).alias("estimated_daily_volume"),
        F.when(age <= stale_after_seconds, "FRESH").otherwise("STALE").alias("data_status"),
    )



def consolidation_stats(
    classified: DataFrame, unmatched: DataFrame, new: DataFrame, old: DataFrame
) -> DataFrame:
    """One-row summary of a run.  Every known passport counts as updated, since its
    stamp changes; consumed messages are the deleted ones."""
    known = old.select(F.col("_id").alias("old_id"))
    hits = (
        new.select("_id")
        .join(known, F.col("_id") == F.col("old_id"), "left")
        .groupBy()
        .agg(
            F.count_if(F.col("old_id").isNull()).alias("golden_records_created"),
            F.count_if(F.col("old_id").isNotNull()).alias("golden_records_updated"),
        )
    )
    return _stats(classified, unmatched, new, hits)


def dry_run_stats(classified: DataFrame, unmatched: DataFrame, new: DataFrame) -> DataFrame:
    """The summary without writes: all complete records count as created."""
    hits = new.groupBy().agg(
        F.count("*").alias("golden_records_created"),
        F.lit(0).cast("bigint").alias("golden_records_updated"),
    )
    return _stats(classified, unmatched, new, hits)


def _stats(
    classified: DataFrame, unmatched: DataFrame, new: DataFrame, hits: DataFrame
) -> DataFrame:
    return one_row(
        [
            C.class_counts(classified).withColumnRenamed("consumed_records", "raw_records_deleted"),
            hits,
            _count(unmatched, "unmatched_records"),
            G.namesake_conflicts(new),
        ]
    )
