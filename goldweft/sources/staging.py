"""Intermediate tables that several later jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldweft.session import scratch_path


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The copy cuts the lineage and outlives executors; being parquet, later readers
    still prune columns and push filters down.  Without ``folder`` it goes to a fresh
    scratch path; below ``folder`` it replaces the previous copy of that name, so
    repeated runs do not pile up.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
