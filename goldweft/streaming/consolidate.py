"""Periodic consolidation and load over the bronze folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from goldweft import schemas as S
from goldweft.plans.run import run_batch
from goldweft.sources.store import Store

# Fixed value: how often the pipeline runs.
EVERY = "3 minutes"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave to the query of a checkpoint; another checkpoint has another."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def start(
    spark: SparkSession,
    bronze_path: str,
    store: Store,
    checkpoint: str,
    trigger: dict | None = None,
    full_every: int = 0,
    source_options: dict | None = None,
    archive: str | None = None,
    **options,
) -> StreamingQuery:
    """Run :func:`run_batch` on every batch of new bronze files.

    ``full_every`` rewrites the golden state whole at every n-th batch; the other
    batches write only what changed.  ``options`` go to ``run_batch``.

    With ``archive`` files go there once the batch after theirs begins, so neither bronze nor
    its listing grows with the past; messages that a run could not use are in the store's
    ``quarantine``.  Bronze must then come from ``ingest.ingest_split`` (``bronze_path`` is
    ``ingest.bronze_folder(...)``): Spark takes no files out of a file sink's folder.
    """
    reader = spark.readStream.schema(S.BRONZE)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    for key, value in (source_options or {}).items():
        reader = reader.option(key, value)

    def each(batch, batch_id):
        full = bool(full_every) and batch_id > 0 and batch_id % full_every == 0
        query = query_id(spark, checkpoint)
        run_batch(store, batch, batch_id, full=full, query=query, **options)

    return (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": EVERY}))
        .start()
    )
