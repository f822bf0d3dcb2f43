"""Streaming ingestion: Kafka rows -> bronze."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from goldweft import schemas as S
from goldweft.operators.decode import KEPT, decode_all, decode_envelope, decode_rejects

#: Offsets of a topic partition that share one piece of deduplication state.
OFFSET_BLOCK = 1_000_000


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet folder.  The checkpoint holds the offsets and the
    file sink writes every batch exactly once, so a restart goes on where it stopped."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def ingest(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Decode Kafka rows and append them to bronze."""
    return start(decode_envelope(rows), path, checkpoint, trigger)


def ingest_rejects(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append what cannot be decoded to a quarantine folder."""
    return start(decode_rejects(rows), path, checkpoint, trigger)


def ingest_split(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Bronze and quarantine in one pass: a batch is read and decoded once and written below
    ``path/batch=<n>/reason=<reason>``.

    A batch that was written whole is not written again when the query repeats it after a
    crash.  Unlike the folder of :func:`ingest`, consumed files may be taken out of this one
    (see ``streaming.consolidate.start``).
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if not _is_written(batch.sparkSession, folder):
            decode_all(batch).write.mode("overwrite").partitionBy("reason").parquet(folder)

    return (
        rows.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _is_written(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote ``folder`` came to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def bronze_folder(path: str) -> str:
    """The decodable messages below ``path`` of :func:`ingest_split`, as a path pattern."""
    return f"{path}/batch=*/reason={KEPT}"


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """Everything :func:`ingest_split` has written: bronze columns, ``value``, ``reason``."""
    schema = T.StructType([*S.BRONZE.fields]).add("value", "binary").add("reason", "string")
    return spark.read.schema(schema.add("batch", "long")).parquet(path).drop("batch")


def _join_runs(
    starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive offsets after new ones have come, none of which is in a run."""
    starts, ends = np.concatenate([starts, offsets]), np.concatenate([ends, offsets])
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    gap = starts[1:] > ends[:-1] + 1
    return starts[np.append(True, gap)], ends[np.append(gap, True)]


def unseen(
    key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """The rows whose offset is in no run of the state yet, which they then join."""
    starts, ends = (np.array(side, "int64") for side in (state.get if state.exists else ([], [])))
    for chunk in chunks:
        # A missing offset is in a block of its own, where -1 stands for it.
        chunk = chunk[~chunk["offset"].duplicated()]
        offsets = chunk["offset"].fillna(-1).to_numpy("int64")
        run = np.searchsorted(starts, offsets, side="right") - 1
        new = np.ones(len(offsets), bool)
        new[run >= 0] = offsets[run >= 0] > ends[run[run >= 0]]
        if new.any():
            starts, ends = _join_runs(starts, ends, offsets[new])
            yield chunk[new]
    state.update((starts.tolist(), ends.tolist()))


def dedup(rows: DataFrame) -> DataFrame:
    """Drop replays of a message (same topic, partition and offset).

    There is no watermark: a message that was never seen passes, however old it is.  The
    state is the runs of consecutive offsets seen, one run for a block of offsets without
    gaps, so it grows with the gaps and not with the messages.  A busy partition is spread
    over its blocks.
    """
    # Times pass Python as numbers, which no time zone touches.
    times = [f.name for f in rows.schema.fields if f.dataType == T.TimestampType()]
    block = F.floor(F.col("offset") / OFFSET_BLOCK)
    numbers = rows.withColumns({c: F.unix_micros(c) for c in times} | {"_block": block})
    fresh = numbers.groupBy("topic", "partition", "_block").applyInPandasWithState(
        unseen,
        numbers.schema,
        "starts array<bigint>, ends array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return fresh.drop("_block").withColumns({c: F.timestamp_micros(c) for c in times})


def rate(rows: DataFrame, width: str = "1 hour") -> DataFrame:
    """Messages and messages per second for each window, of a table or a stream.

    There is no watermark: late messages count, and the last windows are not held back.
    A stream of these rows is written by :func:`start_rate`.
    """
    counted = rows.groupBy(F.window("timestamp", width)).agg(F.count("*").alias("messages"))
    seconds = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.col("window.start"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "messages",
        (F.col("messages") / seconds).alias("msg_per_sec"),
    )


def start_rate(
    rows: DataFrame, path: str, checkpoint: str, width: str = "1 hour", trigger: dict | None = None
) -> StreamingQuery:
    """Keep the rates of a stream: each batch writes the windows that it changed below
    ``path/batch=<n>``; a batch that runs again overwrites its own folder."""

    def each(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        rate(rows, width)
        .writeStream.outputMode("update")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rate(spark: SparkSession, path: str) -> DataFrame:
    """The newest rates of all windows that :func:`start_rate` has written."""
    newest = F.max_by(F.struct("messages", "msg_per_sec"), "batch").alias("rate")
    written = spark.read.parquet(path).groupBy("window_start", "window_end").agg(newest)
    return written.select("window_start", "window_end", "rate.*")
