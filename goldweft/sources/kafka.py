"""Kafka-shaped message sources.

The Kafka connector is a separate Spark package; ``format`` is an argument so that the
same job runs on any streaming source with Kafka's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft import schemas as S

#: Zone-less event times are UTC, whatever the session's time zone.
_UTC = "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts))"


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **options
) -> DataFrame:
    """One topic from its earliest offset on; the checkpoint takes the group id's place."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def read_file_stream(
    spark: SparkSession, path: str, schema=S.KAFKA, format: str = "parquet", **options
) -> DataFrame:
    """Files that land in a folder, as a stream."""
    reader = spark.readStream.format(format).schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def as_kafka_rows(events: DataFrame) -> DataFrame:
    """The ``events`` table in Kafka's columns (batch or stream): one topic per event
    type, ``props`` as value, the user as key, the event id as offset."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr(f"{_UTC} AS timestamp"),
    )


def documents_as_kafka_rows(documents: DataFrame) -> DataFrame:
    """The ``documents`` table in Kafka's columns; plain prose is no JSON."""
    return documents.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit("documents").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
