"""Kafka rows -> bronze envelopes, with a quarantine for what cannot be decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft.functions import payload as P


#: ``reason`` of a decodable message.
KEPT = "kept"


def _decoded(rows: DataFrame) -> DataFrame:
    text = "CAST(value AS string)"
    reason = (
        f"CASE WHEN value IS NULL THEN 'tombstone' WHEN NOT is_valid_utf8({text}) THEN 'bad_utf8'"
        f" WHEN NOT {P.is_one_json_value(text)} THEN 'bad_json' END"
    )
    # ``inline``: decided once per row, not again in every filter on the reason.
    return rows.selectExpr("*", f"inline(array(named_struct('reason', {reason})))")


def _metadata() -> str:
    return (
        "struct(topic, partition, offset, nullif(unix_millis(timestamp), -1) AS timestamp,"
        " CASE WHEN length(key) > 0 THEN make_valid_utf8(CAST(key AS string)) END AS key)"
    )


def decode_envelope(rows: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Decodable messages as ``kafka_metadata``, ``data`` (JSON text) and ``inserted_at``."""
    stamp = F.current_timestamp() if inserted_at is None else inserted_at
    return (
        _decoded(rows)
        .filter("reason IS NULL")
        .select(
            F.expr(f"{_metadata()} AS kafka_metadata"),
            F.expr("CAST(value AS string) AS data"),
            stamp.alias("inserted_at"),
        )
    )


def decode_all(rows: DataFrame) -> DataFrame:
    """All messages, each decoded once: bronze columns, ``value`` (null for a decodable
    message, whose text is in ``data``) and ``reason`` (``kept`` or why it was refused)."""
    return _decoded(rows).selectExpr(
        f"{_metadata()} AS kafka_metadata",
        "CASE WHEN reason IS NULL THEN CAST(value AS string) END AS data",
        "current_timestamp() AS inserted_at",
        "CASE WHEN reason IS NOT NULL THEN value END AS value",
        f"coalesce(reason, '{KEPT}') AS reason",
    )


def decode_rejects(rows: DataFrame) -> DataFrame:
    """The complement: raw value, position and reason (tombstone, bad_utf8, bad_json)."""
    return (
        _decoded(rows)
        .filter("reason IS NOT NULL")
        .select("topic", "partition", "offset", "value", "reason")
    )


def flat_envelope(bronze: DataFrame) -> DataFrame:
    """Bronze with the metadata as top-level columns."""
    return bronze.selectExpr(
        "kafka_metadata.topic",
        "kafka_metadata.partition",
        "kafka_metadata.offset",
        "kafka_metadata.timestamp AS ts_ms",
        "kafka_metadata.key",
        "data",
        "inserted_at",
    )
