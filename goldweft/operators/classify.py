"""Raw messages -> messages with shape and link key.

All functions take a DataFrame with ``data`` (JSON text); other columns pass through.
The order column says which of two messages with the same key is the later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.functions import payload as P


def bronze_messages(bronze: DataFrame) -> DataFrame:
    """Bronze envelopes as messages: ``msg_id``, ``ord`` (arrival order) and ``data``."""
    meta = "kafka_metadata"
    return bronze.selectExpr(
        f"struct({meta}.topic, {meta}.partition, {meta}.offset) AS msg_id",
        f"struct(inserted_at, {meta}.partition, {meta}.offset, {meta}.topic) AS ord",
        "data",
    )


def classify(messages: DataFrame) -> DataFrame:
    """Add ``doc`` (key -> text), ``shape``, ``link_value`` and ``link_key``.

    ``link_key`` is null unless the shape is one of the five and its link field is
    filled: exactly the messages that take part in linking.
    """
    parsed = messages.selectExpr("*", f"{P.payload_map('data')} AS doc")
    parsed = parsed.withColumn("doc", F.expr(P.last_wins("doc")))
    # ``inline`` instead of plain columns: the optimizer copies plain columns into
    # every later use, so a filter on the link key would parse each message again, or
    # at least make the key once more.
    shaped = parsed.selectExpr(
        "*", f"inline(array(named_struct('shape', {P.shape_of('doc', 'data')})))"
    )
    valued = shaped.selectExpr("*", f"{P.link_value('doc', 'shape')} AS link_value")
    return valued.selectExpr(
        "*", f"inline(array(named_struct('link_key', {P.link_key('link_value', 'shape')})))"
    )


def empty_payloads(classified: DataFrame) -> DataFrame:
    return classified.filter(f"shape = '{S.EMPTY}'")


def unknown_payloads(classified: DataFrame) -> DataFrame:
    return classified.filter(f"shape = '{S.UNKNOWN}'")


def non_object_payloads(classified: DataFrame) -> DataFrame:
    """Valid JSON that is neither an object nor empty: quarantined, stays in bronze."""
    return classified.filter(f"shape = '{S.NON_OBJECT}'")


def missing_key(classified: DataFrame) -> DataFrame:
    """A known shape whose link field is null or empty: not used, stays in bronze."""
    return classified.filter(F.col("shape").isin(*S.SOURCES) & F.col("link_key").isNull())


#: Messages a run uses up: those with a link key and the empty ones.
CONSUMED = f"(link_key IS NOT NULL OR shape = '{S.EMPTY}')"


def consumed(classified: DataFrame) -> DataFrame:
    return classified.filter(CONSUMED)


def remaining(classified: DataFrame) -> DataFrame:
    """What is left in bronze after a run.  A row predicate, so no join and no id list."""
    return classified.filter(f"NOT {CONSUMED}")


def of_passports(classified: DataFrame, people: DataFrame) -> DataFrame:
    """Personal and bank messages of the passports in ``people`` (column ``key``).

    The key and its hash join, so both sides are plain exchanges: a passport with a
    large share of all messages may be split.
    """
    wanted = people.selectExpr("key", "xxhash64(key) AS key_hash")
    rows = classified.filter(F.col("shape").isin(S.PERSONAL, S.BANK)).withColumn(
        "link_hash", F.xxhash64("link_key")
    )
    return rows.join(
        wanted, F.expr("link_key = key AND link_hash = key_hash"), "left_semi"
    ).drop("link_hash")


def remaining_retaining_unmatched(classified: DataFrame, unmatched: DataFrame) -> DataFrame:
    """What is left if messages of unmatched passports are kept as well."""
    return remaining(classified).unionByName(of_passports(classified, unmatched))


def class_counts(classified: DataFrame) -> DataFrame:
    """One row of message counts; a known shape counts only with its link field filled."""
    per_shape = [
        F.expr(f"count_if(shape = '{s}' AND link_key IS NOT NULL) AS {s}_records")
        for s in S.SOURCES
    ]
    return classified.groupBy().agg(
        F.expr("count(*) AS total_raw_messages"),
        *per_shape,
        F.expr(f"count_if(shape = '{S.UNKNOWN}') AS unknown_records"),
        F.expr(f"count_if(shape = '{S.EMPTY}') AS empty_data_count"),
        F.expr(f"count_if({CONSUMED}) AS consumed_records"),
    )
