"""Latest message per link key.

Three link domains exist: passports (personal, bank), full names (location,
professional) and addresses (network).  One aggregation over ``(domain, key)`` finds
the latest message of every shape; two shapes of one domain meet in the same row, so
joining personal to bank data and location to professional data needs no join.
Aggregation is partial before the shuffle: a key that repeats millions of times
leaves each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.functions import payload as P


def _fields(shape: str) -> str:
    cols = []
    for key in S.SHAPE_FIELDS[shape]:
        if key == "sex":
            cols.append(f"{P.sex_values('doc.sex')} AS sex")
            cols.append(f"{P.sex_is_scalar('doc.sex')} AS sex_is_scalar")
        else:
            cols.append(f"doc['{key}'] AS `{key}`")
    return ", ".join(cols)


def latest_by_key(
    classified: DataFrame, order: str = "ord", tasks: int | None = None
) -> DataFrame:
    """One row per domain and key: ``latest``, a struct of the key and one struct per shape.

    The greatest ``(order, fields)`` struct wins as a whole, so the nulls of the
    winning message stay nulls.  The order column must be unique per message.

    With ``tasks``, keys are dealt to that many tasks, whatever the session says: then a task
    holds no more the larger the input is.  The messages must have been dealt by the column
    ``task``, so that the first aggregation stays within it.
    """
    per_shape = ", ".join(
        f"max(CASE WHEN shape = '{s}' THEN struct({order} AS ord, {_fields(s)}) END) AS {s}"
        for s in S.SOURCES
    )
    linked = classified.filter("link_key IS NOT NULL")
    domain = F.expr(P.link_domain("shape")).alias("domain")
    if tasks:
        newest = [f"struct(link_key AS key, {per_shape}) AS newest"]
        own = linked.groupBy(domain, "link_key", "task").agg(*map(F.expr, newest))
        linked = own.repartition(tasks, "domain", "link_key")
        domain = F.col("domain")
        per_shape = ", ".join(f"max(newest.{s}) AS {s}" for s in S.SOURCES)
    return (
        linked.groupBy(domain, "link_key")
        .agg(F.expr(f"struct(link_key AS key, {per_shape}) AS latest"))
        .select("latest")
    )


def newest_messages(classified: DataFrame, order: str = "ord") -> DataFrame:
    """The message itself, of every shape and link key the one that counts in
    :func:`latest_by_key`."""
    columns = ", ".join(f"`{c}`" for c in classified.columns)
    return (
        classified.filter("link_key IS NOT NULL")
        .groupBy("shape", "link_key")
        .agg(F.expr(f"max_by(struct({columns}), {order}) AS message"))
        .select("message.*")
    )


def by_passport(latest: DataFrame) -> DataFrame:
    """Full outer link of personal and bank data: ``key``, ``personal``, ``bank``."""
    return _domain_rows(latest, S.PERSONAL, S.BANK)


def by_fullname(latest: DataFrame) -> DataFrame:
    """``key``, ``location``, ``professional``; the blank key is there but never links."""
    return _domain_rows(latest, S.LOCATION, S.PROFESSIONAL)


def by_address(latest: DataFrame) -> DataFrame:
    """``key``, ``network``; the blank key stays: it links to a blank address."""
    return _domain_rows(latest, S.NETWORK)


def _domain_rows(latest: DataFrame, *shapes: str) -> DataFrame:
    # Tests and keys come from the aggregated struct, not from the grouping columns: a
    # filter on those (also one inferred from a join) would move below the aggregation
    # and give every domain its own scan and parse.  Like this all share one exchange.
    present = " OR ".join(f"latest.{s} IS NOT NULL" for s in shapes)
    return latest.filter(present).select("latest.key", *[f"latest.{s}" for s in shapes])


def latest_rows(latest: DataFrame) -> DataFrame:
    """Long form, one row per shape and key: ``shape``, ``key``, ``ord``."""
    entries = ", ".join(
        f"CASE WHEN latest.{s} IS NOT NULL THEN struct('{s}' AS shape, latest.{s}.ord AS ord) END"
        for s in S.SOURCES
    )
    return latest.selectExpr("latest.key", f"inline(array_compact(array({entries})))").select(
        "shape", "key", "ord"
    )
