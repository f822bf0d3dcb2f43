"""Golden records: the 20-field projection, its upsert and its filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.functions.text import build_fullname, filled, normalize_key

#: Names of the shapes that contributed, in fixed order.
DATA_SOURCES = "array_compact(array({}))".format(
    ", ".join(f"CASE WHEN {s} IS NOT NULL THEN '{s}' END" for s in S.SOURCES)
)
N_SOURCES = " + ".join(f"CAST({s} IS NOT NULL AS int)" for s in S.SOURCES)
NOW = "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"


def golden_projection(linked: DataFrame, consolidated_at: Column | None = None) -> DataFrame:
    """Linked rows as golden records; every field is there, null where unknown."""
    stamp = F.expr(NOW) if consolidated_at is None else consolidated_at
    owner = {key: shape for shape, keys in S.SHAPE_FIELDS.items() for key in keys}
    owner["sex_is_scalar"] = S.PERSONAL
    computed = {
        "_id": F.col("key"),
        "consolidated_at": stamp.cast("string"),
        "data_sources": F.expr(DATA_SOURCES),
        "uploaded_2_SQL": F.lit(False),
        "n_sources": F.expr(N_SOURCES),
    }
    return linked.select(
        *[
            computed[f].alias(f) if f in computed else F.expr(f"{owner[f]}.`{f}` AS `{f}`")
            for f in S.GOLDEN.fieldNames()
        ]
    )


def has_all_sources(exact_names: bool = False) -> Column:
    """Complete records.  ``exact_names`` asks for the five names, not just for five."""
    if exact_names:
        wanted = ", ".join(f"'{s}'" for s in S.SOURCES)
        return F.expr(
            f"n_sources >= {len(S.SOURCES)}"
            f" AND size(array_except(array({wanted}), data_sources)) = 0"
        )
    return F.expr(f"n_sources = {len(S.SOURCES)}")


def not_uploaded() -> Column:
    """False, null and absent all mean not uploaded."""
    return F.expr("NOT (uploaded_2_SQL <=> true)")


def pending(golden: DataFrame, exact_names: bool = False) -> DataFrame:
    """Complete golden records not yet in the tables; both tests reach the scan."""
    return golden.filter(has_all_sources(exact_names) & not_uploaded())


def upsert(old: DataFrame, new: DataFrame, merge: str = "replace") -> DataFrame:
    """Merge ``new`` into ``old`` by passport; adds ``change``: created, updated or kept.

    ``replace``: every field of the new record wins, nulls included, and the upload
    flag starts again at false.  ``coalesce``: an old value stays where the new record
    has null, and sources add up.  One full outer join on a key that is unique on both
    sides; an ``old`` side bucketed by passport is not shuffled.
    """
    if merge not in ("replace", "coalesce"):
        raise ValueError(f"unknown merge {merge!r}")
    joined = old.alias("o").join(new.alias("n"), F.expr("o._id = n._id"), "full")
    order = ", ".join(f"'{s}'" for s in S.SOURCES)
    none = "CAST(array() AS array<string>)"
    united = (
        f"filter(array({order}), s -> array_contains(array_union("
        f"coalesce(o.data_sources, {none}), coalesce(n.data_sources, {none})), s))"
    )
    cols = []
    for name in S.GOLDEN.fieldNames():
        col = f"CASE WHEN n._id IS NOT NULL THEN n.`{name}` ELSE o.`{name}` END"
        if merge == "coalesce":
            if name == "data_sources":
                col = united
            elif name == "n_sources":
                col = f"size({united})"
            elif name in S.GOLDEN_CONTENT:
                col = f"coalesce(n.`{name}`, o.`{name}`)"
        cols.append(f"{col} AS `{name}`")
    change = (
        "CASE WHEN n._id IS NULL THEN 'kept' WHEN o._id IS NULL THEN 'created'"
        " ELSE 'updated' END AS change"
    )
    return joined.selectExpr(*cols, change)


def mark_uploaded(golden: DataFrame, loaded: DataFrame) -> DataFrame:
    """Set the upload flag of the passports in ``loaded`` (column ``_id``, unique)."""
    ids = loaded.select(F.col("_id").alias("loaded_id"))
    flag = "loaded_id IS NOT NULL OR uploaded_2_SQL AS uploaded_2_SQL"
    return golden.join(ids, F.expr("_id = loaded_id"), "left").selectExpr(
        *[flag if c == "uploaded_2_SQL" else f"`{c}`" for c in golden.columns]
    )


def namesake_conflicts(golden: DataFrame) -> DataFrame:
    """Number of normalised full names that several golden records share."""
    key = normalize_key(build_fullname("name", "last_name"))
    return (
        golden.groupBy(F.expr(f"{key} AS fullname_key"))
        .count()
        .groupBy()
        .agg(F.expr("count_if(count > 1) AS namesake_conflicts"))
    )


def filled_identity(golden: DataFrame) -> DataFrame:
    return golden.filter(f"{filled('name')} AND {filled('last_name')}")
