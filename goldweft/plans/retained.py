"""Runs that keep what may still link: the result never depends on the cut into batches.

Kept are the newest message of every passport, full name and address, and two indexes that
say whom a message reaches: full names of an address, passports of a full name.  A run finds
the people its messages reach, links them anew from what is kept, and writes their golden
records; who has lost a complete identity is withdrawn by a tombstone.  All tables lie in
buckets of their key (``sources.buckets``), and a run reads only those it needs.

The relational tables are a view of the golden records: each carries the ids of its rows,
which it keeps through later versions, also while it is withdrawn.  So a relinked person
replaces rows, and nobody is loaded twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweft import schemas as S
from goldweft.functions.text import normalize_key
from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import latest as L
from goldweft.operators import link as K
from goldweft.operators import monitor as M
from goldweft.operators import rows as R
from goldweft.operators.surrogate import running_ids
from goldweft.sources.buckets import Buckets, by_key, distinct, newest
from goldweft.sources.staging import materialize

ID_TABLES = ("person", "bank", "work", "address")
_ID_NAMES = ("person", "bank", "work", "home", "work_address")
#: Golden records as they are kept: with the ids of their rows, the run that wrote them, and
#: whether they are withdrawn.
GOLDEN = T.StructType(
    [
        *S.GOLDEN.fields,
        T.StructField("ids", T.StructType([T.StructField(n, T.LongType()) for n in _ID_NAMES])),
        T.StructField("version", T.LongType()),
        T.StructField("withdrawn", T.BooleanType()),
    ]
)
_PAIR = T.StructType([T.StructField("key", T.StringType()), T.StructField("leads_to", T.StringType())])
_DOMAINS = {"passports": (S.PERSONAL, S.BANK), "names": (S.LOCATION, S.PROFESSIONAL), "addresses": (S.NETWORK,)}
_ADDRESS_KEY = normalize_key("location.address")
NEWEST = newest("_id")


@dataclass
class Retained:
    golden: DataFrame  # the records written by this run, withdrawn ones included
    stats: DataFrame
    ids: dict[str, int]


def current(state: Buckets, buckets: list[int] | None = None) -> DataFrame:
    """Golden records that hold, as they are kept."""
    return state.read("golden", GOLDEN, NEWEST, buckets).filter("NOT withdrawn")


def table(golden: DataFrame, name: str, mode: str = "bulk") -> DataFrame:
    """One relational table of the golden records that are loaded."""
    loaded = golden.filter("uploaded_2_SQL")
    person = "ids.person AS person_id"
    if name == "person":
        return loaded.selectExpr("ids.person AS id", *R.aliased(R.person_columns(mode)))
    if name == "bank":
        return loaded.filter(R.has_bank()).selectExpr("ids.bank AS id", person, *R.aliased(R.bank_columns()))
    if name == "work":
        return loaded.filter(R.has_work(mode)).selectExpr("ids.work AS id", person, *R.aliased(R.work_columns()))
    home, work = loaded.filter(R.has_home(mode)), loaded.filter(R.has_work_address(mode))
    if name == "address":
        return home.selectExpr("ids.home AS id", *R.aliased(R.home_columns(mode))).unionByName(
            work.selectExpr("ids.work_address AS id", *R.aliased(R.work_address_columns(mode)))
        )
    return home.selectExpr("ids.home AS address_id", person, f"'{R.HOME}' AS type").unionByName(
        work.selectExpr("ids.work_address AS address_id", person, f"'{R.WORK}' AS type")
    )


def _with_ids(golden: DataFrame, bases: dict[str, int], mode: str = "bulk") -> DataFrame:
    """Fill ``ids``: rows that exist keep theirs, new ones come after ``bases``."""
    load = "(uploaded_2_SQL AND NOT withdrawn)"
    wants = {
        "person": load,
        "bank": f"({load} AND {R.has_bank()})",
        "work": f"({load} AND {R.has_work(mode)})",
        "home": f"({load} AND {R.has_home(mode)})",
        "work_address": f"({load} AND {R.has_work_address(mode)})",
    }
    new = {name: f"CAST({want} AND ids.{name} IS NULL AS int)" for name, want in wants.items()}
    counts = {f"{t}_no": new[t] for t in ("person", "bank", "work")}
    counts["address_no"] = f"{new['home']} + {new['work_address']}"
    numbered = running_ids(golden, "_id", counts)
    # Home comes before work, so it has the smaller of two address ids.
    given = {t: f"{bases[t]} + {t}_no" for t in ("person", "bank", "work")}
    given["home"] = f"{bases['address']} + address_no - {new['work_address']}"
    given["work_address"] = f"{bases['address']} + address_no"
    ids = ", ".join(f"'{t}', coalesce(ids.{t}, CASE WHEN {new[t]} = 1 THEN {given[t]} END)" for t in wants)
    return numbered.withColumn("ids", F.expr(f"named_struct({ids})")).select(*GOLDEN.fieldNames())


def _reached(state: Buckets, name: str, keys: DataFrame) -> DataFrame:
    """What the index ``name`` says of ``keys`` (column key); reads only their buckets."""
    pairs = state.raw(name, _PAIR, state.of(keys, "key"))
    # The hash makes both sides plain exchanges: a key that leads to very many may be split.
    hashed = pairs.withColumn("key_hash", F.xxhash64("key"))
    wanted = keys.select("key", F.xxhash64("key").alias("key_hash")).distinct()
    return hashed.join(wanted, ["key", "key_hash"], "left_semi").select(F.col("leads_to").alias("key"))


def run(
    state: Buckets,
    classified: DataFrame,
    batch_id: int,
    bases: dict[str, int],
    staging: str,
    consolidated_at: Column | None = None,
) -> Retained:
    """Add a batch to ``state`` and give the golden records it changes."""
    stage = lambda df, name: materialize(df, name, staging)
    latest = stage(L.latest_by_key(classified), "latest")
    new = {"passports": L.by_passport(latest), "names": L.by_fullname(latest), "addresses": L.by_address(latest)}
    for name, shapes in _DOMAINS.items():
        state.add(name, batch_id, new[name], "key", by_key(*shapes))

    def kept(name: str, keys: DataFrame) -> DataFrame:
        """What is kept for ``keys`` (column key)."""
        rows = state.raw(name, new[name].schema, state.of(keys, "key"))
        return by_key(*_DOMAINS[name])(rows.join(keys.distinct(), "key", "left_semi"))

    # Indexes only grow: a name that somebody no longer has costs a look, not a wrong link.
    named = new["passports"].filter(K.COMPLETE_IDENTITY).selectExpr(f"{K.FULLNAME_KEY} AS key", "key AS leads_to")
    placed = new["names"].filter("location IS NOT NULL").selectExpr(f"{_ADDRESS_KEY} AS key", "key AS leads_to")
    state.add("people_of_name", batch_id, named.filter("key <> ''"), "key", distinct)
    state.add("names_of_address", batch_id, placed, "key", distinct)

    names = new["names"].select("key").unionByName(_reached(state, "names_of_address", new["addresses"].select("key")))
    names = stage(names.filter("key <> ''").distinct(), "names")
    people = new["passports"].select("key").unionByName(_reached(state, "people_of_name", names))
    people = stage(kept("passports", stage(people.distinct(), "people")), "kept-people")

    # The links of these people alone, from the buckets of their names and addresses.
    complete = people.filter(K.COMPLETE_IDENTITY)
    their_names = stage(complete.selectExpr(f"{K.FULLNAME_KEY} AS key").filter("key <> ''").distinct(), "their-names")
    linked_names = stage(kept("names", their_names), "kept-names")
    their_addresses = linked_names.filter("location IS NOT NULL").selectExpr(f"{_ADDRESS_KEY} AS key").distinct()
    linked_addresses = kept("addresses", stage(their_addresses, "their-addresses"))
    linked = K.link_addresses(K.link_names(complete, linked_names), linked_addresses)
    golden = G.golden_projection(linked, consolidated_at).withColumn("withdrawn", F.lit(False))

    before = state.read("golden", GOLDEN, NEWEST, state.of(people, "key"))
    before = stage(before.join(people.select(F.col("key").alias("_id")), "_id", "left_semi"), "golden-before")
    lost = before.filter("NOT withdrawn").join(golden.select("_id"), "_id", "left_anti")
    lost = lost.select(*S.GOLDEN.fieldNames()).withColumn("withdrawn", F.lit(True))
    told = before.select(F.col("_id").alias("before_id"), "ids", F.col("withdrawn").alias("was_withdrawn"))
    changed = (
        golden.unionByName(lost)
        .join(told, F.col("_id") == F.col("before_id"), "left")
        .withColumn("created", F.expr("before_id IS NULL OR was_withdrawn"))
        .withColumn("version", F.lit(batch_id).cast("long"))
        .withColumn("uploaded_2_SQL", G.has_all_sources() & F.col("_id").isNotNull() & ~F.col("withdrawn"))
    )
    changed = stage(changed, "changed")
    written = stage(_with_ids(changed.select(*GOLDEN.fieldNames()), bases, "bulk"), "golden")
    state.add("golden", batch_id, written, "_id", NEWEST)

    own = new["passports"].select("key")
    figures = M.one_row(
        [
            C.class_counts(classified),
            changed.groupBy().agg(
                F.count_if(F.expr("created AND NOT withdrawn")).alias("golden_records_created"),
                F.count_if(F.expr("NOT created AND NOT withdrawn")).alias("golden_records_updated"),
                F.count_if("withdrawn").alias("golden_records_withdrawn"),
            ),
            people.filter(f"NOT {K.COMPLETE_IDENTITY}")
            .join(own, "key", "left_semi")
            .groupBy()
            .agg(F.count("*").alias("unmatched_records")),
            G.namesake_conflicts(changed.filter("NOT withdrawn")),
            _still_kept(state, latest, new),
        ]
    )
    stats = figures.withColumn("raw_records_deleted", F.expr("consumed_records - raw_records_kept"))
    greatest = written.agg(
        *[F.max(f"ids.{t}").alias(t) for t in ("person", "bank", "work")],
        F.greatest(F.max("ids.home"), F.max("ids.work_address")).alias("address"),
    ).first()
    return Retained(written, stats, {t: max(bases[t], greatest[t] or 0) for t in ID_TABLES})


def _still_kept(state: Buckets, latest: DataFrame, new: dict[str, DataFrame]) -> DataFrame:
    """How many messages of the batch are the newest of their key and shape, and so kept."""
    mine = L.latest_rows(latest).groupBy().agg(F.count("*").alias("n"))
    stale = []
    for name, shapes in _DOMAINS.items():
        rows = state.raw(name, new[name].schema, state.of(new[name], "key"))
        now = by_key(*shapes)(rows.join(new[name].select("key"), "key", "left_semi"))
        both = now.alias("a").join(new[name].alias("b"), F.expr("a.key = b.key"))
        late = " + ".join(f"CAST(coalesce(a.{s}.ord > b.{s}.ord, false) AS int)" for s in shapes)
        stale.append(both.groupBy().agg(F.expr(f"coalesce(sum({late}), 0)").alias("n")))
    parts = mine.withColumn("sign", F.lit(1))
    for part in stale:
        parts = parts.unionByName(part.withColumn("sign", F.lit(-1)))
    return parts.groupBy().agg(F.sum(F.expr("n * sign")).alias("raw_records_kept"))
