"""One run of the whole pipeline over a batch of bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import latest as L
from goldweft.operators import monitor as M
from goldweft.plans import consolidate as E
from goldweft.plans import retained as RT
from goldweft.plans.load import load_bulk, load_json, load_strict
from goldweft.sources.golden_json import read_golden_json
from goldweft.sources.staging import materialize
from goldweft.sources.store import Store

_ID_TABLES = RT.ID_TABLES


def run_batch(
    store: Store,
    bronze: DataFrame,
    batch_id: int,
    merge: str = "replace",
    on_existing: str = "append",
    retain_unmatched: bool = False,
    full: bool = False,
    consolidated_at: Column | None = None,
    query: str | None = None,
    load: str = "bulk",
) -> None:
    """Consolidate, load and commit one batch; a committed batch is left alone.

    ``load="strict"`` validates records before they are loaded and flags the loaded ones
    alone: refused records, and those whose passport has a person, stay pending.  They are
    judged again when a message reaches them, since nothing else can change the outcome.
    What became of the records of a batch is in the table ``outcomes``.

    ``retain_unmatched`` keeps the newest message of every link key and shape for the next
    runs and links the people anew whom a message reaches, so golden records and tables do not
    depend on the cut into batches (see ``plans.retained``).  A store holds either such runs or
    others; ``merge``, ``on_existing`` and ``full`` do not apply to them.
    ``full`` writes the whole golden state
    as one batch, so later reads start here.  ``query`` is the id of the streaming query
    that ``batch_id`` belongs to (see ``Store.number_of``).
    """
    if load not in ("bulk", "strict"):
        raise ValueError(f"unknown load {load!r}")
    if load == "strict" and on_existing != "append":
        raise ValueError("a strict load always skips existing persons")
    query_batch, batch_id = batch_id, store.number_of(batch_id, query)
    if batch_id is None:
        return
    if store.last_commit() is not None and store.is_retained() != retain_unmatched:
        raise ValueError("a store holds either retained runs or others")
    if retain_unmatched and (merge, on_existing, full, load) != (
        "replace",
        "append",
        False,
        "bulk",
    ):
        raise ValueError("merge, on_existing, full and load do not apply to retained runs")
    staging = f"{store.path}/staging/{batch_id % 2}"
    messages = C.bronze_messages(bronze)
    # Parsed once; every later step reads only the columns it needs of this table.  A batch
    # may be a few large files: spread by size, all cores parse them and sort their rows.
    classified = materialize(C.classify(messages.hint("rebalance")), "classified", staging)
    left = C.remaining(classified)
    store.write("quarantine", batch_id, left.select("msg_id", "ord", "data", "shape"))
    last = store.last_ids()
    bases = {t: last.get(t, 0) for t in _ID_TABLES}
    if retain_unmatched:
        state = store.state()
        done = RT.run(state, classified, batch_id, bases, staging, consolidated_at)
        store.write("stats", batch_id, done.stats)
        store.commit(batch_id, done.ids, False, query, query_batch, state)
        return
    latest = L.latest_by_key(classified)
    new = materialize(E.golden_of(latest, consolidated_at), "golden", staging)
    unmatched = E.unmatched(latest)

    stats = M.consolidation_stats(classified, unmatched, new, store.passports())
    store.write("stats", batch_id, stats)

    if full:
        state = G.upsert(store.golden(), new, merge).drop("change")
    elif merge == "coalesce":
        state = G.upsert(store.golden(of=new), new, merge).drop("change")
    else:
        state = new
    state = materialize(state, "state", staging)

    if load == "strict":
        done = load_strict(state, store.tables(), bases, staging)
        flagged = G.mark_uploaded(state, done.loaded)
    else:
        existing = store.tables() if on_existing == "skip" else None
        done = load_bulk(state, existing, on_existing, bases, staging)
        # Records that were pending are in the tables now, or were there already.
        complete = G.has_all_sources() & F.col("_id").isNotNull()
        flagged = state.withColumn("uploaded_2_SQL", F.col("uploaded_2_SQL") | complete)
    for name, rows in done.tables.items():
        store.write(f"tables/{name}", batch_id, rows)
    store.write("outcomes", batch_id, done.outcomes)
    store.write("golden", batch_id, flagged)
    store.commit(batch_id, _next_ids(store, batch_id, bases), full, query, query_batch)


def run_json(store: Store, path: str, batch_id: int) -> None:
    """Load golden JSON files into the tables and commit that as one batch.

    Records without an id, with a person already, or repeated in the files are skipped, as
    ``outcomes`` of the batch tells.  Golden records of the store stay as they are but for
    the upload flag of those whose passport was loaded.
    """
    batch_id = store.number_of(batch_id)
    if batch_id is None:
        return
    if store.is_retained():
        raise ValueError("the tables of retained runs follow from their golden records")
    staging = f"{store.path}/staging/{batch_id % 2}"
    last = store.last_ids()
    bases = {t: last.get(t, 0) for t in _ID_TABLES}
    done = load_json(read_golden_json(store.spark, path), store.tables(), bases, staging)
    for name, rows in done.tables.items():
        store.write(f"tables/{name}", batch_id, rows)
    store.write("outcomes", batch_id, done.outcomes)
    flagged = store.golden(of=done.loaded).withColumn("uploaded_2_SQL", F.lit(True))
    store.write("golden", batch_id, flagged)
    store.commit(batch_id, _next_ids(store, batch_id, bases))


def dry_run(bronze: DataFrame) -> DataFrame:
    """The statistics that a run over ``bronze`` into an empty store would report; nothing
    is written but scratch data, and nothing is used up."""
    classified = materialize(C.classify(C.bronze_messages(bronze)), "classified")
    latest = L.latest_by_key(classified)
    return M.dry_run_stats(classified, E.unmatched(latest), E.golden_of(latest))


def _next_ids(store: Store, batch_id: int, bases: dict[str, int]) -> dict[str, int]:
    """Greatest ids after this batch: one number per table comes to the driver."""
    ids = {}
    for name, base in bases.items():
        written = store.spark.read.schema(S.TABLES[name]).parquet(
            f"{store.path}/tables/{name}/batch_id={batch_id}"
        )
        ids[name] = written.agg(F.coalesce(F.max("id"), F.lit(base))).first()[0]
    return ids
