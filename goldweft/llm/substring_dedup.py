"""Removal of repeated passages, found from difference-cover anchors.

A difference cover D of a period v has, for any two places i and j, a shift k < v such that
i + k and j + k both lie in D modulo v.  So two equal windows of L words always hold equal
anchors of L - v + 1 words at places of D: it is enough to hash about a third of all places.
Anchors that occur twice are extended to the windows around them, and the windows' hashes
are compared, which says for each window whether its words also start earlier.

Hashes travel as packed arrays, one row per task and bucket.  What a task sees twice it
settles itself and passes on once, so a passage in a third of all documents costs each
bucket one entry per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import buckets, slices, texts_of
from goldweft.llm.wordhash import hash_words, runs

#: Words of a window, and a perfect difference cover of 13: every remainder is the
#: difference of two of its numbers.
WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_PACK = "bucket int, hashes binary, docs binary, places binary"
_PLACES = "bucket int, docs binary, places binary"


def _split(keys: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Indices of ``keys`` by their remainder modulo n."""
    part = (keys % np.uint64(n)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    return [(int(part[g[0]]), g) for g in np.split(order, cuts[1:]) if len(g)]


def _read(table: pa.Table, name: str, kind: type) -> np.ndarray:
    """The packed arrays of a group's rows, one after another."""
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)


def _pack(keys: np.ndarray, n: int, **columns: np.ndarray) -> pa.RecordBatch | None:
    groups = _split(keys, n)
    arrays = [pa.array([b for b, _ in groups], pa.int32())]
    arrays += [pa.array([c[g].tobytes() for _, g in groups], pa.binary()) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once."""
    _, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
    return n[at] > 1


def _anchor_places(offsets: np.ndarray, total: int) -> np.ndarray:
    """Places in an array of many documents' words at which an anchor begins."""
    lengths = np.diff(offsets)
    place = np.arange(total) - np.repeat(offsets[:-1], lengths)
    fits = place + ANCHOR <= np.repeat(lengths, lengths)
    return np.flatnonzero(np.isin(place % PERIOD, COVER) & fits)


#: Anchors that a task gathers before it passes them on.
GATHERED = 1_000_000


def _anchors(n: int):
    """Documents -> anchors, by the bucket of their hash.

    Where anchors repeat among those gathered, all but one are settled and travel with an
    empty hash; the one goes on with its lowest bit set, which says that it is repeated.
    """

    def emit(gathered):
        keys, docs, places = (np.concatenate(c) for c in zip(*gathered))
        keys &= ~np.uint64(1)
        _, first, at, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        twice = count[at] > 1
        done = twice.copy()
        done[first] = False
        keys[twice] |= np.uint64(1)
        bucket = np.where(done, _doc_key(docs), keys >> np.uint64(1))
        keys[done] = 0
        return _pack(bucket, n, hashes=keys, docs=docs, places=places)

    def run(batches):
        gathered, held = [], 0
        for part in slices(batches):
            hashes, offsets = hash_words(texts_of(part.column("text")))
            at = _anchor_places(offsets, len(hashes))
            doc = np.searchsorted(offsets, at, side="right") - 1
            ids = np.array(part.column("doc").to_pylist(), np.int64)
            if len(at):
                places = (at - offsets[doc]).astype(np.int32)
                gathered.append((runs(hashes, ANCHOR)[at], ids[doc], places))
                held += len(at)
            if held > GATHERED:
                yield emit(gathered)
                gathered, held = [], 0
        if held:
            yield emit(gathered)

    return run


def _meet_anchors(n: int):
    """Anchors of a bucket -> the places of those that occur twice, by document bucket."""

    def run(table: pa.Table) -> pa.Table:
        keys = _read(table, "hashes", np.uint64)
        twice = (keys & np.uint64(1) == 1) | (keys == 0)
        twice |= _repeated(keys >> np.uint64(1)) & (keys != 0)
        docs, places = _read(table, "docs", np.int64)[twice], _read(table, "places", np.int32)[twice]
        return pa.Table.from_batches([_pack(_doc_key(docs), n, docs=docs, places=places)])

    return run


def _doc_key(docs: np.ndarray) -> np.ndarray:
    return docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)


def _by_document(table: pa.Table) -> dict[int, np.ndarray]:
    docs, places = _read(table, "docs", np.int64), _read(table, "places", np.int32)
    order = np.argsort(docs, kind="stable")
    docs, places = docs[order], places[order]
    cuts = np.flatnonzero(np.diff(docs)) + 1
    return {int(d[0]): p for d, p in zip(np.split(docs, cuts), np.split(places, cuts)) if len(d)}


def _covered(places: np.ndarray, before: int, after: int, n: int) -> np.ndarray:
    """Which of n places lie at most ``before`` ahead of or ``after`` behind one of ``places``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.clip(places - before, 0, n), 1)
    np.add.at(step, np.clip(places + after + 1, 0, n), -1)
    return np.cumsum(step[:-1]) > 0


def _windows(n: int):
    """Documents and their repeated anchors -> windows around them.

    Of equal windows that meet here, all but the earliest are done; the earliest goes on to
    the bucket of its hash.  Done ones travel with an empty hash (0).
    """

    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        marked = _by_document(anchors)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in docs.to_batches():
            ids = batch.column("doc").to_pylist()
            batch = batch.filter(pa.array([i in marked for i in ids], pa.bool_()))
            for part in slices([batch]):
                hashes, offsets = hash_words(texts_of(part.column("text")))
                for i, doc in enumerate(part.column("doc").to_pylist()):
                    own = hashes[offsets[i] : offsets[i + 1]]
                    keys = runs(own, WINDOW)
                    near = np.flatnonzero(_covered(marked[doc], PERIOD - 1, 0, len(keys)))
                    found.append((keys[near] | np.uint64(1), np.full(len(near), doc), near.astype(np.int32)))
        empty = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))
        keys, ids, places = (np.concatenate(c) for c in zip(*[empty, *found]))
        bucket = keys >> np.uint64(1)
        keys[_later(keys, ids, places)] = 0
        return pa.Table.from_batches([_pack(bucket, n, hashes=keys, docs=ids, places=places)])

    return run


def _later(keys: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which windows have an equal one at an earlier (document, place)."""
    order = np.lexsort((places, docs, keys))
    k, d, p = keys[order], docs[order], places[order]
    begins = np.diff(k, prepend=k[:1] ^ np.uint64(1)) != 0
    first = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(k) else np.empty(0, np.int64)
    out = np.zeros(len(keys), bool)
    out[order] = (d != d[first]) | (p != p[first])
    return out


def _meet_windows(n: int):
    """Windows of a bucket -> the places of those that start earlier as well."""

    def run(table: pa.Table) -> pa.Table:
        keys, docs = _read(table, "hashes", np.uint64), _read(table, "docs", np.int64)
        places = _read(table, "places", np.int32)
        open_ = keys != 0
        gone = ~open_
        gone[open_] = _later(keys[open_], docs[open_], places[open_])
        return pa.Table.from_batches([_pack(_doc_key(docs[gone]), n, docs=docs[gone], places=places[gone])])

    return run


_KEPT = "doc long, n_words long, n_removed long, kept string"


def _strip(docs: pa.Table, marked: dict[int, np.ndarray]) -> pa.Table:
    """The kept words of documents, without the windows that are to go."""
    rows = []
    for doc, text in zip(docs["doc"].to_pylist(), texts_of(docs["text"].combine_chunks())):
        words = text.split()
        n = len(words)
        if (places := marked.get(doc)) is not None:
            gone = _covered(places, 0, WINDOW - 1, n)
            words = [w for w, x in zip(words, gone.tolist()) if not x]
        rows.append((doc, n, n - len(words), b" ".join(words).decode(errors="replace")))
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "n_words", "n_removed", "kept"]
    )


def _untouched(batches):
    for part in slices(batches):
        yield from _strip(pa.Table.from_batches([part]), {}).to_batches()


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words, n_removed and kept (the words left, joined by one space) of every
    row of ``docs``.

    A word goes if it lies in a window of :data:`WINDOW` words that also starts earlier: in
    a document with a smaller ``key`` or before in the same one.  Windows are judged on the
    input.  Words are cut at ASCII white space and compared as they are; null has none.
    Rows without a key are left as they are.  Rows that share a key are one place: none of
    them is earlier than the other.  Other columns are left out; an empty table gives no rows.
    """
    n = buckets(docs, text)
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    known = rows.filter(F.col("doc").isNotNull())
    anchors = known.mapInArrow(_anchors(n), _PACK)
    twice = anchors.groupBy("bucket").applyInArrow(_meet_anchors(n), _PLACES)
    placed = known.mapInArrow(_with_bucket(n), "bucket int, doc long, text string").groupBy("bucket")
    windows = placed.cogroup(twice.groupBy("bucket")).applyInArrow(_windows(n), _PACK)
    gone = windows.groupBy("bucket").applyInArrow(_meet_windows(n), _PLACES)
    kept = placed.cogroup(gone.groupBy("bucket")).applyInArrow(
        lambda d, g: _strip(d, _by_document(g)), _KEPT
    )
    unkeyed = rows.filter(F.col("doc").isNull()).mapInArrow(_untouched, _KEPT)
    return kept.unionByName(unkeyed).withColumnRenamed("doc", key)


def _with_bucket(n: int):
    def run(batches):
        for batch in batches:
            ids = np.array(batch.column("doc").to_pylist(), np.int64)
            bucket = (_doc_key(ids) % np.uint64(n)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), batch.column("doc"), batch.column("text")],
                names=["bucket", "doc", "text"],
            )

    return run

