"""Exact Jaccard join of documents on word shingles by universe partition.

Sets fall into bands of similar size.  Each band has a scheme: shingles are dealt by hash
into segments, and two sets that are similar enough to link differ in at most H shingles
(H follows from the band's sizes).  With m segments, some of which are compared as they are
and some up to one missing shingle, at most H differences cannot spoil all of them as soon
as the allowances add up to H + 1; a set indexes its segments and, where the scheme says so,
each segment without one of its shingles.  How many segments of either kind a band uses is
chosen by cost (:func:`allocate`).  A set takes part under its own band's scheme and the next
smaller band's, so that pairs across a border meet too.

Shingles found in many documents (a passage that a third of them share) say little, and
segments made only of them would pair everything.  They are left out of the segments.  That
removes differences, never adds any, so the count stays valid as long as enough segments
hold a shingle.  A set for which they don't is dealt again with all its shingles and another
hash, up to the first deal that is enough; of two sets, the one that is done first finds the
other, which took part in that deal as well.  Which shingles count as common changes the
cost alone, not the result.

Candidates are verified exactly on whole texts; nothing is capped.  Groups of many sets are
not paired in full, since only their components are wanted: each set is compared with a
centre, and sets that are still apart then meet only through the shingles in which they differ
from what most of them hold (:func:`_outside`), in smaller groups that go through the same steps.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldweft.llm.common import buckets, slices, stage, texts_of
from goldweft.llm.components import components
from goldweft.llm.wordhash import hash_words, mix, runs

SHINGLE = 5
#: Two sets link when 100 * |A and B| >= SIMILARITY * |A or B|.
SIMILARITY = 80
#: Every so manieth document is looked at for common shingles; a shingle is common that
#: occurs in more than this share of them.
LOOK, COMMON = 8, 1 / 400
#: Deals that are tried; the last also indexes empty segments.
DEALS = 12
#: What a pair of sets that share a fifth of their shingles weighs against an index entry.
PAIR_COST = 1000
#: Groups of at most so many sets are paired in full, larger ones through a centre.
SMALL_GROUP = 8
#: The same for the groups of :func:`_outside`, of whose pairs few are left by its conditions.
SMALL_OUTSIDE = 512
#: Larger ones are paired in full as well once all their pairs together are at most so many
#: a set, times the steps taken so far: then another step, which reads the texts again, costs
#: more than looking at the pairs does.
PAIRS_PER_SET = 16


def links(inter: int, a: int, b: int) -> bool:
    return a > 0 and b > 0 and 100 * inter >= SIMILARITY * (a + b - inter)


@lru_cache(maxsize=1)
def bands() -> tuple[list[int], list[int], list[int]]:
    """Greatest size of each band, and the segments of its scheme: plain ones and those
    compared up to one missing shingle."""
    tops, plain, loose, low = [], [], [], 1
    while low < 1 << 31:
        top = max(low, low * 100 // SIMILARITY)
        m, k = allocate(low, top)
        tops.append(top)
        plain.append(m)
        loose.append(k)
        low = top + 1
    return tops, plain, loose


def difference(top: int) -> int:
    """H of a band: most shingles in which a set of at most ``top`` shingles and a set that
    is not smaller can differ and still link."""
    return (100 - SIMILARITY) * (top + top * 100 // SIMILARITY) // (100 + SIMILARITY)


def allocate(low: int, top: int) -> tuple[int, int]:
    """Numbers of plain and of loose segments for a band, by cost.

    Costs are the entries a set of middle size makes, and the chance that two sets that have
    a fifth of their shingles in common share an entry.  Beyond H + 1, a few segments more
    make up for segments that stay empty (plain) or hold one shingle (loose).
    """
    h, size = difference(top), (low + top) / 2
    if h == 0:  # only equal sets link
        return 1, 0
    best = None
    for part in (0.0, 0.5, 1.0):
        k = int(part * (h + 2) / 2)
        m = max(h + 1 - 2 * k, 0)
        for _ in range(400):  # segments to spare change the mean size and so the number needed
            s = size / (m + k) if m + k else 0
            empty = m * np.exp(-s) + 2 * k * np.exp(-s) * (1 + s)
            need = h + 1 + (1.3 * empty + 3 + m // 50 if h > 3 else int(1.3 * empty))
            if m + 2 * k >= need:
                break
            m, k = (m + 1 + m // 50, k) if k == 0 else (m, k + 1 + k // 50)
        if m + k == 0:
            continue
        s = size / (m + k)
        entries = m + k * (1 + s)
        chance = m * (np.exp(-0.8 * s) - np.exp(-s)) ** 2 + k * (
            (np.exp(-0.8 * s) - np.exp(-s)) * (1 + s)
        ) ** 2
        if m + k == 1:
            chance = 0  # the whole set, but for one shingle
        cost = entries + PAIR_COST * chance
        if best is None or cost < best[0]:
            best = (cost, m, k)
    return best[1], best[2]


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin and end."""
    hashes, offsets = hash_words(texts, lower=True)
    keys = runs(np.concatenate([hashes, np.zeros(SHINGLE - 1, np.uint64)]), SHINGLE)
    lengths = np.diff(offsets)
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], lengths)
    keep = place <= np.repeat(lengths, lengths) - SHINGLE
    for i in np.flatnonzero((lengths > 0) & (lengths < SHINGLE)):  # the whole sequence
        a, n = offsets[i], lengths[i]
        keys[a] = runs(hashes[a : a + n], int(n))[0] + np.uint64(n)
        keep[a] = True
    doc = np.repeat(np.arange(len(texts)), lengths)[keep]
    keys = keys[keep]
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One positive 62-bit number per set; sets with the same shingles have the same."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(keys))])
    total = sums[ends[1:]] - sums[ends[:-1]]
    return (mix(total + np.diff(ends).astype(np.uint64)) >> np.uint64(2)).astype(np.int64)


class Index:
    """Makes the entries of sets."""

    def __init__(self, common: np.ndarray):
        self.common = common
        tops, plain, loose = bands()
        self.tops, self.plain, self.loose = np.array(tops), np.array(plain), np.array(loose)
        self.h = np.array([difference(t) for t in tops])

    def entries(self, keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of all entries of the sets: hash, set, index (scheme and deal), allowance, and by
        how much the set's allowances in that index exceed what they must add up to."""
        n = np.diff(ends)
        sets = np.repeat(np.arange(len(n)), n)
        cold = np.ones(len(keys), bool)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, keys), len(self.common) - 1)
            cold = self.common[at] != keys
        band = np.searchsorted(self.tops, n)
        out = []
        every = np.ones(len(keys), bool)
        for lower in (0, 1):
            scheme = band - lower
            short = (n > 0) & (scheme >= 0)
            short &= self.h[np.maximum(scheme, 0)] > 0  # else only equal sets link
            for deal in range(DEALS):
                if short.any():
                    short &= ~self._make(out, keys, sets, every if deal else cold, short, scheme, deal)
        if not out:
            return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4)
        return tuple(np.concatenate(c) for c in zip(*out))

    def _make(self, out, keys, sets, take, use, scheme, deal) -> np.ndarray:
        """Entries of the sets in ``use`` from the shingles in ``take``, dealt by the hash
        number ``deal``; returns for which sets they are enough.  At the last deal empty
        segments make entries too, which is always enough."""
        last = deal == DEALS - 1
        number = np.flatnonzero(use)
        plain, loose = self.plain[scheme[number]], self.loose[scheme[number]]
        first = np.concatenate([[0], np.cumsum(plain + loose)])
        local = np.full(len(use), -1)
        local[number] = np.arange(len(number))
        take = take & use[sets]
        v, s = keys[take], local[sets[take]]
        spread = mix(v + np.uint64(deal + 1))
        segment = (spread >> np.uint64(20)) % (plain + loose)[s].astype(np.uint64)
        at = first[s] + segment.astype(np.int64)
        low = np.bincount(at, (spread & np.uint64(0xFFFFFFFF)).astype(float), first[-1])
        high = np.bincount(at, (spread >> np.uint64(32)).astype(float), first[-1])
        total = low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))
        size = np.bincount(at, minlength=first[-1])
        owner = np.repeat(np.arange(len(number)), plain + loose)
        place = np.arange(first[-1]) - first[owner]
        is_loose = place >= plain[owner]
        salt = mix((scheme[number][owner] * 64 + deal).astype(np.uint64) + (place.astype(np.uint64) << np.uint64(16)))
        useful = np.where(is_loose, np.where(size >= 2, 2, 0), np.where(size >= 1, 1, 0))
        # So much of the allowances a set can lose and still meet every partner.
        spare = np.bincount(owner, useful, len(number)).astype(np.int64) - self.h[scheme[number]] - 1
        enough = spare >= 0
        index = scheme[number] * DEALS + deal
        emit = size > 0
        if last:
            emit |= ~enough[owner]


        def add(hashes, at):
            own = owner[at]
            out.append((mix(hashes ^ salt[at]), number[own], index[own], 1 + is_loose[at], spare[own]))

        add(total[emit], np.flatnonzero(emit))
        lone = is_loose[at] & ((size[at] >= 2) | (last & ~enough[s]))
        if lone.any():
            add(total[at[lone]] - spread[lone], at[lone])
        found = np.zeros(len(use), bool)
        found[number[enough]] = True
        return found


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of more than :data:`COMMON` of the documents looked at, ascending.

    Their number is bounded by the mean number of shingles of a document over COMMON.
    """

    def run(batches):
        for batch in batches:
            counted = []
            for part in slices([batch]):
                keys, _ = shingle_sets(texts_of(part.column("text")))
                counted.append(np.unique(keys, return_counts=True))
            if counted:
                keys, at = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in counted]).astype(float), len(keys))
                often = n > max(1, COMMON / 4 * batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[often].view(np.int64)), pa.array(n[often].astype(np.int64))],
                    names=["shingle", "n"],
                )

    looked = docs.filter(F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(LOOK)) == 0)
    least = max(4.0, looked.count() * COMMON)
    found = (
        looked.select("text")
        .mapInArrow(run, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > least)
        .select("shingle")
        .toArrow()
    )
    return np.sort(found["shingle"].to_numpy().astype(np.int64).view(np.uint64))


#: Entries that a task gathers before it passes them on, and sets whose copies it leaves out.
GATHERED, REMEMBERED = 250_000, 200_000
#: Bytes of text for each bucket of entries: they take as much room as the text and several
#: times that while they are sorted, and a worker holds a whole bucket.
ENTRY_BYTES = 4 << 20

#: An entry: hash of a segment, node and size of the set, index, allowance of the segment,
#: and the allowances to spare of the set in that index.
ENTRY = np.dtype(
    [("hash", "u8"), ("node", "i8"), ("size", "i4"), ("index", "u2"), ("allowance", "u1"), ("spare", "i2")]
)
_PACK = "bucket int, entries binary"
_PAIRS = "a long, b long, hash long, size int, index int, allowance int, spare int"


def _entries(n: int, index: Index):
    """Documents -> packed entries by bucket; equal sets count once in a task."""

    def emit(gathered):
        entries = np.concatenate(gathered)
        gathered.clear()  # several copies of the entries would stand side by side below
        part = (entries["hash"] % np.uint64(n)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        entries, part = entries[order], part[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(part[cuts], pa.int32()), pa.array([e.tobytes() for e in np.split(entries, cuts[1:])])],
            names=["bucket", "entries"],
        )

    def run(batches):
        gathered, held, seen = [], 0, set()
        for part in slices(batches):
            keys, ends = shingle_sets(texts_of(part.column("text")))
            nodes = signatures(keys, ends)
            new = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                if node not in seen:
                    seen.add(node)
                    new[i] = True
            keep = np.repeat(new, np.diff(ends))
            sizes = np.where(new, np.diff(ends), 0)
            hashes, owner, number, allowance, spare = index.entries(
                keys[keep], np.concatenate([[0], np.cumsum(sizes)])
            )
            if len(hashes):
                made = np.empty(len(hashes), ENTRY)
                made["hash"], made["node"], made["size"] = hashes, nodes[owner], sizes[owner]
                made["index"], made["allowance"], made["spare"] = number, allowance, np.minimum(spare, 30_000)
                gathered.append(made)
                held += len(made)
            if held > GATHERED:
                yield emit(gathered)
                gathered, held = [], 0
            if len(seen) > REMEMBERED:
                seen = set()
        if gathered:
            yield emit(gathered)

    return run


def _pair_up(table: pa.Table) -> pa.Table:
    """Entries of a bucket -> candidate pairs.

    Groups of up to :data:`SMALL_GROUP` sets give all pairs that sizes allow (``hash`` null).
    Of a larger group every set gives one row (``a`` null), for :func:`_stars`.
    """
    entries = np.frombuffer(b"".join(table["entries"].to_pylist()), dtype=ENTRY)
    order = np.lexsort((entries["node"], entries["hash"]))
    hashes, nodes = entries["hash"][order], entries["node"][order]
    new = np.ones(len(nodes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1])
    order, hashes, nodes = order[new], hashes[new], nodes[new]
    first = np.ones(len(nodes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    begin = np.flatnonzero(first)
    count = np.diff(begin, append=len(nodes))
    rank = np.arange(len(nodes)) - np.repeat(begin, count)
    group = np.repeat(count, count)
    left, right = [], []
    for step in range(1, SMALL_GROUP):
        at = np.flatnonzero((group <= SMALL_GROUP) & (rank + step < group))
        left.append(at)
        right.append(at + step)
    a, b = np.concatenate(left), np.concatenate(right)
    size = entries["size"][order].astype(np.int64)
    near = 100 * np.minimum(size[a], size[b]) >= SIMILARITY * np.maximum(size[a], size[b])
    pairs = np.unique(np.stack([nodes[a[near]], nodes[b[near]]]), axis=1)
    large = np.flatnonzero(group > SMALL_GROUP)
    a = pa.concat_arrays([pa.array(pairs[0]), pa.nulls(len(large), pa.int64())])
    b = np.concatenate([pairs[1], nodes[large]])
    none = pa.nulls(len(pairs[0]), pa.int32())
    more = {
        c: pa.concat_arrays([none, pa.array(entries[c][order][large].astype(np.int32))])
        for c in ("size", "index", "allowance", "spare")
    }
    mark = pa.array(hashes[large].view(np.int64), pa.int64())
    return pa.table(
        {"a": a, "b": b, "hash": pa.concat_arrays([pa.nulls(len(pairs[0]), pa.int64()), mark])} | more
    )


def _compared(part: pa.RecordBatch, known: dict[int, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The shingles of both documents of each pair; ``known`` keeps those of late."""
    a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
    for nodes, name in ((a, "text_a"), (b, "text_b")):
        missing = {x: i for i, x in enumerate(nodes) if x not in known}
        if len(known) + len(missing) > 2000:
            for x in known.keys() - {*a, *b}:
                del known[x]
        texts = texts_of(part.column(name).take(pa.array(list(missing.values()), pa.int64())))
        keys, ends = shingle_sets(texts)
        for i, x in enumerate(missing):
            known[x] = keys[ends[i] : ends[i + 1]]
    return [(known[x], known[y]) for x, y in zip(a, b)]


def _verify(batches):
    """Pairs with both texts -> the pairs that link."""
    known: dict[int, np.ndarray] = {}
    for part in slices(slices(batches, "text_a"), "text_b"):
        same = [
            links(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
            for x, y in _compared(part, known)
        ]
        yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))


def _measure(batches):
    """Stars with both texts -> whether they link, and the shingles only one of the two has."""
    known: dict[int, np.ndarray] = {}
    for part in slices(slices(batches, "text_a"), "text_b"):
        linked, apart = [], []
        for a, b in _compared(part, known):
            apart.append(np.setxor1d(a, b, assume_unique=True).view(np.int64))
            linked.append(links((len(a) + len(b) - len(apart[-1])) // 2, len(a), len(b)))
        columns = [part.column(c) for c in ("family", "a", "b", "size")]
        columns += [pa.array(linked, pa.bool_()), pa.array(apart, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["family", "a", "b", "size", "linked", "apart"])


_STARS = "family long, a long, b long, size int, linked boolean, apart array<long>"


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles and component_id of every document.

    A document's set holds its distinct shingles of :data:`SHINGLE` words (A-Z as a-z); with
    fewer words the whole sequence is one; without words the set is empty and links with
    nothing.  component_id is the smallest key reachable by links, the document's own
    included.  Repeated rows give a row each.  Rows without a key get a null component and
    link with nothing.  Other columns are left out; an empty table gives no rows.

    Shingles are compared by 64-bit hashes; documents with the same set are one node, named
    by a hash of the set.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    known = rows.filter(F.col("doc").isNotNull())

    def describe(batches):
        for part in slices(batches):
            keys, ends = shingle_sets(texts_of(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(np.diff(ends), pa.int64()), pa.array(signatures(keys, ends))],
                names=["doc", "n_shingles", "node"],
            )

    described = stage(rows.mapInArrow(describe, "doc long, n_shingles long, node long"), "sets")
    filled = described.filter("doc IS NOT NULL AND n_shingles > 0")
    named = filled.groupBy("node").agg(F.min("doc").alias("name"))

    n = buckets(known, per=ENTRY_BYTES)
    index = Index(common_shingles(known))
    entries = known.mapInArrow(_entries(n, index), _PACK)
    pairs = stage(entries.groupBy("bucket").applyInArrow(_pair_up, _PAIRS), "pairs")

    wanted = pairs.filter("hash IS NULL").select("a", "b").distinct()
    found = stage(components(stage(_verified(wanted, named, known), "linked")), "components")
    large = pairs.filter("hash IS NOT NULL").withColumnRenamed("b", "node")
    groups = stage(_dependent(large), "groups")
    sets, step = named.count(), 0
    while not groups.isEmpty():
        step += 1
        stars = _with_texts(_stars(groups, step == 1), named, known).mapInArrow(_measure, _STARS)
        stars = stage(stars, "stars")
        found = _joined(found, stars.filter("linked").select("a", "b"))
        members = stage(_centred(_mixed(stars, found)), "mixed")
        groups = stage(_outside(members), "groups")
        large = groups.filter(F.col("n") > SMALL_OUTSIDE)
        left = large.select(F.sum((F.col("n") - 1) / 2)).first()[0] or 0
        whole = left <= PAIRS_PER_SET * sets * step
        small = groups if whole else groups.filter(F.col("n") <= SMALL_OUTSIDE)
        sure = members.filter("near AND b <> hub").select(F.col("hub").alias("a"), "b")
        found = _joined(found, stage(sure.union(_across(members, small)), "linked"))
        if whole:
            break
        groups = large

    smallest = (
        named.join(found, "node")
        .groupBy("component")
        .agg(F.min("name").alias("least"))
    )
    of_node = found.join(smallest, "component").select("node", "least")
    joined = described.join(named, "node", "left").join(of_node, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("least", "name")).otherwise(F.col("doc"))
    return joined.select(
        F.col("doc").alias(key),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), own).alias("component_id"),
    )


def _joined(found: DataFrame, linked: DataFrame) -> DataFrame:
    """The components after more links; works on the components they connect alone."""
    ends = linked.select(F.col("a").alias("node")).union(linked.select("b")).distinct()
    new = ends.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    a, b = (found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    lifted = (
        linked.join(a, "a", "left")
        .join(b, "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )
    lifted = stage(lifted, "lifted")
    if lifted.isEmpty():
        return found
    merged = components(lifted).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    whole = found.select("node", "component").union(new).join(merged, "component", "left")
    return stage(whole.select("node", F.coalesce("whole", "component").alias("component")), "components")


def _dependent(groups: DataFrame) -> DataFrame:
    """The large groups, with the sets that need them.

    A set that does without its large groups and has allowances enough left meets all its
    partners in small ones.  So only pairs of sets that both depend on large groups count.
    """
    depends = (
        groups.groupBy("node", "index")
        .agg(F.sum("allowance").alias("lost"), F.min("spare").alias("spare"))
        .filter("lost > spare")
        .select("node", "index")
    )
    return groups.join(depends, ["node", "index"]).select(F.lit(0).cast("long").alias("family"), "hash", "node", "size", F.lit(None).cast("long").alias("members"))


def _stars(groups: DataFrame, first: bool) -> DataFrame:
    """Each set of a group with the group's centre, the set that shares most groups with
    most others.  Groups of one centre become one family.

    The ``first`` time, a group takes over the best centre that its sets have in any group:
    a group of near copies that share an edit joins the family of all near copies.  Later a
    centre is always one of the group, and groups of one centre stay families of their own
    where together they hold more than three quarters of the family (``members`` sets) they
    are part of.  A group alone has half of it at most (see :func:`_centred`), so families
    shrink by a quarter at least and the steps come to an end.
    """
    counts = groups.groupBy("family", "hash").agg(F.count("*").alias("n"))
    weighed = groups.select("family", "hash", "node", "size", "members").join(counts.filter("n > 1"), ["family", "hash"])
    weighed = stage(weighed, "weighed")
    best = weighed.groupBy("family", "node").agg(
        F.struct(F.sum("n").alias("score"), F.col("node").alias("a")).alias("best")
    )

    def of_groups(best):
        placed = weighed.select("family", "hash", "node").join(best, ["family", "node"])
        return placed.groupBy("family", "hash").agg(F.max("best").alias("best"))

    centre = of_groups(best)
    if first:
        placed = weighed.select("family", "hash", "node").join(centre, ["family", "hash"])
        centre = of_groups(placed.groupBy("family", "node").agg(F.max("best").alias("best")))
    placed = weighed.join(centre.select("family", "hash", "best.a"), ["family", "hash"])
    name = F.xxhash64("family", "a")
    if not first:
        together = placed.groupBy("family", "a").agg(
            (4 * F.count_distinct("node") > 3 * F.max("members")).alias("wide")
        )
        placed = placed.join(together, ["family", "a"])
        name = F.when(F.col("wide"), F.xxhash64("family", "a", "hash")).otherwise(name)
    return (
        placed.filter("node <> a")
        .groupBy(name.alias("family"), "a", F.col("node").alias("b"))
        .agg(F.min("size").alias("size"))
    )


def _mixed(stars: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the families that are not in one component yet, with their component.
    The usual family of near copies of one text is in one and gives nothing."""
    placed = stars.join(found.withColumnRenamed("node", "b"), "b", "left").withColumn(
        "component", F.coalesce("component", "b")
    )
    mixed = (
        placed.groupBy("family")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo <> hi")
        .select("family")
    )
    return placed.join(mixed, "family")


#: Two sets link when they differ in few shingles for their sizes: TOTAL * |A xor B| <=
#: FREE * (|A| + |B|).
TOTAL, FREE = 100 + SIMILARITY, 100 - SIMILARITY


def _centred(members: DataFrame) -> DataFrame:
    """Members with the shingles in which they differ from what most of their family hold
    (``apart``), so that each of these shingles sets half of the family apart at most.

    With slack(A) = FREE * |A| - TOTAL * |apart(A)|, A and B link if and only if their apart
    shingles have at least -(slack(A) + slack(B)) / (2 * TOTAL) in common.  Where that is
    nothing, both link with the set of most slack (``hub``), and they are ``near`` it.
    """
    sizes = members.groupBy("family").agg(F.count("*").alias("members"))
    usual = (
        members.select("family", F.explode("apart").alias("hash"))
        .groupBy("family", "hash")
        .agg(F.count("*").alias("n"))
        .join(sizes, "family")
        .filter("2 * n > members")
        .groupBy("family")
        .agg(F.collect_list("hash").alias("usual"))
    )
    apart = "CASE WHEN usual IS NULL THEN apart ELSE concat(array_except(apart, usual), array_except(usual, apart)) END"
    moved = members.join(usual, "family", "left").withColumn("apart", F.expr(apart)).drop("usual")
    slack = f"CAST({FREE} AS bigint) * size - CAST({TOTAL} AS bigint) * size(apart)"
    moved = stage(moved.withColumn("slack", F.expr(slack)), "moved")
    best = moved.groupBy("family").agg(
        F.max(F.struct("slack", "b")).alias("best"), F.count("*").alias("members")
    )
    return moved.join(best, "family").select(
        "family", "b", "size", "component", "linked", "apart", "slack", "members",
        F.col("best.b").alias("hub"),
        F.expr("slack + best.slack >= 0").alias("near"),
        F.expr(f"greatest(1, ceil(-(slack + best.slack) / {2 * TOTAL}))").alias("need"),
    )


def _outside(members: DataFrame) -> DataFrame:
    """Members of a family by the shingles that set them apart, as groups of ``n`` sets.

    Two sets that link, but are not both near the hub, have at least ``need`` of these in
    common.  So it is enough to look each up by its first ones, in one order for the family,
    up to the number that leaves fewer than that (``after``: how many are left, itself
    included).  Shingles that tell no components apart come first, then rare ones.
    """
    held = members.select(
        "family", F.explode("apart").alias("hash"), F.col("b").alias("node"), "component", "linked", "near"
    )
    told = held.groupBy("family", "hash").agg(
        F.expr(
            "CASE WHEN min(component) <> max(component) AND NOT min(linked) AND NOT min(near)"
            " THEN count(*) ELSE 0 END AS often"
        )
    )
    ranked = held.select("family", "hash", "node").join(told, ["family", "hash"])
    place = F.row_number().over(Window.partitionBy("family", "node").orderBy("often", "hash"))
    own = members.select(
        "family", F.col("b").alias("node"), "size", "component", "linked", "near", "slack", "members",
        F.size("apart").alias("held"), "need",
    )
    first = (
        ranked.withColumn("place", place)
        .filter("often > 0")
        .join(own, ["family", "node"])
        .filter("place <= held - need + 1")
        .withColumn("after", F.expr("held - place + 1"))
        .drop("often", "place", "held", "need")
    )
    together = Window.partitionBy("family", "hash")
    return first.withColumn("n", F.count("*").over(together)).filter("n > 1")


def _across(members: DataFrame, small: DataFrame) -> DataFrame:
    """The links between different components that these groups of :func:`_outside` give."""
    fits = f"100 * least(x.size, y.size) >= {SIMILARITY} * greatest(x.size, y.size)"
    enough = f"{2 * TOTAL} * least(x.after, y.after) + x.slack + y.slack >= 0"
    open_ = "x.component <> y.component AND NOT (x.linked AND y.linked) AND NOT (x.near AND y.near)"
    pairs = (
        small.alias("x")
        .join(
            small.alias("y"),
            F.expr(f"x.family = y.family AND x.hash = y.hash AND x.node < y.node AND {open_} AND {fits} AND {enough}"),
        )
        .select("x.family", F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )
    a, b = (
        members.select("family", F.col("b").alias(x), F.col("apart").alias(f"apart_{x}"), F.col("slack").alias(f"slack_{x}"))
        for x in "ab"
    )
    return (
        pairs.join(a, ["family", "a"])
        .join(b, ["family", "b"])
        .filter(f"{2 * TOTAL} * size(array_intersect(apart_a, apart_b)) + slack_a + slack_b >= 0")
        .select("a", "b")
    )


def _of_node(batches):
    """The rows whose text has the signature ``node``; one id may stand on several texts."""
    for batch in batches:
        for part in slices([batch]):
            own = signatures(*shingle_sets(texts_of(part.column("text"))))
            yield part.select(["doc", "text", "node"]).filter(pa.array(own == part.column("node").to_numpy()))


def _with_texts(pairs: DataFrame, named: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (nodes a and b) with a text of each node."""
    pairs = stage(pairs, "stars")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = stage(
        docs.join(named.join(nodes, "node").withColumnRenamed("name", "doc"), "doc")
        .mapInArrow(_of_node, "doc long, text string, node long")
        .dropDuplicates(["node"])
        .select("node", "text"),
        "texts",
    )
    return pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    )


def _verified(pairs: DataFrame, named: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (nodes a < b) whose documents' sets link."""
    return (
        _with_texts(pairs, named, docs)
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify, "a long, b long")
    )
