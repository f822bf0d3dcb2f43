"""Mixing sources to target weights, as a minimum-cost flow over membership patterns.

Documents that belong to the same set of sources form one pattern; only the patterns' word
counts go to the flow, so its size does not depend on the number of documents.  Words flow
from patterns to the sources' targets.  The first use of a pattern's words costs nothing, and
every further pass over them costs more than the one before (convex), so no document is
repeated while words that were used less often could serve.  Then whole documents are taken
in a seeded order until every pattern has given what the flow asks of it.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweft.llm.common import count_words, stage

#: How often a document may be used at most.
PASSES = 3
#: Parts into which the seeded order of a pattern is cut; only the part that holds the cut
#: is sorted document by document.
PARTS = 4096
#: Weights of the sources, in the order of their names, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Patterns that may come to the driver, some tens of MB of names at most, and those of them
#: that may need the flow; beyond either number a mix is refused.
PATTERNS, OVERLAPPING = 200_000, 2_000


def targets(sizes: dict, weights: dict) -> dict:
    """Words wanted of each source: the sum of ``sizes`` shared by weight, at most
    :data:`PASSES` times a source's own; what that cuts off is shared again by weight."""
    out: dict = {}
    left, total = float(sum(sizes.values())), float(sum(weights.values()))
    # Sources reach their limit in the order of limit / weight; the rest share what is left.
    for s in sorted(sizes, key=lambda s: PASSES * sizes[s] / weights[s]):
        share = left * weights[s] / total if total > 0 else 0.0
        out[s] = min(share, float(PASSES * sizes[s]))
        left, total = left - out[s], total - weights[s]
    return out


def min_cost_flow(
    capacity: list[int], wanted: list[int], members: list[tuple[int, ...]], passes: int = PASSES
) -> list[dict[int, int]]:
    """Words that each pattern gives to each of its sources.

    Pattern i has ``capacity[i]`` words, may give them ``passes`` times and belongs to the
    sources ``members[i]``; source j wants ``wanted[j]``.  Pass p costs p a word.  Successive
    shortest paths with potentials: as much as can be delivered is, at the least cost.
    """
    n, m = len(capacity), len(wanted)
    start, end = n + m, n + m + 1
    edges: list[list[int]] = []  # to, room, cost, number of the opposite edge
    leaving: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a: int, b: int, room: int, cost: int) -> int:
        leaving[a].append(len(edges))
        edges.append([b, room, cost, len(edges) + 1])
        leaving[b].append(len(edges))
        edges.append([a, 0, -cost, len(edges) - 1])
        return len(edges) - 2

    for i, words in enumerate(capacity):
        for p in range(passes):
            add(start, i, words, p)
    routes = {(i, j): add(i, n + j, passes * capacity[i], 0) for i in range(n) for j in members[i]}
    for j, words in enumerate(wanted):
        add(n + j, end, words, 0)

    height = [0] * (n + m + 2)
    while True:
        reached: dict[int, int] = {}
        via: dict[int, int] = {}
        queue = [(0, start, -1)]
        while queue:
            d, a, e = heapq.heappop(queue)
            if a in reached:
                continue
            reached[a] = d
            via[a] = e
            for k in leaving[a]:
                b, room, cost, _ = edges[k]
                if room > 0 and b not in reached:
                    heapq.heappush(queue, (d + cost + height[a] - height[b], b, k))
        if end not in reached:
            break
        for a in range(len(height)):
            height[a] += min(reached.get(a, reached[end]), reached[end])
        path, a = [], end
        while a != start:
            path.append(via[a])
            a = edges[edges[via[a]][3]][0]
        amount = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= amount
            edges[edges[k][3]][1] += amount
    given: list[dict[int, int]] = [{} for _ in capacity]
    for (i, j), k in routes.items():
        if edges[k + 1][1]:
            given[i][j] = edges[k + 1][1]
    return given


def shares(
    capacity: list[int], wanted: list[int], members: list[tuple[int, ...]], passes: int = PASSES
) -> list[dict[int, int]]:
    """As :func:`min_cost_flow`.  Sources that no overlapping pattern reaches take what they
    want of their one pattern, repeated as often as needed; the flow settles the others."""
    shared = {j for m in members if len(m) > 1 for j in m}
    flowing = [i for i, m in enumerate(members) if shared.intersection(m)]
    if len(flowing) > OVERLAPPING:
        raise ValueError(f"{len(flowing)} patterns of overlapping sources, more than {OVERLAPPING}")
    given: list[dict[int, int]] = [{} for _ in capacity]
    for i, m in enumerate(members):
        if m[0] not in shared and (words := min(wanted[m[0]], passes * capacity[i])):
            given[i] = {m[0]: words}
    ids = sorted(shared)
    place = {j: k for k, j in enumerate(ids)}
    flow = min_cost_flow(
        [capacity[i] for i in flowing],
        [wanted[j] for j in ids],
        [tuple(place[j] for j in members[i]) for i in flowing],
        passes,
    )
    for i, g in zip(flowing, flow):
        given[i] = {ids[k]: words for k, words in g.items()}
    return given


def _rounded(wanted: list[float]) -> list[int]:
    """Whole words for targets, their sum kept."""
    ends = np.rint(np.cumsum(wanted)).astype(np.int64)
    return np.diff(ends, prepend=0).tolist()


def mix(
    docs: DataFrame,
    members: Column,
    weights: tuple[float, ...] = WEIGHTS,
    seed: int = 11,
    keep: tuple[str, ...] = ("doc_id",),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``keep`` columns, size, source_size, target and taken of every row of ``docs``.

    ``members``: an array of the sources a row belongs to (a null element is a source of its
    own, sorted last; a null or empty array counts as that source).  ``weights`` go to the
    sources in order of code points, repeating.  size is the number of words (null: 0).
    source_size and target are sums over the row's sources.  taken is the number of words
    the mix takes of the row, repeats counted, at most :data:`PASSES` times its size: whole
    passes over a pattern first, then rows in the order of a seeded hash, the last of them
    in part, so that the sources' targets are met to the word.  Reruns agree; of repeated
    rows any may be the one that is cut.  An empty table gives no rows.  ``keep`` may have any names;
    columns named like one of the four numbers give way to it.

    One row per pattern comes to the driver: their number depends on the sources, not on the
    documents.  More than :data:`PATTERNS` of them, or more than :data:`OVERLAPPING` that share
    sources with others, raise a ValueError; nothing is left out instead.
    """
    names = F.when(F.size(members) > 0, members).otherwise(F.array(F.lit(None).cast("string")))
    # Null and names must sort together: null travels as an empty array, a name as one element.
    pattern = F.array_sort(
        F.array_distinct(F.transform(names, lambda s: F.when(s.isNull(), F.array().cast("array<string>")).otherwise(F.array(s))))
    )
    # Rows without a key are told apart by their text; a null leaves a hash as it is.
    order = F.xxhash64(F.col(f"`{key}`"), F.when(F.col(f"`{key}`").isNull(), F.col(f"`{text}`")), F.lit(seed))
    own = ("size", "source_size", "target", "taken")
    names_kept = [c for c in keep if c not in own]
    rows = docs.select(
        # One struct: its columns may have any names.
        F.struct(*[F.col(f"`{c}`") for c in names_kept]).alias("kept"),
        count_words(text).alias("size"),
        pattern.alias("pattern"),
        order.alias("place"),
        F.pmod(order, F.lit(PARTS)).cast("int").alias("part"),
    )
    # Words are counted once; what follows reads a few numbers per document.
    rows = stage(rows, "mix-sizes")
    parts = rows.groupBy("pattern", "part").agg(F.sum("size").alias("words"))
    found = [
        (tuple(x[0] if x else None for x in r.pattern), r.words or 0)
        for r in parts.groupBy("pattern").agg(F.sum("words").alias("words")).limit(PATTERNS + 1).collect()
    ]
    if len(found) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} patterns of sources")
    found.sort(key=lambda f: [(s is None, s or "") for s in f[0]])
    sources = sorted({s for p, _ in found for s in p}, key=lambda s: (s is None, s or ""))
    sizes = dict.fromkeys(sources, 0)
    for p, words in found:
        for s in p:
            sizes[s] += words
    total = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    wanted = targets(sizes, total)
    number = {s: j for j, s in enumerate(sources)}
    flow = shares(
        [w for _, w in found],
        _rounded([wanted[s] for s in sources]),
        [tuple(number[s] for s in p) for p, _ in found],
    )
    plan = [
        (
            [[s] if s is not None else [] for s in p],
            sum(sizes[s] for s in p),
            float(sum(wanted[s] for s in p)),
            sum(given.values()) // words if words else 0,
            sum(given.values()) % words if words else 0,
        )
        for (p, words), given in zip(found, flow)
    ]
    schema = T.StructType(
        [
            rows.schema["pattern"],
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
            T.StructField("passes", T.LongType()),
            T.StructField("rest", T.LongType()),
        ]
    )
    spark = docs.sparkSession
    # As small as the collected patterns it was made of.
    plan = F.broadcast(spark.createDataFrame(plan, schema))
    running = Window.partitionBy("pattern").orderBy("part")
    cuts = (
        parts.join(plan, "pattern")
        .withColumn("before", F.sum("words").over(running) - F.col("words"))
        # The part in which a pattern's last pass ends; parts before it are taken whole.
        .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
        .groupBy("pattern")
        .agg(F.min("part").alias("cut"), F.min("before").alias("before"))
    )
    plan = plan.join(F.broadcast(cuts), "pattern", "left")
    planned = rows.join(F.broadcast(plan), "pattern")
    inner = Window.partitionBy("pattern").orderBy("place", "kept", "size")
    cut = (
        planned.filter(F.col("part") == F.col("cut"))
        .withColumn("until", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "extra",
            F.least(
                F.col("size"),
                F.greatest(F.lit(0), F.col("rest") - F.col("before") - F.col("until") + F.col("size")),
            ),
        )
        .drop("until")
    )
    whole = planned.filter(F.coalesce(F.col("part") != F.col("cut"), F.lit(True))).withColumn(
        "extra", F.when(F.col("part") < F.col("cut"), F.col("size")).otherwise(0)
    )
    taken = (F.col("size") * F.col("passes") + F.col("extra")).cast("long").alias("taken")
    mixed = whole.unionByName(cut)
    return mixed.select(*[F.col(f"kept.`{c}`") for c in names_kept], "size", "source_size", "target", taken)
