"""Exact top-k search by inner product, one term at a time.

Terms are vector components.  Candidates are dealt into blocks; in a block each term has a
posting list (places and weights).  A query's non-zero terms scatter ``weight * posting``
into the block's dense score array, a partition selection takes the best k of the block,
and Spark merges the blocks' lists.  Every query meets every block, so nothing is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block of candidates and of a block of queries: what a task holds at once.
CANDIDATES, QUERIES = 8192, 2048


def quantise(embedding: Column) -> Column:
    """floor(256 * x) of every component, null where the vector or a component is null or
    not finite."""
    fine = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(256.0)))
    return F.when(embedding.isNotNull() & fine, scaled)


class Postings:
    """The terms of a block of vectors: for each the places that have it, and its weights."""

    def __init__(self, weight: np.ndarray, lengths: np.ndarray):
        place = np.repeat(np.arange(len(lengths)), lengths)
        term = np.arange(len(place)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        held = weight != 0
        place, term, weight = place[held], term[held], weight[held]
        order = np.argsort(term, kind="stable")
        place, term, weight = place[order], term[order], weight[order]
        cuts = np.searchsorted(term, np.arange(int(lengths.max(initial=0)) + 1))
        self.lists = [(place[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.n = len(lengths)

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner products of a query with the block's vectors; missing components are 0."""
        out = np.zeros(self.n, np.int64)
        for term in np.flatnonzero(query[: len(self.lists)]):
            place, weight = self.lists[term]
            if len(place) == self.n:  # each place once and in order
                out += query[term] * weight
            else:
                out[place] += query[term] * weight
        return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        equal = equal[np.argsort(ids[equal], kind="stable")[: k - len(above)]]
        return np.concatenate([above, equal])
    return np.arange(len(scores))


def _vectors(column: pa.ChunkedArray, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The components of a column of vectors one after another, and each vector's length."""
    lists = column.combine_chunks()
    if copies is not None:
        lists = lists.take(pa.array(np.repeat(np.arange(len(copies)), copies)))
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().astype(np.int64)


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        copies = candidates["copies"].to_numpy()
        ids = np.repeat(candidates["vec_id"].to_numpy(), copies)
        asked = queries["query_id"].to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(asked):
            block = Postings(*_vectors(candidates["vector"], copies))
            weights, lengths = _vectors(queries["vector"])
            for number, vector in zip(asked, np.split(weights, np.cumsum(lengths)[:-1])):
                own = ids != number
                scores = block.scores(vector)[own]
                top = best(scores, ids[own], k)
                found.append((np.full(len(top), number), ids[own][top], scores[top]))
        columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each query its k best candidates.

    ``vectors`` needs vec_id and embedding.  Queries are the rows whose vec_id is divisible
    by ``every``; candidates are all rows but those with the query's own vec_id.  The score
    is the integer inner product of the quantised vectors, over the components that both
    have.  Ties go to the smaller vec_id.  Rows with a null id, a null vector or a
    component that is null or not finite take no part; empty vectors score 0.  Repeated
    rows are candidates one by one, but one query: of several vectors under one query id
    the smallest asks.  Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), quantise(F.col("embedding")).alias("vector")
    ).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("vector").alias("vector"))
    )
    # Equal rows travel once, with their number: no more than k of them can be among the k
    # best.  So blocks cut by a hash of the row itself stay bounded, and a task that runs
    # again deals each row to the same block.  Two counts come to the driver.
    distinct = rows.groupBy("vec_id", "vector").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
    n = vectors.select(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    blocks, groups = (max(1, -(-(n[i] or 0) // size)) for i, size in ((0, CANDIDATES), (1, QUERIES)))
    spread = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))
    candidates = distinct.withColumn("block", spread.cast("int"))
    left = asked.withColumn(
        "group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = candidates.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = (
        left.groupBy("block", "group")
        .cogroup(right.groupBy("block", "group"))
        .applyInArrow(_search(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
