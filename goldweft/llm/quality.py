"""Quality scores from compression: which of two dictionaries fits a text better?

One zstandard dictionary is built from texts labelled good, one from texts labelled bad.
A text is compressed with either, in blocks, and the difference of the two sizes over the
text's own size is turned into a probability by a logistic curve, fitted on labelled texts
that no dictionary has seen.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import slices, texts_of

#: Bounds of the training sample: rows of each label, and characters of a training text, which
#: a longer text gives in as many pieces, spread evenly from its start to its end.  Half of
#: the rows build the dictionaries, half fit the curve.
SAMPLE_ROWS = 1200
SAMPLE_CHARS, PIECES = 20_000, 10
DICTIONARY_BYTES = 110 << 10
#: Bytes that are compressed at a time, so that a dictionary counts alike all along a text.
BLOCK = 2048
LEVEL = 3
#: Added to a text's size: a few bytes of difference say little about a short text.
CALM = 256


def held_out(key: Column) -> Column:
    """Rows that training must not see: crc32 of the key's text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


class Scorer:
    """Scores texts with two dictionaries and a logistic curve."""

    def __init__(self, good: bytes, bad: bytes, slope: float, offset: float):
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset
        self.sides: list | None = None

    def __getstate__(self):
        return self.__dict__ | {"sides": None}

    def difference(self, text: bytes) -> float:
        """(size by the bad dictionary - size by the good one) / (size of the text + CALM)."""
        if not self.good or not self.bad or not text:
            return 0.0
        if self.sides is None:
            self.sides = []
            for content in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(content)
                d.precompute_compress(level=LEVEL)
                self.sides.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False
                    ).compress
                )
        good, bad = self.sides
        total = 0
        for i in range(0, len(text), BLOCK):
            block = text[i : i + BLOCK]
            total += len(bad(block)) - len(good(block))
        return total / (len(text) + CALM)

    def score(self, text: bytes) -> float:
        z = self.slope * self.difference(text) + self.offset
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def build_dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of at most :data:`DICTIONARY_BYTES`; with too few texts to train one,
    the texts themselves."""
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY_BYTES]


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression (Newton steps, slightly damped)."""
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        ridge = np.diag([1e-3, 1e-6])
        gradient = design.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def excerpt(text: Column) -> Column:
    """A text of at most :data:`SAMPLE_CHARS` whole; of a longer one evenly spread pieces."""
    piece = SAMPLE_CHARS // PIECES
    step = (F.length(text) - piece) / F.lit(PIECES - 1)
    pieces = [F.substr(text, F.floor(step * i).cast("int") + 1, F.lit(piece)) for i in range(PIECES)]
    return F.when(F.length(text) <= SAMPLE_CHARS, text).otherwise(F.concat(*pieces))


def sample(docs: DataFrame, labels: DataFrame) -> dict[int, tuple[int, list[bytes]]]:
    """Of each label: how many documents may be learnt from, and the texts of a bounded
    sample of them (the smallest seeded hashes, so reruns agree)."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")  # labels that contradict each other teach nothing
    )
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    found = {}
    for label in (0, 1):
        ids = (
            known.filter(F.col("quality") == label)
            .orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
            .limit(SAMPLE_ROWS)
            .select("doc_id")
        )
        rows = (
            docs.select("doc_id", "text")
            .filter(F.octet_length("text") > 0)
            .join(F.broadcast(ids), "doc_id")  # SAMPLE_ROWS ids at most
            .groupBy("doc_id")
            .agg(F.min(excerpt(F.col("text"))).alias("text"))
            .orderBy(F.xxhash64("doc_id", F.lit(18)), "doc_id")
        )
        found[label] = (counts.get(label, 0), [r.text.encode() for r in rows.collect()])
    return found


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Fit a :class:`Scorer` on a bounded sample of the labelled documents.

    Without texts of both labels, the score is the share of good labels, or 0.5.
    """
    (n_bad, bad), (n_good, good) = (found := sample(docs, labels))[0], found[1]
    if len(bad) < 2 or len(good) < 2:
        share = (n_good + 1) / (n_good + n_bad + 2)
        return Scorer(b"", b"", 0.0, math.log(share / (1 - share)))
    scorer = Scorer(build_dictionary(good[::2]), build_dictionary(bad[::2]), 1.0, 0.0)
    x = np.array([scorer.difference(t) for t in [*good[1::2], *bad[1::2]]])
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    each = {1.0: n_good / max(1, y.sum()), 0.0: n_bad / max(1, (1 - y).sum())}
    weight = np.array([each[v] for v in y])
    scorer.slope, scorer.offset = fit_curve(x, y, weight * len(y) / weight.sum())
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Whole texts are read; null counts as empty, and an empty text gets the curve's value
    at no difference.  Repeated rows and null ids give a row each; other columns are left
    out; an empty table gives no rows.
    """

    def run(batches):
        for part in slices(batches):
            values = [scorer.score(t) for t in texts_of(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The rows of ``docs`` that the scorer takes for good, all columns unchanged."""
    names = docs.columns

    def run(batches):
        for part in slices(batches):
            good = [scorer.score(t) >= 0.5 for t in texts_of(part.column("text"))]
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema).select(*[f"`{c}`" for c in names])
