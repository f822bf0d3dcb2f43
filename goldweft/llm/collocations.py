"""Phrases whose words stand together more often than chance has it, by sampling.

A phrase of three words is frequent only if its two inner pairs are.  Instead of one pass a
length, a sample of the texts proposes pairs; one full pass then counts, exactly, every word,
every pair of frequent words (the proposed ones and the negative border, on which all others
lie) and every triple of two proposed pairs.  Where a pair of the border turns out frequent,
a further pass counts the triples that it opens, until none is left uncounted.  The sample
decides the work, never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldweft.llm import wordblocks as W
from goldweft.llm.common import slices, stage
from goldweft.llm.wordhash import mix

#: What ends a piece of text, and what stands between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b"\t"
#: One text of so many is in the sample, by a hash of the text.
SAMPLE = 4
#: Bits of the filter that tells tasks which pairs are proposed: 16 MB, whatever the input.
#: A fuller filter lets more triples be counted that need not be; counts stay exact.
FILTER_BITS = 27
#: Buckets of phrases for each bucket of words; there are more phrases than words.
PHRASE_BUCKETS = 4

_BREAK = b"\xff"  # occurs in no UTF-8 text
_TABLE = bytes.maketrans(
    PIECE_ENDS + BLANKS + bytes(range(65, 91)), _BREAK * len(PIECE_ENDS) + b" " * len(BLANKS) + bytes(range(97, 123))
)


def pieces_and_words(text: bytes) -> list[bytes]:
    """Words in order, A-Z in lower case, with a break where a piece ends."""
    return text.translate(_TABLE).replace(_BREAK, b" \xff ").split()


# -- words ---------------------------------------------------------------------------------


def _frequent_words(least: int):
    """For one bucket: words with ``least`` uses or more in their language, their numbers in
    each block, and the uses of all words."""

    def find(table: pa.Table) -> pa.Table:
        rows = list(zip(*[table.column(c).to_pylist() for c in ("block", "group", "bucket", "numbers", "words", "uses")]))
        totals: dict[tuple[str, str], int] = {}
        lists = []
        for _, lang, _, _, words, uses in rows:
            keys = [(lang, w) for w in W.words_of(words)]
            for key, n in zip(keys, W.large(uses).tolist()):
                totals[key] = totals.get(key, 0) + n
            lists.append(keys)
        place = {key: i for i, key in enumerate(k for k, n in totals.items() if n >= least)}
        out = []
        for (block, lang, bucket, numbers, _, _), keys in zip(rows, lists):
            at = np.array([place.get(key, -1) for key in keys], np.int64)
            if (at >= 0).any():
                here = np.diff(W.numbers_of(numbers)[at >= 0], prepend=0)
                out.append((block, bucket, W.tight(W.small(here)), W.tight(W.small(at[at >= 0])), lang, None, None, None))
        bucket = rows[0][2]
        out += [(None, bucket, None, None, key[0], i, key[1], totals[key]) for key, i in place.items()]
        sums: dict[str, int] = {}
        for (lang, _), n in totals.items():
            sums[lang] = sums.get(lang, 0) + n
        out += [(None, bucket, None, None, lang, None, None, n) for lang, n in sums.items()]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["block", "bucket", "numbers", "places", "lang", "place", "word", "f"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return find


_FOUND = "block long, bucket int, numbers binary, places binary, lang string, place long, word string, f long"
_CODED = "sampled boolean, ids binary, codes binary"


def _code(texts: pa.Table, found: pa.Table) -> pa.Table:
    """A block's texts as numbers of its frequent words from 1 on, with 0 for all that no
    phrase may cross: ends of texts and pieces, and words that are not frequent.  The texts of
    the sample are one row, the others another; ``ids`` are the words' ids everywhere."""
    rows = [
        (bucket, W.numbers_of(n), W.large(W.loose(p)))
        for bucket, n, p in zip(*[found.column(c).to_pylist() for c in ("bucket", "numbers", "places")])
    ]
    ids = np.concatenate([np.empty(0, np.int64), *[(np.int64(b) << 32) | p for b, _, p in rows]])
    numbers = np.concatenate([np.empty(0, np.int64), *[n for _, n, _ in rows]])
    sampled = W.keys_of(texts).to_pylist()
    out = {True: [np.zeros(1, np.int32)], False: [np.zeros(1, np.int32)]}
    begin = 0
    known = np.zeros(int(numbers.max(initial=-1)) + 1, np.int32)
    known[numbers] = np.arange(1, len(numbers) + 1, dtype=np.int32)
    for codes, ends in W.runs_of(texts):
        inside = codes < len(known)
        local = np.where(inside, known[np.where(inside, codes, 0)] if len(known) else 0, 0).astype(np.int32)
        for i in range(len(ends) - 1):
            part = local[ends[i] : ends[i + 1]]
            part = part[(part > 0) | (np.diff(part, prepend=0) != 0)]  # one break is enough
            out[sampled[begin + i]] += [part, np.zeros(1, np.int32)]
        begin += len(ends) - 1
    packed = {s: np.concatenate(parts) for s, parts in out.items()}
    packed = {s: codes for s, codes in packed.items() if codes.any()}
    return pa.table(
        {
            "sampled": pa.array(packed, pa.bool_()),
            "ids": pa.array([W.tight(ids.tobytes())] * len(packed), pa.binary()),
            "codes": pa.array([W.tight(W.small(codes)) for codes in packed.values()], pa.binary()),
        }
    )


# -- pairs and triples ---------------------------------------------------------------------


def _bit(g1: np.ndarray, g2: np.ndarray) -> np.ndarray:
    hashed = mix(mix(g1.astype(np.uint64)) + g2.astype(np.uint64))
    return (hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """A bitmap that holds the pairs (g1, g2): :data:`FILTER_BITS` say its size, also that of
    what comes to the driver.  It may hold others, too."""

    def run(batches):
        for batch in batches:
            g1, g2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g1", "g2"))
            yield pa.RecordBatch.from_arrays([pa.array(_bit(g1, g2))], names=["bit"])

    parts = (
        pairs.select("g1", "g2")
        .mapInArrow(run, "bit long")
        .groupBy(F.shiftright("bit", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in parts:
        bits[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.bits, np.uint8)
    return bits


def _add_up(least: int):
    """For one bucket: the phrases with ``least`` occurrences or more over all blocks."""

    def add_up(table: pa.Table) -> pa.Table:
        out = []
        for size in (2, 3):
            rows = table.filter(pa.compute.equal(table.column("size"), size)).column("counts").to_pylist()
            if not rows:
                continue
            parts = [W.from_planes(W.loose(row)).reshape(size + 1, -1) for row in rows]
            *phrase, n = np.concatenate(parts, axis=1)
            order = np.lexsort(phrase)
            phrase, n = [g[order] for g in phrase], n[order]
            new = np.concatenate([[True], np.any([g[1:] != g[:-1] for g in phrase], axis=0)])
            begin = np.flatnonzero(new)
            total = np.add.reduceat(n, begin)
            kept = begin[total >= least]
            columns = [pa.array(g[kept]) for g in phrase] + [pa.nulls(len(kept), pa.int64())] * (3 - size)
            out.append(pa.table([*columns, pa.array(total[total >= least])], names=["g1", "g2", "g3", "c"]))
        return pa.concat_tables(out)

    return add_up


def _count(coded: DataFrame, least: int, buckets: int, triples: bool = False, pairs: bool = True, of=None, but=None) -> DataFrame:
    """g1, g2, g3 (null for pairs) and c of the phrases with ``least`` occurrences or more:
    pairs of frequent words and triples whose two pairs are in the filter ``of``, but not both
    in ``but``.  They are counted in a block and dealt to buckets by a hash of the phrase; a
    bucket adds up the counts of all blocks, one a phrase and block at most."""
    context = coded.sparkSession.sparkContext
    filters = [None if f is None else context.broadcast(f) for f in (of, but)]

    def block(ids: np.ndarray, codes: np.ndarray):
        width = len(ids) + 1
        first, second = codes[:-1], codes[1:]
        valid = np.flatnonzero((first > 0) & (second > 0))
        keys, which = np.unique(first[valid] * width + second[valid], return_inverse=True)
        g1, g2 = ids[keys // width - 1], ids[keys % width - 1]
        if pairs:
            yield g1, g2, np.bincount(which, minlength=len(keys))
        if triples and len(keys):
            marks = [None if f is None else _has(f.value, _bit(g1, g2)) for f in filters]
            at = np.flatnonzero(np.diff(valid) == 1)  # a pair and the one that begins at its second word
            left, right = which[at], which[at + 1]
            wanted = marks[0][left] & marks[0][right]
            if marks[1] is not None:
                wanted &= ~(marks[1][left] & marks[1][right])
            three, n = np.unique(left[wanted].astype(np.int64) * width + keys[right[wanted]] % width, return_counts=True)
            two = three // width
            yield g1[two], g2[two], ids[three % width - 1], n

    def deal(columns):
        *phrase, _ = columns
        hashed = np.zeros(len(phrase[0]), np.uint64)
        for g in phrase:
            hashed = mix(hashed + g.astype(np.uint64))
        bucket = (hashed % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        for i, j in zip(cuts, cuts[1:]):
            at = order[i:j]
            yield int(bucket[at[0]]), len(phrase), W.tight(W.planes(np.concatenate([c[at] for c in columns])))

    def run(batches):
        names, kinds = ["bucket", "size", "counts"], [pa.int32(), pa.int32(), pa.binary()]
        for batch in slices(batches, "codes"):
            for ids, codes in zip(batch.column("ids").to_pylist(), batch.column("codes").to_pylist()):
                for columns in block(np.frombuffer(W.loose(ids), np.int64), W.large(W.loose(codes))):
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*deal(columns)), kinds)], names=names
                        )

    dealt = coded.mapInArrow(run, "bucket int, size int, counts binary")
    return dealt.groupBy("bucket").applyInArrow(_add_up(least), "g1 long, g2 long, g3 long, c long")


def frequent_phrases(docs: DataFrame, least: int, text: str, lang: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Exact counts of all words, pairs and triples with ``least`` occurrences or more in
    their language: words (id, lang, word, f), pairs (g1, g2, c), triples (g1, g2, g3, c), and
    the number n of all words of each lang."""
    rows = docs.select(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
    ).withColumn("sampled", F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    packed = W.pack(rows, "sampled", "text", pieces_and_words, "lang", frozenset([_BREAK]), count=True)
    found = stage(W.look_up(packed, _frequent_words(least), _FOUND), "frequent-words")
    per_block = found.filter("block IS NOT NULL").select("block", "bucket", "numbers", "places")
    coded = stage(W.fill(packed, per_block, _code, _CODED), "coded-texts")
    words = found.filter("word IS NOT NULL").select(
        (F.shiftleft(F.col("bucket").cast("long"), 32) + F.col("place")).alias("id"), "lang", "word", "f"
    )
    totals = found.filter("block IS NULL AND word IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))

    # Half of what a phrase just frequent would have in the sample: few are missed.
    lowered = max(1, least // (2 * SAMPLE) + 1)
    buckets = PHRASE_BUCKETS * W.buckets_for(rows, "text")
    proposed = stage(_count(coded.filter("sampled"), lowered, buckets).select("g1", "g2"), "proposed")
    inside = pair_filter(proposed)
    counted = stage(_count(coded, least, buckets, triples=True, of=inside), "counted")
    pairs, triples = counted.filter("g3 IS NULL").drop("g3"), counted.filter("g3 IS NOT NULL")
    if not pairs.join(proposed, ["g1", "g2"], "left_anti").isEmpty():  # the border has failed
        # All pairs are counted, so the triples of this pass open nothing more.
        wider = _count(coded, least, buckets, triples=True, pairs=False, of=pair_filter(pairs), but=inside)
        triples = triples.unionByName(stage(wider, "expansion"))
    return words, pairs, triples, totals


# -- scores --------------------------------------------------------------------------------


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a a / (l r)); decimals of 38 digits, as 64 bits are too few."""
    wide = lambda c: f"CAST({c} AS decimal(19,0))"
    return F.expr(f"(CAST(1000000 AS decimal(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)})")


def collocations(
    docs: DataFrame, least: int = 10, first: int = 2000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` phrases by score.

    Words are lower-cased (A-Z) and stand in pieces between ``.,;:!?`` and line ends; phrases
    have two or three words and ``least`` occurrences (a) or more, overlapping ones included.
    The cut with the lowest score counts, l and r are its parts' occurrences, n is the number
    of words of the language.  A pair inside a frequent triple with half its occurrences or
    more is left out.  Ties: more occurrences first, then the phrase in byte order.

    Null texts are empty, a null language is ``und``.  Repeated rows count each.  Texts of any
    length are read whole; no words, or an empty table, give no rows.  Other columns are not read.
    """
    words, pairs, triples, totals = frequent_phrases(docs, least, text, lang)
    word = lambda i: words.select(
        F.col("id").alias(f"g{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"), F.col("lang").alias(f"lang{i}")
    )
    pair = lambda i, j: pairs.select(F.col("g1").alias(f"g{i}"), F.col("g2").alias(f"g{j}"), F.col("c").alias(f"c{i}{j}"))
    longer = (
        triples.select("g1", "g2", "c")
        .unionByName(triples.select(F.col("g2").alias("g1"), F.col("g3").alias("g2"), "c"))
        .groupBy("g1", "g2")
        .agg(F.max("c").alias("longer"))
    )
    two = (
        pairs.join(longer, ["g1", "g2"], "left")
        .filter("longer IS NULL OR 100 * longer < 50 * c")
        .join(word(1), "g1")
        .join(word(2).drop("lang2"), "g2")
        .select(
            F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("c").alias("a"),
            F.col("f1").alias("l"), F.col("f2").alias("r"), _score("c", "f1", "f2").alias("score"),
        )
    )
    three = (
        triples.join(pair(1, 2), ["g1", "g2"])
        .join(pair(2, 3), ["g2", "g3"])
        .join(word(1), "g1")
        .join(word(2).drop("lang2", "f2"), "g2")
        .join(word(3).drop("lang3"), "g3")
        .withColumn("first_cut", _score("c", "f1", "c23"))
        .withColumn("second_cut", _score("c", "c12", "f3"))
        .selectExpr(
            "lang1 AS lang", "concat_ws(' ', w1, w2, w3) AS phrase", "c AS a",
            "IF(first_cut <= second_cut, f1, c12) AS l", "IF(first_cut <= second_cut, c23, f3) AS r",
            "least(first_cut, second_cut) AS score",
        )
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: first the best of each of its parts, then of those.
    spread = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best)).cast("long")).filter(
        F.col("rank") <= first
    )
    top = ranked(ranked(spread, "lang", "part").drop("rank", "part"), "lang")
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
