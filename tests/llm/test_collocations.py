"""Phrase collocations against plain Python, with and without failures of the border."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from goldweft.llm import collocations, wordblocks  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=10, first=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    found = []
    for (lang, words), a in candidates.items():
        if any(
            lang == other and len(long) > len(words) and 100 * b >= 50 * a and words in (long[:2], long[1:])
            for (other, long), b in candidates.items()
        ):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1000000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.append((lang, " ".join(words), a, l, r, totals[lang], score))
    out = []
    for lang in totals:
        own = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))
        out += [(f[0], i + 1, *f[1:]) for i, f in enumerate(own[:first])]
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    pool = ["new", "York", "city", "of", "the", "é", "漢", "x" * 300, "a", "B", "(", "u\x00v", "\x85", " "] + [f"w{i}" for i in range(12)]
    fixed = ["New York city", "of the", "a a a a", "York, city", "tab\tnew \t york"]
    rows = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "!?", "\x0b", ":"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return [*rows, (None, "en"), ("", None), (" \t\n", "de"), ("word " * 30000, "en"), *rows[:20]]


def make(spark, rows):
    return spark.createDataFrame([(t, lang, 1, 2, "x") for t, lang in rows], "text string, lang string, c long, g1 long, phrase string")


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(wordblocks, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(wordblocks, "BUCKET_BYTES", 1000)
    rows = corpus(1)
    want = by_hand(rows, 4)
    assert len(want) > 150
    assert result(collocations.collocations(make(spark, rows), least=4)) == want


@pytest.mark.parametrize("sample", [1, 1000])
def test_the_sample_does_not_change_the_result(spark, monkeypatch, sample):
    # With all texts the border holds, with next to none of them it fails everywhere.
    monkeypatch.setattr(collocations, "SAMPLE", sample)
    rows = corpus(2, 200)
    assert result(collocations.collocations(make(spark, rows), least=4, first=50)) == by_hand(rows, 4, 50)


def test_a_full_filter_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(collocations, "pair_filter", lambda pairs: collocations.np.full(1 << 24, 255, "uint8"))
    rows = corpus(3, 100)
    assert result(collocations.collocations(make(spark, rows))) == by_hand(rows)


def test_empty_tables(spark):
    docs = make(spark, [(None, None), ("", "en"), ("one two", "en")])
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.filter("1 = 0")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_019
    df = spark.createDataFrame([(big, big + 7, big + 1)], "a long, l long, r long")
    got = df.select(collocations._score("a", "l", "r").alias("s")).first().s
    assert got == 1000000 * big * big // ((big + 7) * (big + 1))
