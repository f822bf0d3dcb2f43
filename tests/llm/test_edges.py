"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from goldweft.llm import decontaminate, licences, line_dedup, mixing, ngram_join, quality
from goldweft.llm import substring_dedup, token_counts, tool_chat, topk_search
from goldweft.llm.components import components

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, node int, line int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def make(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *[None] * (9 - len(r))) for r in rows], schema)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(4)
    long = words(rng, 30_000)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (2, base, "en", "b"),  # a repeated row
        (3, " ".join(near).upper(), "en", None),
        (4, None, "en", "a"),
        (5, "", None, ""),
        (6, " \t\n\x0b\f\r ", "en", "a"),
        (7, "one two", "en", "a"),
        (8, "One TWO", "en", "a"),
        (9, long, "en", "b"),
        (10, "x" * 200_000, "en", "b"),
        (11, "Zeile eins hat fünf Wörter\nZeile eins hat fünf Wörter\nkurz", "de", "c"),
        (None, base, None, "a"),
        (-5, words(rng, 40), "en", "a"),
        (12, "nul\x00 é漢字   wide <|endoftext|> 'll", "en", "a"),
    ]
    return make(spark, rows)


def empty(df):
    return df.filter("1 = 0")


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_token_counts(spark, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.count_tokens(odd, path)
    want = [
        (r.doc_id, len(t.encode()), n, n > 512)
        for r in odd.collect()
        for t in [r.text or ""]
        for n in [len(library.encode(t, add_special_tokens=False).ids)]
    ]
    assert result(got) == sorted(want, key=repr)
    assert token_counts.count_tokens(empty(odd), path).count() == 0


def test_token_counts_on_random_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), token_counts.Counter(open(path).read())
    rng = random.Random(9)
    letters = "ab  'stre\n\t\r\x1c\x85\xa0 　é漢12½²٣!?#~😀​<|endoftext|>"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        text += rng.choice(["", "<|endoftext|>", "<|endoftext|> x"])
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def lines_by_hand(rows):
    """Whether each line of each row goes, by comparing all lines with all."""
    split = lambda t: [w for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]
    lines = [(d, p, split(x)) for d, t in rows for p, x in enumerate((t or "").split("\n"))]

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < line_dedup.NEAR_WORDS or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    return {
        (d, p)
        for d, p, w in lines
        if w and any((e, q) < (d, p) and near(w, v) for e, q, v in lines)
    }


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(2)
    rows = []
    pool = [words(rng, n).split() for n in (1, 2, 3, 4, 5, 6, 8, 9, 10, 12, 25)]
    pool += [["a"] * 9, ["a"] * 8, ["b", *["a"] * 8], [*["a"] * 8, "b"]]
    for doc in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                i = rng.randrange(len(line) + 1)
                edit = rng.randrange(3)
                if edit == 0:
                    line.insert(i, rng.choice("ab"))
                elif i < len(line):
                    line[i : i + 1] = [] if edit == 1 else [rng.choice("abc")]
            text.append(rng.choice((" ", "  ", "\t")).join(line))
        rows.append((doc - 3, "\n".join(text)))
    docs = make(spark, rows)
    got = {tuple(r) for r in line_dedup.repeated_lines(docs).select("doc", "place").collect()}
    assert got == lines_by_hand(rows)


def test_line_dedup_edges(spark, odd):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_removed"]
    by_id = {(r.doc_id, r.text): (r.n_lines, r.n_removed) for r in got.collect()}
    assert by_id[(4, None)] == (0, 0)
    assert by_id[(2, "")] == (1, 1)
    assert by_id[(11, "Zeile eins hat fünf Wörter\nkurz")] == (3, 1)
    assert got.count() == odd.count() and got.filter("doc_id IS NULL AND n_removed = 0").count() == 1
    assert line_dedup.dedup_lines(empty(odd)).count() == 0


def test_line_dedup_of_one_id_with_two_texts_and_clashing_names(spark):
    rng = random.Random(8)
    a, b, c = (words(rng, 9) for _ in range(3))
    near = " ".join(["other", *b.split()[1:]])
    rows = [(1, f"{a}\n{b}"), (1, f"{c}\n{a}"), (2, f"{near}\nx"), (3, f"{c}\n\nx"), (4, a)]
    schema = "doc_id long, text string, doc int, version int, row int, part int, gone int, maybe int, bits int, place int, k0 int"
    want = {(1, f"{a}\n{b}"), (1, c), (2, "x"), (3, ""), (4, "")}
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        docs = spark.createDataFrame([(*r, *range(9)) for r in order], schema)
        got = line_dedup.dedup_lines(docs)
        assert got.columns == [*docs.columns, "n_lines", "n_removed"]
        assert {(r.doc_id, r.text) for r in got.collect()} == want
        assert {tuple(r)[2:11] for r in got.collect()} == {tuple(range(9))}


def test_mix_keeps_columns_of_any_name(spark):
    names = "size pattern place part rest passes cut before target kept until extra words".split()
    rows = [(i, words(random.Random(i), 5), "ab"[i % 2], *range(13)) for i in range(40)] + [(None, "x y", "a", *range(13))] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    got = mixing.mix(docs, F.array("source"), keep=tuple(docs.columns)).collect()
    assert len(got) == 43
    assert all((r.size, r.pattern, r["cut"]) == (5 if r.doc_id is not None else 2, 1, 6) for r in got)
    assert sum(r.taken for r in got) == sum(r.size for r in got)


def test_excerpt_spreads_over_the_whole_text(spark):
    long = "".join(f"<{i:06d}>" for i in range(40_000))
    rows = make(spark, [(1, "short"), (2, "x" * 20_000), (3, long), (4, long[:20_008])])
    got = {r.doc_id: r.t for r in rows.select("doc_id", quality.excerpt(F.col("text")).alias("t")).collect()}
    assert (got[1], len(got[2]), len(got[3]), len(got[4])) == ("short", 20_000, 20_000, 20_000)
    step = (len(long) - 2000) / 9
    assert got[3] == "".join(long[int(step * i) : int(step * i) + 2000] for i in range(10))
    assert got[3].startswith("<000000>") and got[3].endswith("<039999>")


def test_quality(spark, odd):
    rng = random.Random(6)
    rows = [(i, words(rng, 60), "en", "a") for i in range(300)]
    rows += [(i, " ".join(w.upper() + "!!" for w in words(rng, 60).split()), "en", "a") for i in range(300, 600)]
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    scorer = quality.train(docs, labels)
    scored = quality.score(docs, scorer).collect()
    assert all(r.predicted == (r.doc_id < 300) for r in scored if r.held_out)
    assert sum(r.held_out for r in scored) > 150
    # Held-out labels and other columns must not matter.
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert result(quality.score(docs.drop("lang"), quality.train(docs, turned))) == sorted(map(tuple, scored), key=repr)
    rows = quality.score(odd, scorer).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(empty(odd), quality.train(empty(odd), empty(labels))).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(odd, empty(labels))).collect()} == {0.5}
    assert quality.keep_good(odd, scorer).columns == odd.columns


def test_topk_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (50, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0])]
    rows += [(4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [0.25, 0.0, 9.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk_search.top_k(table).collect()}
    assert [got[50, i] for i in range(1, 6)] == [(0, 32768), (1, 32768), (2, 32768), (3, 32768), (3, 32768)]
    assert [got[0, i][0] for i in range(1, 6)] == [50, 1, 2, 3, 3]
    assert topk_search.top_k(empty(table)).count() == 0
    # A third of all rows alike: as many of them as fit, each a candidate of its own.
    many = spark.createDataFrame([(50, [1.0]), *[(7, [2.0])] * 400, *[(i, [1.5]) for i in range(100, 105)]], "vec_id long, embedding array<double>")
    assert [tuple(r)[2] for r in topk_search.top_k(many).filter("query_id = 50").collect()] == [7] * 5


def test_topk_against_all_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES", 40)
    monkeypatch.setattr(topk_search, "QUERIES", 2)
    rng = random.Random(3)
    rows = [(i, [rng.choice((0.0, -0.5, 0.25, 1.0)) for _ in range(6)]) for i in range(300)]
    got = {}
    for r in topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got[r.query_id, r["rank"]] = (r.vec_id, r.score)
    for q in range(0, 300, 50):
        dot = [(-sum(int(a * 256 // 1) * int(b * 256 // 1) for a, b in zip(rows[q][1], v)), i) for i, v in rows if i != q]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in sorted(dot)[:5]]


def test_mixing(spark, odd):
    got = mixing.mix(odd, F.array("source"), keep=("doc_id", "source"), key="doc_id").collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by.setdefault(r.source, []).append(r)
    names = ["", "a", "b", "c", None]
    assert set(by) == set(names)
    sizes = {s: sum(r["size"] for r in by[s]) for s in names}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    # The excess shared again and again, as the rule says it.
    want, total = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    left, free = total, set(names)
    while left > 1e-6 and free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in free:
            want[s] += share[s]
        left = sum(max(0.0, want[s] - 3 * sizes[s]) for s in free)
        for s in list(free):
            if want[s] >= 3 * sizes[s]:
                want[s] = float(3 * sizes[s])
                free.discard(s)
    for s in names:
        assert by[s][0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in by[s]) - want[s]) <= 1
    again = mixing.mix(odd.repartition(7), F.array("source"), keep=("doc_id", "source"))
    assert result(again) == sorted(map(tuple, got), key=repr)
    assert mixing.mix(empty(odd), F.array("source")).count() == 0


def test_flow_shares_overlapping_patterns():
    # Two sources; the shared pattern must serve the one that has too little of its own.
    given = mixing.min_cost_flow([10, 10, 40], [30, 30], [(0,), (1,), (0, 1)])
    assert sum(g.get(0, 0) for g in given) == 30 and sum(g.get(1, 0) for g in given) == 30
    assert given[0] == {0: 10} and given[1] == {1: 10}  # nothing is repeated
    assert sum(sum(g.values()) for g in mixing.min_cost_flow([5], [100], [(0,)])) == 15


def test_mix_of_overlapping_sources(spark):
    """Every document in one or two of three sources, a third of all in one pattern."""
    rng = random.Random(31)
    patterns = [["a"], ["b"], ["c"], ["a", "b"], ["b", "c"], ["c", "b"], [None], ["a", "b"], ["a", "b"]]
    rows = [(i, words(rng, rng.randint(1, 60)), patterns[i % 9]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = {r.doc_id: r for r in mixing.mix(docs, F.col("sources")).collect()}
    assert len(got) == 900
    size = {i: len(t.split()) for i, t, _ in rows}
    assert all(got[i]["size"] == size[i] and 0 <= got[i].taken <= 3 * size[i] for i in size)
    totals = {s: sum(size[i] for i, _, p in rows if s in p) for s in ("a", "b", "c", None)}
    wanted = mixing.targets(totals, dict(zip(totals, (1, 2, 3, 1))))
    for i, _, p in rows:
        assert got[i].source_size == sum(totals[s] for s in p)
        assert got[i].target == pytest.approx(sum(wanted[s] for s in p))
    # What can be delivered at all, by the greatest flow: every set of sources gets no more
    # than it wants, and no more than the patterns that reach it can give three times.
    of = lambda chosen: 3 * sum(size[i] for i, _, p in rows if set(p) & set(chosen))
    sets = [c for n in range(5) for c in itertools.combinations(totals, n)]
    most = min(sum(wanted[s] for s in totals if s not in c) + of(c) for c in sets)
    assert abs(sum(r.taken for r in got.values()) - most) <= 2
    # Within a pattern nothing is taken a further time before all of it was taken so often.
    for pattern in {tuple(sorted(p, key=str)) for _, _, p in rows}:
        passes = [got[i].taken / size[i] for i, _, p in rows if tuple(sorted(p, key=str)) == pattern]
        assert max(passes) - min(passes) <= 1
    again = mixing.mix(docs.repartition(5), F.col("sources")).collect()
    assert {r.doc_id: tuple(r) for r in again} == {i: tuple(r) for i, r in got.items()}


def test_shares_equal_the_flow():
    rng = random.Random(3)
    for _ in range(200):
        members = [m for n in (1, 2) for m in itertools.combinations(range(5), n) if rng.random() < 0.5]
        capacity = [rng.randint(0, 20) for _ in members]
        wanted = [rng.randint(0, 60) for _ in range(5)]
        sums = [
            sorted(sum(g.values()) for g in f(capacity, wanted, members)) for f in (mixing.shares, mixing.min_cost_flow)
        ]
        assert sum(sums[0]) == sum(sums[1])
        cost = [sum(max(0, t - p * c) for p in (1, 2) for t, c in zip((sum(g.values()) for g in f(capacity, wanted, members)), capacity))
                for f in (mixing.shares, mixing.min_cost_flow)]
        assert cost[0] == cost[1]


def test_mix_refuses_too_many_patterns(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b", [f"s{i}", "all"]) for i in range(9)], "doc_id long, text string, s array<string>")
    monkeypatch.setattr(mixing, "OVERLAPPING", 8)
    with pytest.raises(ValueError, match="overlapping"):
        mixing.mix(docs, F.col("s"))
    monkeypatch.setattr(mixing, "PATTERNS", 8)
    with pytest.raises(ValueError, match="patterns of sources"):
        mixing.mix(docs, F.col("s"))
    many = docs.withColumn("s", F.array(F.col("s")[0])).limit(8)
    assert mixing.mix(many, F.col("s")).count() == 8


def test_licences(spark):
    rows = [
        (1, "CC BY cc-by_CC by", "en"),
        (2, "This is under the GNU General\tPublic-License. All rights reserved!"),
        (3, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception"),
        (4, "SPDX-License-Identifier: MIT AND"),
        (5, None),
        (6, "general public élicense"),
        (7, "all rights reserved " * 3),
    ]
    got = {r.doc_id: r for r in licences.scan(make(spark, rows)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (6, 3, 0, 4)
    assert (got[2].base_labels, got[2].n_base, got[2].first_word, got[2].last_word) == ("gpl,reserved", 2, 5, 8)
    assert got[3].labels == "apache,gpl,mit" and got[3].base_labels == "" and got[3].score == 0.95
    assert got[4].labels == "" and got[4].score == 0.5
    assert (got[5].n_words, got[5].labels, got[5].first_word) == (0, "", None)
    assert got[6].n_base == 0 and got[6].n_words == 3
    assert (got[7].n_base, got[7].last_word, got[7].score) == (3, 6, 0.0)
    assert licences.scan(empty(make(spark, rows))).count() == 0


def test_licences_against_a_plain_search(spark):
    rng = random.Random(1)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "é", "x"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([" ", "-", "_", "\n", ""]) for _ in range(60))) for i in range(200)]
    for r in licences.scan(make(spark, rows)).collect():
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", rows[r.doc_id][1])
        at = sorted(
            i for p in licences.BASE for n in [len(p.split())] for i in range(len(found)) if found[i : i + n] == p.split()
        )
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(found), len(at), at[0] if at else None, at[-1] if at else None,
        )


@pytest.mark.parametrize(
    "text, labels, free",
    [
        ("MIT", {"mit"}, 0.95),
        ("MIT OR GPL-3.0 AND reserved", {"mit", "gpl", "reserved"}, 0.95),
        ("(MIT OR GPL-3.0) AND reserved", {"mit", "gpl", "reserved"}, 0.0),
        ("GPL-2.0+ WITH Classpath-exception-2.0 */", {"gpl"}, 0.6),
        ("LGPL-2.1-only", {"lgpl"}, 0.6),
    ],
)
def test_expressions(text, labels, free):
    got = licences.evaluate(licences.postfix(text))
    assert got[0] == labels and got[1] == pytest.approx(free)


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT OR OR GPL", ")"])
def test_no_expressions(text):
    assert licences.postfix(text) is None


def sets_by_hand(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").translate(str.maketrans(upper, upper.lower()))) if w]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def join_by_hand(rows):
    sets, root = {d: sets_by_hand(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {(d, len(sets[d]), find(d)) for d in sets}


def test_ngram_join_against_all_pairs(spark):
    rng = random.Random(8)
    shared = words(rng, 30)
    rows = []
    for family in range(12):
        base = words(rng, rng.choice((3, 6, 8, 9, 11, 14, 20, 40, 80, 300))).split()
        for _ in range(rng.choice((1, 2, 12))):
            text = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 4, len(base) // 25))):
                i = rng.randrange(len(text))
                text[i : i + 1] = rng.choice(([], ["new"], [text[i], "more"])) or text[i : i + 1][:0]
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, f"{words(rng, 25)} {shared}") for i in range(40)]
    rows += [(len(rows) + i, " ".join(shared.split()[: 9 + i % 9])) for i in range(20)]
    got = {tuple(r) for r in ngram_join.join(make(spark, rows)).collect()}
    assert got == join_by_hand(rows)


@pytest.mark.parametrize("pairs_per_set", [0, ngram_join.PAIRS_PER_SET])
def test_ngram_join_of_large_groups_that_are_not_one_component(spark, monkeypatch, pairs_per_set):
    """Near copies at all distances, edits that many of them share, texts that contain others;
    small limits, so that groups outside the centres go through several rounds, or are paired
    in full as soon as the pairs are few."""
    monkeypatch.setattr(ngram_join, "SMALL_OUTSIDE", 30)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_SET", pairs_per_set)
    rng = random.Random(21)
    rows = []
    for size, count in ((60, 160), (150, 120)):
        base = words(rng, size).split()
        edits = [(rng.randrange(size), words(rng, 1)) for _ in range(14)]
        for _ in range(count):
            text = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 6))):
                at, word = rng.choice(edits) if rng.random() < 0.7 else (rng.randrange(size), words(rng, 1))
                text[at] = word
            text += words(rng, rng.choice((0, 0, 0, size // 6, size // 4))).split()
            text = text[rng.choice((0, 0, 0, size // 8)) :]
            rows.append((len(rows), " ".join(text)))
    got = {tuple(r) for r in ngram_join.join(make(spark, rows)).collect()}
    assert got == join_by_hand(rows)
    assert 10 < len({c for *_, c in got}) < 250


def test_ngram_join_makes_few_pairs_of_near_copies_with_edits_of_their_own(spark, monkeypatch):
    """Copies with several edits each, most of them too far apart to link: the words that one
    copy lost and nearly all others have must not bring all copies together."""
    rng = random.Random(33)
    base = words(rng, 140).split()
    rows = []
    for i in range(320):
        text = list(base)
        for at in rng.sample(range(140), rng.choice((1, 3, 5, 6, 7, 8))):
            text[at] = words(rng, 1)
        rows.append((i, " ".join(text[: rng.choice((140, 140, 70))])))
    made, across = [], ngram_join._across

    def watched(members, small):
        pairs = across(members, small)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_across", watched)
    monkeypatch.setattr(ngram_join, "SMALL_OUTSIDE", 128)
    got = {tuple(r) for r in ngram_join.join(make(spark, rows)).collect()}
    assert got == join_by_hand(rows) and 20 < len({c for *_, c in got}) < 300
    assert len(made) <= 2 and sum(made) < 3 * len(rows), made


def test_ngram_join_index_misses_no_link():
    """Sets at the very border of similarity share an entry, for all sizes and both bands."""
    import numpy as np

    rng = np.random.default_rng(5)
    for common in (np.empty(0, np.uint64), None):
        for n in [*range(4, 60), 100, 237, 600, 1111]:
            whole = rng.integers(1, 1 << 62, n, dtype=np.uint64)
            cold = np.sort(whole[: n // 2]) if common is None else common
            index = ngram_join.Index(cold)
            extra = rng.integers(1, 1 << 62, n, dtype=np.uint64)
            for drop in {0, n // 9, n // 5}:
                add = next((k for k in range(n, -1, -1) if ngram_join.links(n - drop, n, n - drop + k)), None)
                if add is None:
                    continue
                pair = [np.sort(whole), np.sort(np.concatenate([whole[drop:], extra[:add]]))]
                keys = [set(index.entries(p, np.array([0, len(p)]))[0].tolist()) for p in pair]
                assert keys[0] & keys[1] or (drop, add) == (0, 0), (n, drop, add)


def test_ngram_join_edges(spark, odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(odd).collect()}
    assert {(1, 116, 1), (2, 116, 1), (3, 116, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7)} <= got
    assert (None, 116, None) in got and (10, 1, 10) in got
    assert ngram_join.join(odd).count() == odd.count()
    assert ngram_join.join(empty(odd)).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    edges += [(5, 5), (None, 3), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}


def repeats_by_hand(rows):
    split = {d: (t or "").split() for d, t in rows}  # ASCII texts only
    seen, gone = {}, {d: set() for d in split}
    for d in sorted(split):
        for p in range(len(split[d]) - 19):
            key = tuple(split[d][p : p + 20])
            if key in seen:
                gone[d] |= set(range(p, p + 20))
            seen.setdefault(key, (d, p))
    return {(d, len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in split.items()}


def test_substring_dedup_against_all_windows(spark):
    rng = random.Random(5)
    passages = [words(rng, n) for n in (19, 20, 21, 33, 50)] + ["same " * 45]
    rows = [
        (i - 2, " ".join(rng.choice([*passages, words(rng, rng.randint(0, 30))]) for _ in range(rng.randint(0, 4))))
        for i in range(150)
    ]
    got = {tuple(r) for r in substring_dedup.remove_repeats(make(spark, rows)).collect()}
    assert got == repeats_by_hand(rows)


def test_substring_dedup_edges(spark, odd):
    got = substring_dedup.remove_repeats(odd)
    found = {(r.doc_id, r.n_words, r.n_removed) for r in got.collect()}
    assert {(1, 120, 0), (2, 120, 120), (4, 0, 0), (5, 0, 0), (6, 0, 0), (None, 120, 0), (9, 30_000, 0)} <= found
    assert got.count() == odd.count()
    assert substring_dedup.remove_repeats(empty(odd)).count() == 0


def weighted_by_hand(docs, items):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = lambda t: (t or "").translate(str.maketrans(upper, upper.lower())).split()
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))]
    of = {i: shingles(split(t)) for i, t in items}
    weight = {}
    for s in {s for x in of.values() for s in x}:
        weight[s] = 1 / sum(s in x for x in of.values())
    out = set()
    for d, t in docs:
        own = shingles(split(t))
        for i, x in of.items():
            n = min(len(x), len(own))
            best = None
            for start in range(len(own) - n + 1 if n else 0):
                a, b = set(own[start : start + n]), set(x)
                total = lambda s: sum(weight.get(y, 1.0) for y in s)
                value = total(a & b) / total(a | b)
                if value >= 0.8 - 1e-9 and (best is None or value > best[0] + 1e-9):
                    best = (value, start)
            if best:
                out.add((d, i, best[1], round(best[0], 6)))
    return out


def test_decontamination_against_all_windows(spark):
    rng = random.Random(12)
    items = [(i, words(rng, rng.choice((4, 5, 12, 30, 60)))) for i in range(15)]
    items += [(20, None), (21, ""), (22, items[3][1] + " tail of it"), (None, "a b c d e f g")]
    items += [(30, "just four plain words"), (31, "word"), (32, "Just four\tPLAIN words")]
    docs = []
    for i in range(150):
        text = rng.choice(items[:15])[1].split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            text[rng.randrange(len(text))] = "EDIT"
        docs.append((i, f"{words(rng, rng.randint(0, 40))} {' '.join(text)} {words(rng, rng.randint(0, 9))}"))
    docs += [(200, None), (201, ""), (None, items[2][1]), (203, items[4][1].upper())]
    docs += [(204, " Just FOUR plain words\n"), (205, "and just four plain words"), (206, "word"), (207, "word word")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = {
        (r.doc_id, r.item_id, r.start, round(r.similarity, 6))
        for r in decontaminate.leaks(make(spark, docs), bench).collect()
    }
    known = [(d, t) for d, t in docs if d is not None]
    assert got == weighted_by_hand(known, [(i, t) for i, t in items if i is not None])
    assert {(d, i) for d, i, *_ in got if d >= 204} == {(204, 30), (204, 32), (206, 31)}
    kept = decontaminate.remove_leaks(make(spark, docs), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, *_ in got}
    assert decontaminate.leaks(empty(make(spark, docs)), bench).count() == 0
    assert decontaminate.leaks(make(spark, docs), empty(bench)).count() == 0


def test_near_prints_finds_everything_within_the_radius(spark):
    rng = random.Random(1)
    rows = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(30)]
    near = []
    for i, bits in rows:
        for n in (0, 1, 8, 15, 16):
            flipped = bits
            for b in rng.sample(range(64), n):
                flipped ^= (1 << b) if b < 63 else -(1 << 63)
            near.append((i * 100 + n, flipped))
    items = spark.createDataFrame(rows, "item long, bits long").withColumn("print", F.lit(0)).withColumn("size", F.lit(3))
    asked = spark.createDataFrame(near, "doc long, bits long").withColumn("print", F.lit(0)).withColumn("size", F.lit(3))
    got = {(r.doc, r.item) for r in decontaminate.near_prints(asked, items, ["size"]).collect()}
    assert got == {(d, i) for d, x in near for i, y in rows if ((x ^ y) & (1 << 64) - 1).bit_count() <= 15}


CALLS = "conv long, call string, place long, tool string, arguments string, needs array<string>"
RESULTS = "conv long, call string, place long, content string"


def test_tool_calls(spark):
    calls = [
        (1, "a", 1, "ask", '{"words": 2, "query": "x \\"q\\"\\n"}', []),
        (1, "b", 2, "follow_up", '{"after": "a", "query": "y", "words": 1, "more": 1}', ["a", "a", "gone"]),
        (1, "c", 3, "follow_up", '{"after": "b", "query": "y", "words": "1"}', ["a", "b"]),
        (1, "d", 4, "ask", '{"query": " ", "words": 1}', ["e"]),
        (1, "e", 5, "ask", "no json", ["d"]),
        (1, "f", 6, "other", "{}", ["d"]),
        (1, "a", 9, "ask", "{}", ["c"]),  # named again: the first counts
        (2, "a", 1, "ask", None, None),
        (None, "z", 1, "ask", "{}", []),
    ]
    results = [(1, "a", 2, "late"), (1, "a", 1, None), (1, "x", 1, "lost"), (2, "a", 3, "é\u0001")]
    got = {
        (r.conv, r.call): r
        for r in tool_chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    }
    assert {k: r.depth for k, r in got.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): None, (1, "e"): None, (1, "f"): None, (2, "a"): 0,
    }
    assert {k for k, r in got.items() if r.valid} == {(1, "a")}
    assert got[1, "a"].n_results == 2 and got[1, "b"].n_results == 0
    assert got[1, "a"].json == (
        '{"arguments":{"query":"x \\"q\\"\\n","words":2},"call":"a","depth":0,"result":null,"tool":"ask","valid":true}'
    )
    assert json.loads(got[2, "a"].json)["result"] == "é\u0001"
    assert json.loads(got[1, "e"].json)["arguments"] is None
    none = tool_chat.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS))
    assert none.count() == 0


def test_long_chains_and_plain_turns(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(0, 1400)]
    rows += [(2, 0, "assistant", "early"), (2, 900, "user", None), (2, 901, "system", "s"), (2, 2000, "user", "u")]
    rows += [(None, 1, "user", "x"), (3, None, "user", "x"), (1, 0, "user", "t0")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv, r.place): r for r in tool_chat.link(*tool_chat.from_turns(turns)).collect()}
    assert all(got[1, t].depth == t // 2 and got[1, t].n_results == 1 for t in range(0, 1400, 2))
    assert (got[2, 900].depth, got[2, 900].valid, got[2, 2000].depth) == (0, False, 1)
    assert len(got) == 702


def test_chat_leaves_no_turn_out(spark):
    rows = [
        (1, 0, "system", "be \"brief\""), (1, 1, "assistant", "hello"), (1, 2, "user", "q"), (1, 3, "assistant", "first"),
        (1, 4, "assistant", None), (1, 5, "tool", "t"), (1, 6, "assistant", "third"), (1, 6, "assistant", "third"),
        (2, 1, None, None), (2, 2, "", "x"), (None, 1, "system", "gone"), (2, None, "system", "gone"), (3, 1, "assistant", "alone"),
    ]
    turns = spark.createDataFrame([(*r, 1, 1) for r in rows], "conv_id long, turn long, role string, text string, call int, status int")
    got = tool_chat.format_chat(*tool_chat.from_turns(turns), tool_chat.context(turns)).collect()
    assert sorted((r.conv, r.place, r.status, r.call) for r in got if r.status != "context") == [
        (1, 1, "orphan", None), (1, 2, "call", "1.2"), (1, 4, "result", "1.2"), (1, 6, "result", "1.2"), (3, 1, "orphan", None),
    ]
    assert sorted((r.conv, r.place) for r in got if r.status == "context") == [(1, 0), (1, 5), (2, 1), (2, 2)]
    text = {(r.conv, r.place): r.json for r in got}
    assert text[1, 0] == '{"content":"be \\"brief\\"","role":"system","status":"context"}'
    assert text[1, 4] == '{"call":"1.2","content":null,"status":"result"}'
    assert text[2, 1] == '{"content":null,"role":null,"status":"context"}'
    assert json.loads(text[1, 2])["result"] == "first" and [r.n_results for r in got if r.call == "1.2" and r.n_results] == [3]
    # Results of calls nobody made, and repeated rows, in tables that were not made from turns.
    calls = spark.createDataFrame([(1, "a", 1, "ask", "{}", [])] * 2, CALLS)
    results = spark.createDataFrame([(1, "a", 2, "x"), (1, "a", 2, "x"), (1, "b", 2, "y"), (None, "a", 2, "z"), (1, "a", 3, "x")], RESULTS)
    none = tool_chat.context(turns.limit(0))
    got = tool_chat.format_chat(calls, results, none)
    assert sorted((r.call, r.place, r.status) for r in got.collect()) == [("a", 1, "call"), ("a", 3, "result"), ("b", 2, "orphan")]
    assert tool_chat.format_chat(calls.limit(0), results.limit(0), none).count() == 0


def test_one_id_with_two_texts(spark):
    """Links and leaks of both texts are found, whatever the order of the rows."""
    rng = random.Random(14)
    a, b, c = (words(rng, 30) for _ in range(3))
    rows = [(1, a), (2, b), (2, a + " tail"), (2, c), (3, f"{c} end"), (4, f"{words(rng, 9)} {b} more"), (5, words(rng, 30))]
    bench = spark.createDataFrame([(7, a), (8, b), (9, c)], "item_id long, text string")
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        linked = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
        assert {(1, 26, 1), (2, 27, 1), (3, 27, 2), (5, 26, 5)} <= linked and len(linked) == 6
        assert (2, 26, 2) in linked  # both other texts of 2
        found = {(r.doc_id, r.item_id): (r.n_windows, r.start, r.similarity) for r in decontaminate.leaks(docs, bench).collect()}
        assert set(found) == {(1, 7), (2, 7), (2, 8), (2, 9), (3, 9), (4, 8)}
        assert all(v[2] == 1 for v in found.values()) and found[4, 8][1] == 9


def test_more_buckets_than_partitions(spark, monkeypatch):
    from goldweft.llm import common

    monkeypatch.setattr(common, "BUCKET_BYTES", 300)
    rng = random.Random(15)
    passages = [words(rng, n) for n in (20, 25, 40)]
    rows = [(i, " ".join(rng.choice([*passages, words(rng, 15)]) for _ in range(3))) for i in range(40)]
    docs = make(spark, rows)
    assert common.buckets(docs) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {tuple(r) for r in substring_dedup.remove_repeats(docs).collect()} == repeats_by_hand(rows)
    assert {tuple(r) for r in ngram_join.join(docs).collect()} == join_by_hand(rows)


def test_decontamination_takes_all_prints_in_one_aggregation(spark, monkeypatch):
    staged = []
    stage = decontaminate.stage
    monkeypatch.setattr(decontaminate, "stage", lambda df, name: staged.append(name) or stage(df, name))
    rng = random.Random(11)
    shared, own = words(rng, 20), words(rng, 20)
    items = spark.createDataFrame([(1, f"{shared} {own}"), (2, shared), (3, shared)], "item_id long, text string")
    docs = make(spark, [(1, f"x {shared} {own} y", "en", "a"), (2, words(rng, 50), "en", "a"), (3, shared, "en", "a")])
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert found == {(1, 1), (1, 2), (1, 3), (3, 2), (3, 3)}
    assert staged.count("prints") == 1 and staged.count("starts") == 1


def test_entries_of_the_ngram_join_are_dealt_by_the_size_of_the_texts(spark, monkeypatch):
    """Before, a bucket held all entries of a session with one shuffle partition."""
    rng = random.Random(21)
    rows = [(i, words(rng, 60)) for i in range(40)]
    rows += [(100 + i, t + " and one more") for i, t in rows[:20]]
    most = []
    entries = ngram_join._entries
    monkeypatch.setattr(ngram_join, "_entries", lambda n, index: most.append(n) or entries(n, index))
    monkeypatch.setattr(ngram_join, "ENTRY_BYTES", 1000, raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = {tuple(r) for r in ngram_join.join(make(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert most[0] >= sum(len(t) for _, t in rows) // 1000 > 10
    assert got == join_by_hand(rows)


def test_copies_make_entries_once_however_often_a_task_passes_some_on(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "GATHERED", 10)
    rng = random.Random(22)
    texts = [words(rng, 40) for _ in range(5)]
    make_entries = ngram_join._entries(3, ngram_join.Index(np.empty(0, np.uint64)))

    def made(texts):
        batches = (pa.RecordBatch.from_arrays([pa.array([t])], names=["text"]) for t in texts)
        return b"".join(e for batch in make_entries(batches) for e in batch.column("entries").to_pylist())

    assert len(made(texts)) > 0 and made(texts) == made(texts * 2)
