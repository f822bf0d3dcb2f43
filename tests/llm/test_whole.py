"""Cases in which an operator once did less than the whole job."""

import json
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from goldweft.llm import decontaminate  # noqa: E402
from test_edges import make, words  # noqa: E402


def test_copies_with_short_lines_leave_the_pipeline(spark, tmp_path):
    rng = random.Random(31)
    body = [words(rng, 12) for _ in range(6)]
    near = [" ".join([*x.split()[:5], "edit", *x.split()[6:]]) for x in body]
    other = [words(rng, 12) for _ in range(4)]
    rows = [
        (1, "\n".join([*body, "Oued, for."]), "en", "a"),
        (2, "\n".join([*body[:3], "Oued, for.", *body[3:]]), "en", "a"),  # an exact copy
        (3, "\n".join([*near, "Oued,  for."]), "en", "a"),  # a near copy
        (4, "\n".join([*body, "of its own"[:6], "Oued, for."]), "en", "a"),  # has a line of its own
        (5, "Oued, of", "en", "a"),  # short as it came
        (6, "\n".join([*other, "of its"]), "en", "a"),
        (None, "Oued, for.", "en", "a"),
    ]
    docs = make(spark, rows).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.text for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 4, 5, 6, None}
    assert got[4] == "of its"
    kept = "\n".join(got.values())
    assert all(line in kept for line in (*body, *other, "Oued, for.", "of its"))


def test_near_copies_of_repeated_and_templated_items_leak(spark):
    rng = random.Random(32)
    for copies in (2, 3, 10):
        text, preamble = words(rng, 54), words(rng, 48)
        tails = [words(rng, 6) for _ in range(copies)]
        alone = words(rng, 54)
        items = [(i, text) for i in range(copies)]
        items += [(100 + i, f"{preamble} {tail}") for i, tail in enumerate(tails)] + [(200, alone)]
        edited = lambda t, at: " ".join("edit" if i == at else w for i, w in enumerate(t.split()))
        docs = [
            (1, f"{words(rng, 9)} {edited(text, 25)} {words(rng, 5)}"),  # 45 of 55 shingles
            (2, f"{words(rng, 9)} {edited(f'{preamble} {tails[0]}', 20)}"),
            (3, edited(alone, 30)),
            (4, edited(edited(text, 15), 35)),  # 40 of 60
            (5, text),
        ]
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = {(r.doc_id, r.item_id): (r.start, r.similarity) for r in decontaminate.leaks(make(spark, docs), bench).collect()}
        assert {i for d, i in got if d == 1} == {i for d, i in got if d == 5} == set(range(copies))
        assert all(got[1, i] == (9, pytest.approx(45 / 55)) and got[5, i] == (0, 1.0) for i in range(copies))
        assert got[2, 100][1] == pytest.approx(45 / 55) and (3, 200) in got
        assert not [d for d, _ in got if d == 4]
