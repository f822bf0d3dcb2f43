"""Registered queries against their SQL, and the pipeline against plain Python."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import compare, duck  # noqa: E402

import corpus_pipeline  # noqa: E402
from goldweft.llm import quality  # noqa: E402
from goldweft.llm.oracles import ORACLES  # noqa: E402
from goldweft.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    compare(spark, con, name, QUERIES[name], ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.count() == n or name == "op7_decontamination"


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = (
        QUERIES["op3_quality"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    )
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [1 - r.predicted for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) > 0.75


def test_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
    ]
    from test_edges import join_by_hand, lines_by_hand, weighted_by_hand

    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.stage(function(spark, docs, SF), "test")
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count()
        texts = [(d, r.text) for d, r in before.items()]
        if name == "quality classifier":
            source = spark.read.parquet(f"{SF}/documents.parquet")
            scorer = quality.train(source, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(after) == {d for d, t in texts if scorer.score((t or "").encode()) >= 0.5}
        elif name == "line dedup":
            gone = lines_by_hand(texts)
            want = {
                d: "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone) for d, t in texts
            }
            assert {d: r.text for d, r in after.items()} == {
                d: t for d, t in want.items() if t.split() or t == before[d].text
            }
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for _, _, c in join_by_hand(texts)}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == set(before) - {d for d, *_ in weighted_by_hand(texts, items)}
        if not name.startswith("mixing"):
            assert docs.columns == columns
        else:
            assert set(columns) < set(docs.columns) and set(after) <= set(before)
