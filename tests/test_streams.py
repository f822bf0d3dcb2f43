"""Streams that must not lose rows, and stores that must not lose batches."""

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from people import messages

from goldweft import schemas as S
from goldweft.session import scratch_root
from goldweft.sources.store import Store
from goldweft.streaming import consolidate as SC
from goldweft.streaming import ingest as SI

ROWS = "topic string, partition int, offset long, timestamp timestamp"
NOON = datetime(2024, 5, 1, 12)


def files(spark, path, *batches):
    for rows in batches:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_late_messages_pass_and_replays_do_not(spark, tmp_path):
    first = [("t", 0, i, NOON) for i in range(10)]
    late = [("t", 1, i, NOON - timedelta(days=1)) for i in range(10)]
    rows = files(spark, tmp_path / "in", first, late, first)
    SI.start(SI.dedup(rows), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.distinct().count() == 20


def test_state_of_dedup_is_runs_of_offsets():
    import numpy as np
    import pandas as pd

    class State:
        exists, value = False, None

        def update(self, value):
            self.exists, self.value = True, value

        @property
        def get(self):
            return self.value

    rng = np.random.default_rng(5)
    state, seen = State(), set()
    offsets = rng.permutation(20_000)
    for part in np.array_split(np.concatenate([offsets, offsets[:5_000]]), 7):
        chunks = [pd.DataFrame({"offset": c}) for c in np.array_split(part, 3)]
        got = [int(o) for frame in SI.unseen((), iter(chunks), state) for o in frame["offset"]]
        assert sorted(got) == sorted(set(part.tolist()) - seen)
        seen |= set(part.tolist())
    assert state.value == ([0], [19_999])
    frame = pd.DataFrame({"offset": np.arange(30_000, 1_030_000)})
    assert sum(map(len, SI.unseen((), iter([frame, frame]), state))) == 1_000_000
    assert state.value == ([0, 30_000], [19_999, 1_029_999])


def test_dedup_keeps_every_field(spark, tmp_path):
    odd = datetime(2024, 10, 27, 1, 30, 0, 123456)
    rows = [("t", None, 0, odd), ("t", 1, None, None), (None, 1, 5, NOON), ("t", 1, 3_000_000, NOON)]
    stream = files(spark, tmp_path / "in", rows, rows + [("t", 1, 2_999_999, NOON)])
    SI.start(SI.dedup(stream), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=str) == sorted(rows + [("t", 1, 2_999_999, NOON)], key=str)


def test_consumed_bronze_is_archived(spark, tmp_path):
    """Files leave after the batch that read them; what no run can use stays in the store."""
    path, archive = str(tmp_path / "ingested"), tmp_path / "archive"
    store = Store(spark, str(tmp_path / "store"))
    texts = messages() + ['{"foo":1}']

    def run(start, part):
        frame = spark.createDataFrame(
            [(None, t.encode(), "people", 0, start + i, NOON) for i, t in enumerate(part)], S.KAFKA
        )
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "kafka"))
        topic = spark.readStream.schema(S.KAFKA).parquet(str(tmp_path / "kafka"))
        SI.ingest_split(topic, path, str(tmp_path / "offsets")).awaitTermination()
        SC.start(
            spark,
            SI.bronze_folder(path),
            store,
            str(tmp_path / "runs"),
            trigger={"availableNow": True},
            archive=str(archive),
        ).awaitTermination()

    def left():
        return len(list((tmp_path / "ingested").rglob("*.parquet")))

    run(0, texts[:30])
    first = {p.name for p in (tmp_path / "ingested").rglob("*.parquet")}
    run(100, texts[30:])
    assert store.golden().count() == 10 and store.table("person").count() == 10
    assert [r.data for r in store.read("quarantine", "data string").collect()] == ['{"foo":1}']
    moved = {p.name for p in archive.rglob("*.parquet")}
    assert first <= moved and left() <= 1


def test_every_window_of_a_bounded_run_appears(spark, tmp_path):
    rows = files(
        spark,
        tmp_path / "in",
        [("t", 0, 0, NOON), ("t", 0, 1, NOON + timedelta(hours=5))],
        [("t", 0, 2, NOON), ("t", 0, 3, NOON - timedelta(days=2))],
    )
    SI.start_rate(rows, str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    got = SI.read_rate(spark, str(tmp_path / "out")).agg(F.count("*"), F.sum("messages")).first()
    assert tuple(got) == (3, 4)


def test_a_new_checkpoint_goes_on_above_the_last_commit(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.number_of(0, "a") == 0
    store.commit(0, {}, query="a", query_batch=0)
    assert store.number_of(0, "a") is None  # a replay
    assert store.number_of(1, "a") == 1
    store.commit(1, {}, query="a", query_batch=1)
    assert store.number_of(0, "b") == 2  # counts from 0 again
    store.commit(2, {}, query="b", query_batch=0)
    assert store.number_of(2, "a") == 3
    store.commit(3, {}, query="a", query_batch=3)
    with pytest.raises(ValueError):
        store.number_of(2, "a")
    assert store.number_of(3) is None and store.number_of(4) == 4  # without a query


def test_the_id_of_a_query_is_in_its_checkpoint(spark, tmp_path):
    rows = files(spark, tmp_path / "in", [("t", 0, 0, NOON)])
    query = SI.start(rows, str(tmp_path / "out"), str(tmp_path / "at"))
    query.awaitTermination()
    assert SC.query_id(spark, str(tmp_path / "at")) == query.id


def test_no_local_scratch_folder_on_a_cluster(spark):
    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: pytest.fail("set"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_root(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))
