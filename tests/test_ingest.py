"""Decoding and the streaming jobs."""

import pytest

from goldweft import schemas as S
from goldweft.operators import decode as D
from goldweft.sources.kafka import read_file_stream
from goldweft.streaming import ingest as SI

TS = "2024-01-01 00:00:00"


def kafka(spark, rows):
    """rows: (key bytes, value bytes, offset)"""
    df = spark.createDataFrame(rows, "key binary, value binary, offset bigint")
    return df.selectExpr(
        "key", "value", "'t' AS topic", "0 AS partition", "offset", f"TIMESTAMP '{TS}' AS timestamp"
    )


def test_decode_and_rejects(spark):
    rows = kafka(
        spark,
        [
            (b"k\xff", b'{"a":1}', 0),
            (b"", b"[1]", 1),
            (None, b"ab\xff", 2),
            (None, None, 3),
            (None, b'{"a":1} x', 4),
            (None, b"{'a':1}", 5),
            (None, b'{"a":NaN}', 6),
            (None, b'1],[2', 7),
            (None, b'1},{"v":2', 8),
            (None, b"", 9),
        ],
    )
    kept = {r.offset: r for r in D.flat_envelope(D.decode_envelope(rows)).collect()}
    assert sorted(kept) == [0, 1, 6]
    assert kept[0].key == "k�" and kept[1].key is None
    assert kept[0].ts_ms == 1704067200000
    lost = {r.offset: r.reason for r in D.decode_rejects(rows).collect()}
    assert lost == {
        2: "bad_utf8",
        3: "tombstone",
        **dict.fromkeys((4, 5, 7, 8, 9), "bad_json"),
    }


def test_missing_timestamp(spark):
    rows = kafka(spark, [(None, b"{}", 0)]).selectExpr(
        "key", "value", "topic", "partition", "offset", "timestamp_millis(-1) AS timestamp"
    )
    assert D.flat_envelope(D.decode_envelope(rows)).first().ts_ms is None


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "offsets")


def _messages(spark, start, n):
    return kafka(spark, [(None, b'{"n":%d}' % i, i) for i in range(start, start + n)])


def test_resume_adds_only_new_files(spark, folders):
    source, target, checkpoint = folders
    for start in (0, 10):
        _messages(spark, start, 10).write.mode("append").parquet(source)
        for _ in range(2):
            stream = read_file_stream(spark, source, S.KAFKA)
            SI.ingest(stream, target, checkpoint).awaitTermination()
    offsets = [r.offset for r in spark.read.parquet(target).select("kafka_metadata.offset").collect()]
    assert sorted(offsets) == list(range(20))


def test_one_stream_into_two_places(spark, folders, monkeypatch):
    source, target, checkpoint = folders
    rows = kafka(spark, [(None, b'{"n":1}', 0), (None, b"x", 1), (None, None, 2), (None, b"\xff", 3)])
    rows.write.parquet(source)
    stream = read_file_stream(spark, source, S.KAFKA)
    SI.ingest_split(stream, target, checkpoint).awaitTermination()
    got = {r["kafka_metadata"].offset: r for r in SI.read_split(spark, target).collect()}
    assert {o: r.reason for o, r in got.items()} == {
        0: "kept", 1: "bad_json", 2: "tombstone", 3: "bad_utf8"
    }
    assert got[0].data == '{"n":1}' and got[0].value is None
    assert got[1].data is None and bytes(got[1].value) == b"x" and got[2].value is None
    kept = spark.read.schema(S.BRONZE).parquet(SI.bronze_folder(target)).collect()
    assert [r.data for r in kept] == ['{"n":1}']
    # A batch that was written whole and is repeated is left as it is.
    before = sorted(spark.read.parquet(target).inputFiles())
    again = f"{checkpoint}-again"
    SI.ingest_split(read_file_stream(spark, source, S.KAFKA), target, again).awaitTermination()
    assert sorted(spark.read.parquet(target).inputFiles()) == before


def test_reading_twice_leaves_the_bronze_schema_alone(spark, folders):
    source, target, checkpoint = folders
    names = S.BRONZE.fieldNames()
    kafka(spark, [(None, b'{"n":1}', 0)]).write.parquet(source)
    SI.ingest_split(read_file_stream(spark, source, S.KAFKA), target, checkpoint).awaitTermination()
    for _ in range(2):
        assert SI.read_split(spark, target).count() == 1
    assert S.BRONZE.fieldNames() == names == [f.name for f in S.BRONZE.fields]


def test_dedup_across_batches(spark, folders):
    source, target, checkpoint = folders
    for start in (0, 5):  # offsets 5..9 are replayed
        _messages(spark, start, 10).coalesce(1).write.mode("append").parquet(source)
        stream = SI.dedup(read_file_stream(spark, source, S.KAFKA))
        SI.ingest(stream, target, checkpoint).awaitTermination()
    offsets = [r.offset for r in spark.read.parquet(target).select("kafka_metadata.offset").collect()]
    assert sorted(offsets) == list(range(15))
