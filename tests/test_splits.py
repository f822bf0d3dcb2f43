"""Retained messages: the cut of the feed into batches must not change any result."""

import json
import random

import pytest
from people import bronze, messages, people
from pyspark.sql import functions as F

from goldweft import schemas as S
from goldweft.operators.dump import flat_person_dataset
from goldweft.plans.run import run_batch
from goldweft.sources import buckets
from goldweft.sources.store import Store


def run_batches(spark, path, rows, batches, size=8):
    store = Store(spark, str(path), size)
    for i, offsets in enumerate(batches):
        part = rows.filter(F.col("kafka_metadata.offset").isin(offsets))
        run_batch(store, part, i, retain_unmatched=True)
    return store


def golden_of(store):
    return sorted(str(r) for r in store.golden().drop("consolidated_at").collect())


def tables_of(store):
    """All five tables as one flat row a person, without ids; checks that ids are unique."""
    tables = store.tables()
    counts = {}
    for name, rows in tables.items():
        unique = "address_id" if name == "person_address" else "id"
        counts[name], ids = rows.agg(F.count("*"), F.count_distinct(unique)).first()
        assert ids == counts[name], name
    ids = [c for c in flat_person_dataset(tables).columns if c.endswith("_id") or c == "id"]
    flat = flat_person_dataset(tables).drop(*ids)
    return counts, sorted(str(r) for r in flat.collect())


def result_of(store):
    return golden_of(store), *tables_of(store)


def test_links_do_not_depend_on_the_cut(spark, tmp_path):
    texts = messages()
    rows = bronze(spark, texts)
    want = result_of(run_batches(spark, tmp_path / "one", rows, [list(range(len(texts)))]))
    assert len(want[0]) == 10 and all("n_sources=5" in r for r in want[0])
    assert want[1] == {"person": 10, "bank": 10, "work": 10, "address": 20, "person_address": 20}
    # Of every person all else comes before the personal message.
    late = [[i for i in range(50) if i % 5], list(range(0, 50, 5))]
    assert result_of(run_batches(spark, tmp_path / "late", rows, late)) == want


def troubled(rng):
    """Complete, incomplete, repeated and changed messages of people who share names and homes."""
    texts = messages()
    for person in people():
        record = {**person, "passport": person["_id"]}
        personal = {k: record[k] for k in ("passport", "name", "last_name", "sex")}
        kind = rng.randrange(6)
        if kind == 0:
            texts.append(json.dumps({**personal, "name": ""}))  # withdrawn, if it is the newest
        elif kind == 1:
            texts.append(json.dumps({**personal, "name": people()[0]["name"], "last_name": "Abel"}))  # a namesake
        elif kind == 2:
            texts.append(json.dumps({"fullname": record["fullname"], "city": "New", "address": people()[1]["address"]}))
        elif kind == 3:
            texts.append(json.dumps({"passport": record["_id"], "IBAN": "", "salary": ""}))  # no bank row any more
        elif kind == 4:
            texts.append(json.dumps({"address": record["address"], "IPv4": "198.51.100.200"}))
        else:
            texts.append(json.dumps(personal))
    texts += ["{}", '{"foo":1}', "[1]", '{"fullname":"","company":"x","job":"y"}']
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_random_cuts_and_orders(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(buckets, "DELTAS", 1)
    rng = random.Random(seed)
    texts = troubled(rng)
    rows = bronze(spark, texts)
    order = list(range(len(texts)))
    want = result_of(run_batches(spark, tmp_path / "one", rows, [order]))
    rng.shuffle(order)
    cuts = sorted(rng.sample(range(1, len(order)), 2))
    batches = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)])]
    store = run_batches(spark, tmp_path / "many", rows, batches, 3)
    assert result_of(store) == want
    assert max(len(b) for rows in store.state().parts.values() for b in rows.values()) == 1


def test_an_incomplete_message_withdraws_a_record_and_a_complete_one_restores_it(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run_batch(store, bronze(spark, messages()), 0, retain_unmatched=True)
    ids = {r.passport: r.id for r in store.table("person").collect()}
    gone = {"passport": "T-003", "name": None, "last_name": "Dahl", "sex": ["F"]}
    run_batch(store, bronze(spark, [json.dumps(gone)], 100), 1, retain_unmatched=True)
    assert store.golden().count() == 9 and store.table("person").filter("passport = 'T-003'").count() == 0
    assert store.table("bank").count() == 9 and store.table("address").count() == 18
    stats = store.read("stats", "golden_records_withdrawn bigint, unmatched_records bigint").filter("batch_id = 1").first()
    assert stats[:2] == (1, 1)
    back = {"passport": "T-003", "name": "Ann3", "last_name": "Dahl", "sex": ["F"]}
    run_batch(store, bronze(spark, [json.dumps(back)], 200), 2, retain_unmatched=True)
    assert {r.passport: r.id for r in store.table("person").collect()} == ids


def test_a_relinked_person_replaces_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run_batch(store, bronze(spark, messages()), 0, retain_unmatched=True)
    moves = [json.dumps({"address": p["address"], "IPv4": "203.0.113.9"}) for p in people()]
    run_batch(store, bronze(spark, moves, 100), 1, retain_unmatched=True)
    assert {t: store.table(t).count() for t in S.TABLES} == {"person": 10, "bank": 10, "work": 10, "address": 20, "person_address": 20}
    assert {r.home_ip for r in flat_person_dataset(store.tables()).collect()} == {"203.0.113.9"}
    stats = store.read("stats", "golden_records_created bigint, golden_records_updated bigint, raw_records_kept bigint, raw_records_deleted bigint")
    assert stats.filter("batch_id = 1").first()[:4] == (0, 10, 10, 0)


def test_late_and_repeated_messages_are_not_kept(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run_batch(store, bronze(spark, messages(), 100), 0, retain_unmatched=True)
    old = [json.dumps({"passport": "T-000", "IBAN": "old", "salary": "1$"})] * 2
    run_batch(store, bronze(spark, old), 1, retain_unmatched=True)
    stats = store.read("stats", "raw_records_kept bigint, raw_records_deleted bigint").filter("batch_id = 1").first()
    assert stats[:2] == (0, 2)
    assert store.golden().filter("_id = 'T-000'").first().IBAN == "TT0000000000"


def test_a_small_run_reads_only_the_buckets_it_touches(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), 32)
    run_batch(store, bronze(spark, messages()), 0, retain_unmatched=True)
    read = []
    raw = buckets.Buckets.raw

    def watched(self, name, schema, wanted=None):
        rows = raw(self, name, schema, wanted)
        read.append((name, {int(f.split("bucket=")[1].split("/")[0]) for f in rows.inputFiles()}))
        return rows

    monkeypatch.setattr(buckets.Buckets, "raw", watched)
    move = json.dumps({"address": people()[4]["address"], "IPv4": "203.0.113.9"})
    run_batch(store, bronze(spark, [move], 100), 1, retain_unmatched=True)
    assert {name for name, _ in read} >= {"passports", "names", "addresses", "golden", "people_of_name", "names_of_address"}
    assert all(len(found) <= 1 for _, found in read), read


def test_a_store_has_one_kind_of_runs(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run_batch(store, bronze(spark, messages()[:5]), 0, retain_unmatched=True)
    with pytest.raises(ValueError):
        run_batch(store, bronze(spark, messages()[5:10], 100), 1)
    with pytest.raises(ValueError):
        run_batch(store, bronze(spark, messages()[5:10], 100), 1, retain_unmatched=True, merge="coalesce")
