"""Whole pipeline runs against a store."""

import json

import pytest
from people import bronze, messages, people

from goldweft import schemas as S
from goldweft.operators.dump import flat_person_dataset
from goldweft.plans.run import dry_run, run_batch, run_json
from goldweft.sources.store import Store
from goldweft.streaming import consolidate as SC


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def by_id(store):
    return {r["_id"]: r for r in store.golden().collect()}


def test_first_batch_loads_everything(spark, store):
    run_batch(store, bronze(spark, messages()), 0)
    golden = by_id(store)
    assert len(golden) == 10 and all(r.uploaded_2_SQL for r in golden.values())
    counts = {t: store.table(t).count() for t in S.TABLES}
    assert counts == {"person": 10, "bank": 10, "work": 10, "address": 20, "person_address": 20}
    flat = {r.person_passport: r for r in flat_person_dataset(store.tables()).collect()}
    for p in people():
        row = flat[p["_id"]]
        assert (row.bank_iban, row.work_company) == (p["IBAN"], p["company"])
        assert (row.home_street, row.home_ip) == (p["address"], p["IPv4"])
        assert (row.work_street, row.work_city) == (p["company address"], "")
    stats = store.read("stats", "total_raw_messages bigint, golden_records_created bigint").first()
    assert (stats.total_raw_messages, stats.golden_records_created) == (50, 10)


def test_replay_of_a_batch_changes_nothing(spark, store):
    for _ in range(2):
        run_batch(store, bronze(spark, messages()), 0)
    assert store.table("person").count() == 10


def test_crash_before_commit_is_repeated(spark, store, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    run_batch(store, bronze(spark, messages()[:25]), 0)
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", fail)
        with pytest.raises(RuntimeError):
            run_batch(store, bronze(spark, messages()[25:], 100), 1)
    assert len(by_id(store)) == 5 and store.table("person").count() == 5
    run_batch(store, bronze(spark, messages()[25:], 100), 1)
    ids = sorted(r.id for r in store.table("person").collect())
    assert len(by_id(store)) == 10 and ids == list(range(1, 11))


PERSON = {"passport": "T-000", "name": "New", "last_name": "Abel", "sex": ["F"]}


@pytest.mark.parametrize("full", [False, True])
def test_replace_overwrites_with_nulls_and_resets_the_flag(spark, store, full):
    run_batch(store, bronze(spark, messages()), 0)
    run_batch(store, bronze(spark, [json.dumps(PERSON)], 100), 1, full=full)
    golden = by_id(store)
    row = golden["T-000"]
    assert len(golden) == 10
    assert (row.name, row.IBAN, row.uploaded_2_SQL, row.n_sources) == ("New", None, False, 1)
    assert golden["T-001"].uploaded_2_SQL is True
    stats = store.read("stats", "golden_records_created bigint, golden_records_updated bigint")
    assert stats.filter("batch_id = 1").first()[:2] == (0, 1)


@pytest.mark.parametrize("full", [False, True])
def test_coalesce_keeps_old_values(spark, store, full):
    run_batch(store, bronze(spark, messages()), 0)
    run_batch(store, bronze(spark, [json.dumps(PERSON)], 100), 1, merge="coalesce", full=full)
    row = by_id(store)["T-000"]
    assert (row.name, row.IBAN, row.n_sources) == ("New", "TT0000000000", 5)
    assert row.data_sources == list(S.SOURCES)
    # The record was loaded again: append is the default.
    assert store.table("person").filter("passport = 'T-000'").count() == 2
    assert store.table("person").count() == 11


def test_skip_existing(spark, store):
    run_batch(store, bronze(spark, messages()), 0)
    run_batch(store, bronze(spark, messages(), 100), 1, on_existing="skip")
    assert store.table("person").count() == 10
    assert all(r.uploaded_2_SQL for r in by_id(store).values())


@pytest.mark.parametrize("retain", [False, True])
def test_bank_before_person(spark, store, retain):
    bank = json.dumps({"passport": "T-000", "IBAN": "early", "salary": "1$"})
    run_batch(store, bronze(spark, [bank]), 0, retain_unmatched=retain)
    assert by_id(store) == {}
    run_batch(store, bronze(spark, [json.dumps(PERSON)], 100), 1, retain_unmatched=retain)
    assert by_id(store)["T-000"].IBAN == ("early" if retain else None)


def test_quarantine_holds_the_rest(spark, store):
    odd = ['{"foo":1}', "[1]", "{}", '{"passport":null,"IBAN":"a","salary":"b"}']
    run_batch(store, bronze(spark, odd + messages()), 0)
    left = store.read("quarantine", "shape string").collect()
    assert sorted(r.shape for r in left) == ["bank", "non_object", "unknown"]


def test_stream_of_two_batches(spark, store, tmp_path):
    folder = str(tmp_path / "bronze")
    for i in range(2):
        part = messages()[25 * i : 25 * i + 25]
        bronze(spark, part, 100 * i, f"2024-01-0{i + 1} 00:00:00").coalesce(1).write.mode(
            "append"
        ).parquet(folder)
        for _ in range(2):
            SC.start(
                spark,
                folder,
                store,
                str(tmp_path / "offsets"),
                trigger={"availableNow": True},
                full_every=1,
            ).awaitTermination()
    assert len(by_id(store)) == 10
    assert store.last_commit().batch_id == 1 and store.last_commit().base == 1
    assert sorted(r.id for r in store.table("address").collect()) == list(range(1, 21))


def outcomes(store, batch_id):
    rows = store.read("outcomes", "outcome string, records bigint").filter(f"batch_id = {batch_id}")
    return {r.outcome: r.records for r in rows.collect()}


def test_strict_run_flags_loaded_records_alone(spark, store, tmp_path):
    sexless = [m.replace('["F"]', "[]") if "T-001" in m else m for m in messages()]
    run_batch(store, bronze(spark, sexless), 0, load="strict")
    assert outcomes(store, 0) == {"processed": 9, "error": 1}
    assert [k for k, r in by_id(store).items() if not r.uploaded_2_SQL] == ["T-001"]
    assert store.table("person").count() == 9
    # The next run takes the mended record and skips those that have a person already.
    run_batch(store, bronze(spark, messages(), 100), 1, load="strict")
    assert outcomes(store, 1) == {"processed": 1, "skipped": 9}
    ids = sorted(r.id for r in store.table("person").collect())
    assert ids == list(range(1, 11))
    # Skipped records stay pending, as nothing of theirs was loaded.
    assert [k for k, r in by_id(store).items() if r.uploaded_2_SQL] == ["T-001"]
    # A replay of a committed batch changes nothing.
    run_batch(store, bronze(spark, messages(), 100), 1, load="strict")
    assert store.table("person").count() == 10


def test_crash_of_a_strict_run_is_repeated(spark, store, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Store, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(store, bronze(spark, messages()), 0, load="strict")
    assert by_id(store) == {}
    run_batch(store, bronze(spark, messages()), 0, load="strict")
    assert store.table("person").count() == 10 and outcomes(store, 0) == {"processed": 10}


def test_unknown_load_is_refused(spark, store):
    for options in ({"load": "other"}, {"load": "strict", "on_existing": "skip"}):
        with pytest.raises(ValueError):
            run_batch(store, bronze(spark, messages()), 0, **options)


def test_json_files_are_loaded_as_a_batch(spark, store, tmp_path):
    run_batch(store, bronze(spark, messages()[:25]), 0)
    path = tmp_path / "golden.json"
    path.write_text(json.dumps({"Golden": people()}))
    run_batch(store, bronze(spark, messages()[25:29], 100), 1)  # T-005 without its network
    for _ in range(2):
        run_json(store, str(path), 2)
    assert outcomes(store, 2) == {"processed": 5, "skipped": 5}
    assert sorted(r.id for r in store.table("person").collect()) == list(range(1, 11))
    golden = by_id(store)
    assert len(golden) == 6 and golden["T-005"].uploaded_2_SQL is True
    run_batch(store, bronze(spark, messages()[30:35], 200), 3, load="strict")
    assert outcomes(store, 3) == {"skipped": 1}


def test_json_files_into_an_empty_store(spark, store, tmp_path):
    path = tmp_path / "golden.json"
    path.write_text(json.dumps({"Golden": people()}))
    run_json(store, str(path), 0)
    assert store.table("person").count() == 10 and by_id(store) == {}
    run_batch(store, bronze(spark, messages()), 1, on_existing="skip")
    assert store.table("person").count() == 10


def test_dry_run_counts_and_writes_nothing(spark, store):
    stats = dry_run(bronze(spark, messages() + ["{}", '{"foo":1}'])).first()
    assert (stats.total_raw_messages, stats.golden_records_created) == (52, 10)
    assert (stats.raw_records_deleted, stats.golden_records_updated) == (51, 0)
    assert store.last_commit() is None
