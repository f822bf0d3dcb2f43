"""Ids, loads, JSON files, CSV and JDBC settings."""

import hashlib
import json

import pandas as pd
from people import feed, messages, people

from pyspark.sql import functions as F

from goldweft.operators import dump as DU
from goldweft.operators import keys as K
from goldweft.operators import surrogate as U
from goldweft.plans import consolidate as E
from goldweft.plans import load as LD
from goldweft.sources import relational as REL
from goldweft.sources.golden_json import read_golden_json


def test_ids_are_dense_and_follow_md5(spark):
    keys = [f"k{i}" for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    got = {r.k: r.id for r in U.assign_surrogate_ids(df, "k", base=10).collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))
    assert got == {k: 11 + i for i, k in enumerate(order)}


def test_ids_with_repeated_keys(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "id AS n")
    got = U.assign_surrogate_ids(df, "k", ("n",)).collect()
    assert sorted((r.n, r.id) for r in got) == [(i, i + 1) for i in range(1000)]


def test_person_fk_takes_the_greatest_id(spark):
    person = spark.createDataFrame([(1, "a"), (5, "a"), (2, "b")], "id bigint, passport string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "passport string")
    got = K.resolve_person_fk(rows, person).collect()
    assert sorted((r.passport, r.person_id) for r in got) == [("a", 5), ("b", 2)]
    assert [r.passport for r in K.unresolved_persons(rows, person).collect()] == ["c"]


def test_strict_load_counts_outcomes(spark):
    texts = messages() + [
        m.replace('["M"]', "[]") for m in messages() if '"T-002"' in m and "sex" in m
    ]
    golden = E.consolidate(feed(spark, texts), "seq")
    person = LD.build_tables(golden.filter("_id = 'T-001'"))["person"]
    load = LD.load_strict(golden, {**LD.empty_tables(spark), "person": person})
    outcomes = {r.outcome: r.records for r in load.outcomes.collect()}
    assert outcomes == {"processed": 8, "skipped": 1, "error": 1}
    rows = load.tables["person"].collect()
    assert len(rows) == 8 and min(r.id for r in rows) == 2
    assert all(r.full_name == f"{r.name} {r.last_name}" for r in rows)


def test_strict_load_takes_the_passport_for_a_missing_id(spark):
    golden = E.consolidate(feed(spark, messages()), "seq")
    named = golden.withColumn("passport", F.col("_id"))
    lost = named.withColumn("_id", F.expr("CASE WHEN _id = 'T-004' THEN '' END"))
    both = named.filter("_id < 'T-003'").unionByName(lost.filter("passport <> 'T-009'"))
    bare = lost.filter("passport = 'T-009'").withColumn("passport", F.lit(None).cast("string"))
    person = spark.createDataFrame([(7, "T-003")], "id bigint, passport string")
    load = LD.load_strict(both.unionByName(bare), {**LD.empty_tables(spark), "person": person})
    outcomes = {r.outcome: r.records for r in load.outcomes.collect()}
    # T-000 to T-002 come twice, T-003 has a person, one record has neither field.
    assert outcomes == {"processed": 8, "skipped": 4, "error": 1}
    passports = sorted(r.passport for r in load.tables["person"].collect())
    assert passports == [f"T-{i:03d}" for i in (0, 1, 2, 4, 5, 6, 7, 8)]


def test_golden_json_file(spark, tmp_path):
    records = people()
    records.append({**records[0], "name": "Second"})  # repeated id: the first stays
    records.append({**records[1], "_id": "T-100", "sex": "Male"})
    path = tmp_path / "golden.json"
    path.write_text(json.dumps({"Golden": records}, indent=2))
    source = read_golden_json(spark, str(path))
    assert source.count() == 12
    person = spark.createDataFrame([(7, "T-003")], "id bigint, passport string")
    load = LD.load_json(source, {**LD.empty_tables(spark), "person": person})
    rows = {r.passport: r for r in load.tables["person"].collect()}
    assert len(rows) == 10 and "T-003" not in rows
    assert rows["T-000"].name == "Ann0" and rows["T-100"].sex == "M"
    assert sorted(r.id for r in rows.values()) == list(range(8, 18))
    outcomes = {r.outcome: r.records for r in load.outcomes.collect()}
    assert outcomes == {"processed": 10, "skipped": 2}


def _tables(spark):
    s = spark.createDataFrame
    return {
        "person": s(
            [(1, "p1", "A", "B", 'say "x", y', "F", "", " e "), (2, "p2", "C", "D", "", "", "", "")],
            "id bigint, passport string, name string, last_name string, full_name string,"
            " sex string, email string, phone string",
        ),
        "bank": s(
            [(1, 1, "i1", "1$"), (2, 1, "i2", "2$"), (3, None, "lost", "3$")],
            "id bigint, person_id bigint, iban string, salary string",
        ),
        "work": s(
            [(1, 2, "co", "line\nbreak", "", "")],
            "id bigint, person_id bigint, company string, position string, phone string, email string",
        ),
        "address": s(
            [(1, "street", "town", "ip"), (2, "yard", "", "")],
            "id bigint, street_name string, city string, ip_address string",
        ),
        "person_address": s(
            [(1, 1, "Home"), (2, 1, "Work"), (9, 2, "Home")],
            "address_id bigint, person_id bigint, type string",
        ),
    }


def _expected():
    blank = dict.fromkeys(DU.FLAT_COLUMNS)
    p1 = {
        **blank, "person_passport": "p1", "person_name": "A", "person_last_name": "B",
        "person_full_name": 'say "x", y', "person_sex": "F", "person_email": "",
        "person_phone": " e ", "home_street": "street", "home_city": "town", "home_ip": "ip",
        "work_street": "yard", "work_city": "",
    }
    p2 = {
        **blank, "person_passport": "p2", "person_name": "C", "person_last_name": "D",
        "person_full_name": "", "person_sex": "", "person_email": "", "person_phone": "",
        "work_company": "co", "work_position": "line\nbreak", "work_phone": "", "work_email": "",
    }
    return [
        {**p1, "bank_iban": "i1", "bank_salary": "1$"},
        {**p1, "bank_iban": "i2", "bank_salary": "2$"},
        p2,
    ]


def test_flat_rows(spark):
    got = [r.asDict() for r in DU.flat_person_dataset(_tables(spark)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, _expected()))


def test_csv_text_is_what_pandas_writes(spark, tmp_path):
    flat = DU.flat_person_dataset(_tables(spark)).orderBy("person_passport", "bank_iban")
    REL.export_csv(flat.coalesce(1), str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    want = pd.DataFrame(_expected(), columns=list(DU.FLAT_COLUMNS)).to_csv(index=False)
    assert part.read_text() == want


def test_jdbc_settings(spark):
    class Options:
        def __init__(self):
            self.seen = {}

        def option(self, key, value):
            self.seen[key] = value
            return self

        def format(self, name):
            self.seen["format"] = name
            return self

        def mode(self, name):
            self.seen["mode"] = name
            return self

    class Frame:
        write = Options()

    class Session:
        read = Options()

    written = REL.jdbc_writer(Frame(), "jdbc:x", "PERSON", {"user": "u"}).seen
    assert written == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "PERSON",
        "batchsize": 5000, "user": "u",
    }
    read = REL.jdbc_reader(Session(), "jdbc:x", "PERSON", upper=100, partitions=4).seen
    assert (read["partitionColumn"], read["numPartitions"], read["upperBound"]) == ("id", 4, 100)
