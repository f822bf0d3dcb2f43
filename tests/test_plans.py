"""What the plans must look like to hold at scale."""

import re

import pytest
from people import bronze, feed
from people import messages as people_messages
from pyspark.sql import functions as F

from goldweft import fixtures as X
from goldweft.fixtures import golden as fixture_golden
from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import keys as K
from goldweft.plans import consolidate as E
from goldweft.plans import load as LD
from goldweft.plans import run
from goldweft.queries import QUERIES
from goldweft.sources import feed as feed_source
from goldweft.sources.golden_json import read_golden_json
from goldweft.sources.staging import materialize
from goldweft.sources.store import Store

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_messages_are_scanned_and_parsed_once(spark):
    messages = materialize(feed(spark, people_messages()), "feed")
    plan = final_plan(E.consolidate(messages, "seq"))
    assert plan.count("FileScan") == 1 and plan.count("from_json(MapType") == 1
    assert plan.count("ReusedExchange") == 2


def test_pending_filter_reaches_the_scan(spark):
    golden = materialize(fixture_golden(spark, SF), "golden")
    plan = G.pending(golden).select("_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(n_sources,5)" in plan
    assert "ReadSchema: struct<_id:string,uploaded_2_SQL:boolean,n_sources:int>" in plan


@pytest.mark.parametrize(
    "name", ["consolidate", "consolidation_stats", "flat_person_dataset", "bronze_remaining_retained"]
)
def test_no_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def skew(spark):
    """Settings under which small partitions count as skewed and nothing is broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_name_is_split(spark, skew):
    """A third of all people share one name."""
    people = spark.range(6000).repartition(8).selectExpr(
        "id AS seq",
        "to_json(named_struct('passport', concat('P', id), 'name',"
        " CASE WHEN id % 3 = 0 THEN 'Hot' ELSE concat('N', id) END,"
        " 'last_name', 'X', 'sex', array('F'), 'email', sha2(CAST(id AS string), 256))) AS data",
    )
    places = spark.range(6000).selectExpr(
        "100000 + id AS seq",
        "to_json(named_struct('fullname', CASE WHEN id = 0 THEN 'hot x' ELSE concat('n', id, ' x')"
        " END, 'city', concat('C', id), 'address', concat('A', id))) AS data",
    )
    df = E.consolidate(people.unionByName(places), "seq")
    plan = final_plan(df)
    assert "skew=true" in plan
    assert df.filter("city = 'C0'").count() == 2000
    assert df.filter("city IS NOT NULL").count() == 6000


def test_hot_foreign_key_is_split(spark, skew):
    person = spark.range(2000).selectExpr("id", "concat('P', id) AS passport")
    rows = spark.range(9000).repartition(8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'P7' ELSE concat('P', id % 2000) END AS passport",
        "concat(uuid(), uuid()) AS filler",
    )
    df = K.resolve_person_fk(rows, person)
    assert "skew=true" in final_plan(df)
    assert df.filter("passport = 'P7'").count() >= 3000


def test_hot_bank_owner_is_split(spark, skew):
    from goldweft.operators.dump import dump_bank

    person = spark.range(2000).selectExpr(
        "id", "concat('P', id) AS passport", "'' AS name", "'' AS last_name", "'' AS full_name",
        "'' AS sex", "'' AS email", "'' AS phone",
    )
    bank = spark.range(9000).repartition(8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 1000 END AS person_id",
        "concat(uuid(), uuid()) AS iban", "'1$' AS salary",
    )
    df = dump_bank({"person": person, "bank": bank})
    assert "skew=true" in final_plan(df)
    assert df.count() == 9000 + 1000 and df.filter("bank_iban IS NULL").count() == 1000


def test_hot_bank_owner_in_the_whole_flat_data_set(spark, skew):
    from goldweft.operators.dump import flat_person_dataset

    person = spark.range(500).selectExpr(
        "id", "concat('P', id) AS passport", "'' AS name", "'' AS last_name", "'' AS full_name",
        "'' AS sex", "'' AS email", "'' AS phone",
    )
    bank = spark.range(9000).repartition(8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 400 END AS person_id",
        "concat(uuid(), uuid()) AS iban", "'1$' AS salary",
    )
    work = spark.range(500).selectExpr(
        "id", "id AS person_id", "'c' AS company", "'p' AS position", "'' AS phone", "'' AS email"
    )
    address = spark.range(500).selectExpr(
        "id", "'s' AS street_name", "'t' AS city", "'' AS ip_address"
    )
    links = spark.range(500).selectExpr("id AS address_id", "id AS person_id", "'Home' AS type")
    df = flat_person_dataset(
        {"person": person, "bank": bank, "work": work, "address": address, "person_address": links}
    )
    assert "skew=true" in final_plan(df)
    assert df.count() == 9000 + 100 and df.filter("bank_iban IS NULL").count() == 100
    assert df.filter("person_passport = 'P7' AND home_city = 't'").count() >= 3000


def test_bucketed_golden_is_not_shuffled_by_an_upsert(spark, skew, tmp_path):
    golden = materialize(fixture_golden(spark, SF), "golden")
    writer = golden.write.bucketBy(8, "_id").sortBy("_id").option("path", str(tmp_path / "g"))
    writer.saveAsTable("bucketed_golden")
    df = G.upsert(spark.table("bucketed_golden"), golden.filter("city > 'NATION_2'"))
    assert final_plan(df).count("Exchange hashpartitioning") == 1
    assert df.count() == golden.count()
    spark.sql("DROP TABLE bucketed_golden")


def _one_group_each(spark, folder, n):
    """Tables of ``n`` customers and as many orders, one file and row group each."""
    tables = {
        "customer": f"SELECT id AS c_custkey, CAST(id % 2 AS int) AS c_nationkey, 'BUILDING' AS c_mktsegment FROM range({n})",
        "orders": f"SELECT id AS o_orderkey, id AS o_custkey, 1.0D AS o_totalprice FROM range({n})",
        "nation": "SELECT CAST(id AS int) AS n_nationkey, concat('N', id) AS n_name FROM range(2)",
        "supplier": "SELECT id AS s_suppkey, concat('S', id) AS s_name, 0 AS s_nationkey FROM range(3)",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_feed_of_one_row_group_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_source, "TASK_ROWS", 100)
    rows = feed_source.messages(spark, _one_group_each(spark, tmp_path, 2000))
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 40
    total = sum(t["count"] for t in tasks)
    assert max(t["count"] for t in tasks) < 0.1 * total


def test_link_key_is_made_once(spark):
    messages = materialize(feed(spark, people_messages()), "feed")
    keyed = C.classify(messages).filter("link_key IS NOT NULL")
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schemaOfVariant(") == 1


def test_json_files_are_parsed_once(spark, tmp_path):
    record = '{"Golden": [{"_id": "1", "name": "A", "last_name": "B", "sex": "F"}, {"_id": "1"}, {"_id": null}]}'
    (tmp_path / "golden.json").write_text(record)
    load = LD.load_json(read_golden_json(spark, str(tmp_path)))
    assert "FileScan json" not in load.outcomes._jdf.queryExecution().executedPlan().toString()
    assert {r.outcome: r.records for r in load.outcomes.collect()} == {"processed": 1, "skipped": 2}


def test_run_spreads_a_batch_of_one_file(spark, tmp_path, monkeypatch):
    plans = {}

    def recorded(df, name, folder=None):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, name, folder)

    monkeypatch.setattr(run, "materialize", recorded)
    rows = materialize(bronze(spark, people_messages()).coalesce(1), "bronze")
    run.run_batch(Store(spark, str(tmp_path / "store")), rows, 0)
    assert "RebalancePartitions" in plans["classified"]


def test_feed_is_dealt_over_few_tasks_until_they_are_large(spark):
    """More than 200 tasks make each reading task sort its whole split."""
    rows = spark.range(3).selectExpr("id AS k", "id AS o")

    def tasks(n_rows):
        plan = feed_source._spread(rows, n_rows)._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"hashpartitioning\(.*?, (\d+)\)", plan).group(1))

    assert tasks(3) == spark.sparkContext.defaultParallelism
    assert tasks(5_000_000) == 50
    assert tasks(59_400_000) == tasks(200_000_000) == 200
    assert tasks(900_000_000) == 900


def test_keys_of_the_feed_are_dealt_by_its_size_not_by_the_session(spark, monkeypatch):
    """With few shuffle partitions, a task sorted a share of all keys however many there were."""
    monkeypatch.setattr(feed_source, "TASK_ROWS", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    try:
        for made in (X.latest, X.golden, X.old_golden, X.new_golden):
            plan = final_plan(made(spark, SF))
            dealt = {int(n) for n in re.findall(r"hashpartitioning\(domain[^)]*, (\d+)\)", plan)}
            assert dealt == {feed_source.dealt_messages(spark, SF)[1]} and min(dealt) > 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
