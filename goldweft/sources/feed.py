"""A message feed derived from the star-schema tables.

Customers, their nations and suppliers give personal, location, professional and
network messages, orders give bank messages.  Some people lack some messages on
purpose (see ``FIXTURES.md``): that is what makes records incomplete.  Every table
is read whole, each of them once; customers and orders are counted before, from the
footers of their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Types of the given tables.  With them no job runs to look into the files.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


#: Customers and orders that one task makes messages of.  The aggregation behind sorts what a
#: task has, and a row group, which no reader splits, may hold millions of rows.
TASK_ROWS = 100_000
#: Up to so many tasks, Spark writes a shuffle straight to a file for each; for more, each
#: reading task sorts what it has read, a whole split.  So there are more of them only where
#: one would have more than MOST_ROWS.
FEW_TASKS, MOST_ROWS = 200, 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _message(seq: str, **fields: str) -> str:
    """One message as SQL: ``seq`` and an object of the given fields as JSON text."""
    pairs = ", ".join(f"'{key.replace('__', ' ')}', {sql}" for key, sql in fields.items())
    data = f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))"
    return f"named_struct('seq', {seq}, 'data', {data})"


# A double underscore stands for the blank in a key.
_PERSONAL = _message(
    "k * 10 + 1",
    name="CASE WHEN k % 40 = 7 THEN '' ELSE mkt END",
    last_name="concat('Fam', k % 1000)",
    sex="array(CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END)",
    telfnumber="concat(c_nationkey, '-', k)",
    passport="concat('P', k)",
    email="concat('u', k, '@example.com')",
)
_LOCATION = _message(
    "k * 10 + 2000000003",
    fullname="concat('  ', upper(mkt), ' FAM', k % 1000, ' ')",
    city="n_name",
    address="concat(k % 300, ' Main St')",
)
_PROFESSIONAL = _message(
    "k * 10 + 3000000004",
    fullname="concat(mkt, ' Fam', k % 1000)",
    company="s_name",
    company__address="concat(s_nationkey, ' Plaza')",
    company_telfnumber="concat('T', s_suppkey)",
    company_email="concat('s', s_suppkey, '@example.com')",
    job="concat('Job', k % 9)",
)
_NETWORK = _message(
    "k * 10 + 4000000005",
    address="concat(k % 300, ' MAIN ST')",
    IPv4="concat('10.0.', k % 256, '.1')",
)
_ODD = """named_struct('seq', k * 10 + 5000000006, 'data', CASE k % 3
    WHEN 0 THEN '{"foo":1}' WHEN 1 THEN '{}'
    ELSE '{"passport":null,"IBAN":"Z","salary":"1$"}' END)"""
_BANK = _message(
    "o * 10 + 1000000002",
    passport="concat(CASE WHEN o % 50 = 3 THEN 'X' ELSE 'P' END, o_custkey)",
    IBAN="concat('XX', o)",
    salary="concat(CAST(round(o_totalprice) AS bigint), '$')",
)
_PER_CUSTOMER = f"""array_compact(array({_PERSONAL},
    CASE WHEN k % 10 <> 0 AND n_nationkey IS NOT NULL THEN {_LOCATION} END,
    CASE WHEN k % 7 <> 0 AND s_suppkey IS NOT NULL THEN {_PROFESSIONAL} END,
    CASE WHEN k % 5 <> 0 THEN {_NETWORK} END,
    CASE WHEN k % 100 IN (1, 2, 3) THEN {_ODD} END))"""


def _tasks(spark: SparkSession, n_rows: int) -> int:
    """How many tasks of :data:`TASK_ROWS`, at least one for each core; beyond
    :data:`FEW_TASKS`, tasks of up to :data:`MOST_ROWS`."""
    cores = spark.sparkContext.defaultParallelism
    return max(min(-(-n_rows // TASK_ROWS), FEW_TASKS), -(-n_rows // MOST_ROWS), cores)


def _spread(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` dealt evenly over :func:`_tasks`, by all columns, so rows without a key spread
    too."""
    return rows.repartition(_tasks(rows.sparkSession, n_rows), *rows.columns)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed: ``seq bigint`` (unique; the higher one wins) and ``data string``."""
    return _made(_spread(*_rows(spark, sf_dir)))


def dealt_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The feed with ``task``, the task that makes the message, and the number of tasks.
    Rows are dealt as in :func:`_spread`."""
    rows, n_rows = _rows(spark, sf_dir)
    tasks = _tasks(spark, n_rows)
    task = F.pmod(F.hash(*rows.columns), F.lit(tasks)).alias("task")
    return _made(rows.select("*", task).repartitionById(tasks, "task"), "task"), tasks


def _made(rows: DataFrame, *kept: str) -> DataFrame:
    """The messages of each row."""
    return rows.selectExpr(
        f"inline(CASE WHEN o IS NOT NULL THEN array({_BANK}) ELSE {_PER_CUSTOMER} END)", *kept
    )


def _rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Customers, with their nation and supplier, and orders; how many they are."""
    customer = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_nationkey", "c_mktsegment AS mkt"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n_suppliers = supplier.groupBy().agg(F.count("*")).scalar()
    people = customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left").join(
        supplier, F.col("s_suppkey") == F.col("k") % n_suppliers, "left"
    )
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS o", "o_custkey", "o_totalprice"
    )
    n_rows = customer.select().unionAll(orders.select()).count()
    return people.unionByName(orders, allowMissingColumns=True), n_rows
