"""Relational tables over JDBC, and the CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

# Fixed value: rows per insert statement batch.
INSERT_BATCH = 5000


def jdbc_reader(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_on: str = "id",
    lower: int = 0,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrameReader:
    """Reader for a whole table; with bounds it reads in parallel ranges of ``split_on``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partitions and upper is not None:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader


def scan_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return jdbc_reader(spark, url, table, **kwargs).load()


def jdbc_writer(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> DataFrameWriter:
    writer = (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", INSERT_BATCH)
    )
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def append_tables(
    tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None
) -> None:
    """Append all tables, referenced ones before those that refer to them."""
    for name in ("person", "address", "bank", "work", "person_address"):
        jdbc_writer(tables[name], url, name.upper(), properties).save()


def export_csv(flat: DataFrame, path: str) -> None:
    """The flat data set as CSV: a header, no index, null and '' both blank, quotes
    doubled, blanks at the ends kept.  One file per task, each with its header."""
    (
        flat.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv_export(spark: SparkSession, path: str, columns) -> DataFrame:
    """An export read back, blanks as ''."""
    rows = (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return rows.na.fill("")
