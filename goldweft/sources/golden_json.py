"""Golden JSON files: ``{"Golden": [record, ...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweft import schemas as S
from goldweft.functions.payload import sex_is_scalar, sex_values

_SKIPPED = ("consolidated_at", "data_sources", "uploaded_2_SQL", "n_sources", "sex_is_scalar")


def read_golden_json(spark: SparkSession, path: str) -> DataFrame:
    """Golden columns plus ``position``, which orders records over all files.

    A file is one JSON value, so one task reads it; many files are read in parallel.
    ``sex`` is read as text because it may be a list or plain text.
    """
    fields = [f for f in S.GOLDEN.fields if f.name not in _SKIPPED]
    record = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    raw = (
        spark.read.schema(T.StructType([T.StructField("Golden", T.ArrayType(record))]))
        .option("multiLine", True)
        .json(path)
        .select(F.col("_metadata.file_path").alias("file"), F.posexplode("Golden"))
    )
    cols = []
    for f in S.GOLDEN.fields:
        if f.name == "sex":
            sql = sex_values("col.sex")
        elif f.name == "sex_is_scalar":
            sql = sex_is_scalar("col.sex")
        elif f.name in _SKIPPED:
            sql = f"CAST(NULL AS {f.dataType.simpleString()})"
        else:
            sql = f"col.`{f.name}`"
        cols.append(f"{sql} AS `{f.name}`")
    return raw.selectExpr(*cols, "struct(file, pos) AS position")
