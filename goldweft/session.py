"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the plans in this package are written for.  They are ordinary Spark
#: settings; a cluster's own values win over them (see :func:`build_session`).
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "goldweft", master: str | None = None, **conf) -> SparkSession:
    """A session with :data:`RECOMMENDED` settings; keyword arguments override them.

    ``conf`` keys use ``__`` for the dot: ``spark__sql__shuffle__partitions=8``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    Only a session that runs in one process (tests, a laptop) may do without one and gets
    a local folder; elsewhere executors would write to disks of their own.  Staged tables
    stay until the cluster clears that folder, as a returned DataFrame may read them later.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="goldweft-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
