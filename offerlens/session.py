"""Spark session and shared-folder helpers.

The library never creates its own session inside an operator: every public
function takes DataFrames (or a session) from the caller.  ``get_spark`` is a
convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "offerlens", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    if master is None:
        master = os.environ.get("SPARK_MASTER", f"local[{cpus}]")
    builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("OFFERLENS_SHUFFLE_PARTITIONS", cpus))
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.offerlens.spreadPartitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OFFERLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the one named by ``spark.checkpoint.dir``.

    On a cluster this setting names a distributed file system folder and is
    only read; where it is unset there, this raises, as a machine's own folder
    would be written by each executor for itself.  In a single process
    (``local[n]``: tests, bench) a scratch folder is created once per session
    and registered, so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="offerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never a local temp dir)."""
    return f"{shared_dir(spark)}/offerlens/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table in the shared folder and read it
    back: one job, columnar and compressed, and the lineage is cut (a lost
    executor re-reads the files instead of recomputing the plan).
    ``DataFrame.checkpoint()`` would compute the plan twice unless cached."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
