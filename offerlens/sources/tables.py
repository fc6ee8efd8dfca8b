"""Readers for the driver tables (one Parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_CONF = "spark.offerlens.spreadPartitions"
#: Tasks per core to which a table of few files is spread.
TASKS_PER_CORE = 3


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-repartition a scan on ``key`` into an explicit number of partitions.

    CPU-heavy per-row work (regexes over whole documents, HTML parsing) is
    bound by the number of scan tasks, and a file in one Parquet row group is
    one task however large it is (its other splits are empty).  The caller
    says how far to spread, as an argument or by the session setting
    ``spark.offerlens.spreadPartitions`` (0: the scan's own splits stay);
    without either, a table of fewer files than ``TASKS_PER_CORE`` tasks for
    each core of the cluster is spread to that many.
    """
    n = partitions
    if n is None:
        said = df.sparkSession.conf.get(SPREAD_CONF, None)
        tasks = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
        n = int(said) if said is not None else tasks if len(df.inputFiles()) < tasks else 0
    return df.repartition(n, key) if n else df


#: Rows of a partition that ``gather`` aims at.
GATHERED_ROWS = 50_000


def gather(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` with the rows of a key next to each other in one partition.  ``rows``: about how many rows there are; a
    partition has about ``GATHERED_ROWS`` of them, and there are at least as many partitions as ``spread`` makes.
    Wide columns that follow from narrow ones are best made afterwards: only what ``df`` holds is shuffled and sorted."""
    spark = df.sparkSession
    said = spark.conf.get(SPREAD_CONF, None)
    least = int(said) if said is not None else TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-rows // GATHERED_ROWS), 1), key).sortWithinPartitions(key)
