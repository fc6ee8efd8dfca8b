"""CSV / JSON / Parquet sources and sinks with declared schemas.

Paths are always given by the caller (on a cluster: a shared file system
folder, never a machine-local one).  Writes go through Spark's commit
protocol, so a lost executor's partial output is never visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

CSV_OPTIONS = dict(header=True, multiLine=True, escape='"', quote='"', encoding="UTF-8")
# Spark's CSV writer trims values by default; the reference keeps them.
CSV_WRITE_OPTIONS = dict(CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
CSV_READ_OPTIONS = dict(CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                        mode="FAILFAST")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """UTF-8 CSV with header and quoted multi-line text, declared schema
    (never inferred).  A leading BOM is stripped by the UTF-8 decoder.
    multiLine files are not splittable: convert to Parquet after the first load."""
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", array_sep: str = ", ") -> None:
    """CSV sink.  CSV has no array type: array columns are written joined."""
    cols = [F.array_join(F.col(f.name), array_sep).alias(f.name) if isinstance(f.dataType, ArrayType)
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8, non-ASCII characters kept as they are."""
    df.write.mode(mode).option("encoding", "UTF-8").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  run_id: str | None = None) -> None:
    """Parquet sink; ``run_id`` (an argument, not the clock) adds a
    ``run_id=...`` partition so each run's output stays addressable."""
    out = df.withColumn("run_id", F.lit(run_id)) if run_id else df
    parts = (partition_by or []) + (["run_id"] if run_id else [])
    w = out.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
