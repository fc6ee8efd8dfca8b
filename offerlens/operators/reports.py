"""Market reports behind the reference's dashboards and console summaries.

All are group-bys or global aggregates: partial (map-side) aggregation runs
before the shuffle, so a hot key (one category holding a third of the rows)
costs one pre-aggregated row per task, not a skewed reducer.  Null keys are
dropped and results are ordered explicitly, as pandas does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dashboard fill defaults.
UNKNOWN = "Inconnu"


def dashboard_fill(df: DataFrame) -> DataFrame:
    """Load-time fills of the dashboard: unknown category/contract/class, cluster -1, remote false."""
    fills = {"category": UNKNOWN, "contract_type": UNKNOWN, "salary_category": UNKNOWN}
    out = df.na.fill({k: v for k, v in fills.items() if k in df.columns})
    if "cluster" in df.columns:
        out = out.withColumn("cluster", F.coalesce(F.col("cluster"), F.lit(-1)))
    if "remote" in df.columns:
        out = out.withColumn("remote", F.coalesce(F.col("remote").cast("int"), F.lit(0)))
    return out


def filtered_offers(df: DataFrame, categories=None, contracts=None, clusters=None,
                    salary_classes=None) -> DataFrame:
    """ANDed optional ``isin`` filters; an empty or missing list means no filter.

    ``isin`` on a Parquet column is pushed into the scan (``PushedFilters: In``).
    """
    conds = [F.col(c).isin(list(v)) for c, v in
             (("category", categories), ("contract_type", contracts), ("cluster", clusters),
              ("salary_category", salary_classes)) if v]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def value_counts(df: DataFrame, col: str, n: int | None = 20) -> DataFrame:
    """``value_counts().head(n)``: null keys dropped, count desc then key asc."""
    out = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc(col)))
    return out.limit(n) if n else out


def class_distribution(df: DataFrame, col: str = "salary_category") -> DataFrame:
    """Counts per class including null, with the share in percent (1 decimal)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return (counts.crossJoin(F.broadcast(total))
            .select(col, "n", F.bround(F.col("n") * F.lit(100.0) / F.col("total"), 1).alias("pct")))


def count_by(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(col))


def avg_salary_by(df: DataFrame, col: str, salary: str = "salary_avg") -> DataFrame:
    """Mean salary per key over rows with a salary; empty input gives no rows."""
    return (df.where(F.col(salary).isNotNull() & F.col(col).isNotNull())
            .groupBy(col).agg(F.avg(salary).alias("salary_avg")).orderBy(col))


def kpis(df: DataFrame, salary: str = "salary_avg", remote: str = "remote") -> DataFrame:
    """Offers, mean salary (0 dp) and remote share in percent (1 dp), in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("n_offers"),
        F.bround(F.avg(salary), 0).alias("mean_salary"),
        F.bround(F.avg(F.col(remote).cast("double")) * 100.0, 1).alias("remote_pct"),
    )


def filter_options(df: DataFrame, cols=("category", "contract_type", "cluster", "salary_category")) -> DataFrame:
    """Sorted distinct values of each filter column, as (column, value) rows.
    One scan: a row's values become (column, value) pairs, and the distinct
    pairs are found before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols if c in df.columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct().orderBy("column", "value")


def ingest_report(df: DataFrame, id_col: str = "job_id", text_col: str = "description") -> DataFrame:
    """Rows, distinct ids, non-null descriptions and their mean length."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(id_col).alias("n_ids"),
        F.count(text_col).alias("n_descriptions"),
        F.avg(F.length(text_col)).alias("mean_description_length"),
    )


def cluster_profile(df: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean of each feature by cluster (the centroid table of the reference)."""
    return (df.where(F.col(cluster).isNotNull()).groupBy(cluster)
            .agg(*[F.avg(c).alias(c) for c in features]).orderBy(cluster))


def dashboard_reports(df: DataFrame) -> DataFrame:
    """Counts and mean salary by contract, by salary class and by cluster in ONE
    scan with GROUPING SETS (the reference recomputes each group-by).
    Output: (report, key, nb, salary_avg); null keys dropped."""
    keys = ["contract_type", "salary_category", "cluster"]
    g = (df.groupingSets([[k] for k in keys], *keys)
         .agg(F.count(F.lit(1)).alias("nb"), F.avg("salary_avg").alias("salary_avg"),
              F.grouping_id().alias("gid")))
    # grouping_id bits: contract_type=4, salary_category=2, cluster=1 (1 = aggregated away)
    report = (F.when(F.col("gid") == 3, F.lit("contract_type"))
              .when(F.col("gid") == 5, F.lit("salary_category")).otherwise(F.lit("cluster")))
    key = (F.when(F.col("gid") == 3, F.col("contract_type"))
           .when(F.col("gid") == 5, F.col("salary_category"))
           .otherwise(F.col("cluster").cast("string")))
    return (g.select(report.alias("report"), key.alias("key"), "nb", "salary_avg")
            .where(F.col("key").isNotNull()))
