"""Column hygiene and data-quality reports (DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The reference's null markers and known useless columns.
NULL_MARKERS = ["N/A", "n/a", "", " "]
DROP_COLUMNS = ["Lien logo", "Logo", "ID", "Source", "Unnamed: 0"]
SPARSE_THRESHOLD = 0.7


def null_markers(df: DataFrame, markers: list[str] = NULL_MARKERS) -> DataFrame:
    """Exact-match null markers -> null, on every string column (one projection)."""
    return df.select(*[
        F.when(F.col(f.name).isin(markers), F.lit(None).cast("string")).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields])


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Per-column defaults for nulls (columns absent from ``df`` are ignored)."""
    return df.na.fill({k: v for k, v in defaults.items() if k in df.columns})


def drop_columns(df: DataFrame, cols: list[str] = DROP_COLUMNS) -> DataFrame:
    """Drop listed columns when present (missing names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def null_shares(df: DataFrame) -> DataFrame:
    """One row: share of nulls per column (one scan, all columns together)."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])


def drop_sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD,
                        cols: list[str] = DROP_COLUMNS) -> DataFrame:
    """Drop listed columns, then every column whose null share is >= threshold.

    Needs the shares before the plan can be built: one small aggregate job
    returning one row of ``len(columns)`` doubles to the driver.
    """
    x = drop_columns(df, cols)
    shares = null_shares(x).first().asDict()
    return x.select(*[c for c in x.columns if shares[c] is not None and shares[c] < threshold])


def labeled_only(df: DataFrame, target: str = "salary_category") -> DataFrame:
    return df.dropna(subset=[target])


def bad_text_report(df: DataFrame, flag_col: str = "has_tracker_text") -> DataFrame:
    return df.agg(F.count_if(F.col(flag_col)).alias("n_tracker_text"),
                  F.count(F.lit(1)).alias("n_rows"))


def quality_report(df: DataFrame) -> DataFrame:
    """Final v2 statistics in one scan: salary, skills, remote, urgent, distinct
    cities and companies, mean skills per offer, non-null counts."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        F.count("salary_avg").alias("n_salary"),
        F.bround(F.count("salary_avg") * 100.0 / n, 1).alias("pct_salary"),
        F.count_if(F.col("nb_skills") > 0).alias("n_skills"),
        F.bround(F.count_if(F.col("nb_skills") > 0) * 100.0 / n, 1).alias("pct_skills"),
        F.sum("remote_possible").alias("n_remote"),
        F.sum("urgent").alias("n_urgent"),
        F.count_distinct("ville").alias("n_cities"),
        F.count_distinct("entreprise_clean").alias("n_companies"),
        F.avg("nb_skills").alias("mean_skills"),
        F.count("experience_years_v1").alias("n_experience_years") if "experience_years_v1" in df.columns
        else F.count("experience_encoded").alias("n_experience"),
    )


def geo_cardinality(df: DataFrame, cols=("ville", "departement", "entreprise_clean"),
                    approx: bool = False) -> DataFrame:
    """Distinct counts (nulls skipped, like ``nunique``).  ``approx`` uses
    HyperLogLog++ for constant memory at scale."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in cols])
