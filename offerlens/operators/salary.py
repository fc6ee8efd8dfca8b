"""Salary classes and summaries (DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.salary import fixed_bins, quantile_class

QUANTILES = (0.33, 0.66)
MIN_SALARIED = 50
CLASSES = ("Bas", "Moyen", "Haut")


def salary_thresholds(df: DataFrame, col: str = "salary_avg", approx: bool = False,
                      accuracy: int = 100000) -> DataFrame:
    """One-row frame (q33, q66) of the non-null values.

    Exact ``percentile`` matches pandas' linear interpolation.  Its partial
    aggregate is a map of distinct values -> counts, merged on one reducer:
    the state is bounded by the number of distinct salaries (rounded
    integers and halves), not by the row count.  ``approx=True`` switches to
    the constant-memory ``percentile_approx`` for unbounded domains.
    """
    x = F.col(col)
    pct = F.array(*[F.lit(p) for p in QUANTILES])
    agg = (F.percentile_approx(x, pct, accuracy) if approx else F.percentile(x, pct)).alias("q")
    return (df.where(x.isNotNull()).agg(agg)
            .select(F.col("q")[0].cast("double").alias("q33"), F.col("q")[1].cast("double").alias("q66")))


def with_salary_class(df: DataFrame, col: str = "salary_avg", target: str = "salary_category",
                      approx: bool = False) -> DataFrame:
    """Add the quantile class (Bas / Moyen / Haut, null when no salary).

    The thresholds are one row, so the cross join is a broadcast of a
    single row: no shuffle of ``df``.
    """
    th = salary_thresholds(df, col, approx)
    return (df.crossJoin(F.broadcast(th))
            .withColumn(target, quantile_class(col, F.col("q33"), F.col("q66")))
            .drop("q33", "q66"))


def with_fixed_bins(df: DataFrame, col: str = "salary_avg", target: str = "salary_category") -> DataFrame:
    return df.withColumn(target, fixed_bins(col))


def target_guard(df: DataFrame, col: str = "salary_avg", target: str = "salary_category") -> DataFrame:
    """One-row metrics of the reference's target checks (never raises)."""
    labeled = F.col(target).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(col).alias("n_salaried"),
        F.count_if(labeled).alias("n_labeled"),
        F.array_sort(F.collect_set(target)).alias("classes"),
    ).select(
        "n_rows", "n_salaried", "n_labeled", "classes",
        (F.col("n_salaried") >= MIN_SALARIED).alias("enough_salaries"),
        (F.col("classes") == F.array(*[F.lit(c) for c in sorted(CLASSES)])).alias("classes_ok"),
    )


def require_target(df: DataFrame, col: str = "salary_avg", target: str = "salary_category") -> None:
    """Raise like the reference when the target is not usable (one small job)."""
    m = target_guard(df, col, target).first()
    if m["n_salaried"] < MIN_SALARIED:
        raise ValueError(f"not enough salaried rows for a reliable target: {m['n_salaried']} < {MIN_SALARIED}")
    if not m["classes_ok"]:
        raise ValueError(f"unexpected classes: {m['classes']}")


def salary_summary(df: DataFrame, col: str = "salary_avg") -> DataFrame:
    """Median salary, salaried rows and their share of all rows."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(col).alias("n_salaried"),
        F.median(col).alias("median_salary"),
    ).withColumn("share_salaried", F.try_divide(F.col("n_salaried"), F.col("n_rows")))
