"""Plan-shape checks behind the scale claims (skew, pushdown, bounded state)."""

import pytest
from pyspark.sql import functions as F

from offerlens.operators import cards, reports
from offerlens.operators.salary import require_target, target_guard


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen_hot_key_is_a_hash_aggregate(spark):
    """A key holding a third of the rows: exact result, aggregated map-side
    (partial min_by), no window / sort of the hot group."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("job_id"), F.col("id").alias("offer_id"), (F.lit(n) - F.col("id")).alias("scraped_at"),
        F.lit("t").alias("title"))
    out = cards.offer_dedup(df)
    hot = out.where("job_id = 'hot'").first()
    assert hot["offer_id"] == max(i for i in range(n) if i % 3 == 0)  # smallest scraped_at
    assert out.count() == 1 + (n - n // 3)
    p = _plan(out)
    assert "Window" not in p and "partial_min_by" in p


def test_isin_filters_reach_the_parquet_scan(spark, tmp_path):
    df = spark.createDataFrame([("A", "CDI", 1, "Bas"), ("B", "CDD", 2, "Haut")],
                               "category STRING, contract_type STRING, cluster INT, salary_category STRING")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    f = reports.filtered_offers(spark.read.parquet(path), categories=["A"], contracts=["CDI", "Stage"])
    plan = _plan(f)
    # a one-value isin is rewritten to an equality; both reach the scan
    assert "PushedFilters" in plan and "EqualTo(category,A)" in plan and "In(contract_type" in plan
    assert f.count() == 1


def test_column_pruning_reaches_the_scan(spark, sf):
    from offerlens.plans.catalog import QUERIES
    plan = _plan(QUERIES["value_counts"](spark, sf))
    scans = [ln for ln in plan.split("\n") if "FileScan parquet" in ln and "orders" in ln or "ReadSchema" in ln]
    assert scans and all("o_totalprice" not in ln for ln in scans)


def test_target_guard_raises_like_the_reference(spark):
    few = spark.createDataFrame([(float(i), "Bas") for i in range(10)], "salary_avg DOUBLE, salary_category STRING")
    with pytest.raises(ValueError):
        require_target(few)
    ok = spark.createDataFrame([(float(i), ["Bas", "Moyen", "Haut"][i % 3]) for i in range(60)],
                               "salary_avg DOUBLE, salary_category STRING")
    require_target(ok)
    assert target_guard(ok).first()["classes_ok"]
