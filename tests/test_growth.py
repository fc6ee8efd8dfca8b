"""Work that must not pass one task or be done again for another pass."""

from pyspark.sql import functions as F

from offerlens.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_file_is_spread_without_a_setting(spark, tmp_path):
    spark.range(0, 1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(t, "id").rdd.getNumPartitions() == tables.TASKS_PER_CORE * cores
    spark.range(0, 1000).repartition(tables.TASKS_PER_CORE * cores).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert "Exchange" not in _plan(tables.spread(many, "id"))
    spark.conf.set(tables.SPREAD_CONF, "0")
    try:
        assert "Exchange" not in _plan(tables.spread(t, "id"))
    finally:
        spark.conf.unset(tables.SPREAD_CONF)


def test_cleaning_is_not_done_again_for_a_filter(spark, sf):
    from offerlens.plans.catalog import QUERIES
    assert "regexp_replace" not in _plan(QUERIES["clean_text_cluster"](spark, sf))


def test_features_read_enriched_offers_once(spark, sf):
    from offerlens.plans.catalog import _eval_features
    assert "o_orderkey" not in _plan(_eval_features(spark, sf))


def test_fits_start_few_tasks(spark):
    from offerlens.models.clusters import canonical_order
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        n = canonical_order(spark.range(50).withColumn("f", F.rand(1)), "id", "f").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert n <= 3 * spark.sparkContext.defaultParallelism
