"""Feature preparation (DataFrame -> DataFrame).

Statistics (medians, means, standard deviations, category lists) are one
global aggregate each, returned as a single row and broadcast back: the
size of what is broadcast is one row, whatever the data size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls -> the column's exact median (pandas ``median``).  MLlib's
    ``Imputer`` uses an approximate median, so it is not used."""
    med = df.agg(*[F.median(c).alias(f"__med_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(med))
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__med_{c}")))
    return out.drop(*[f"__med_{c}" for c in cols])


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.fill(0, subset=cols)


def standardize(df: DataFrame, cols: list[str], prefix: str = "std_", digits: int | None = None) -> DataFrame:
    """``(x - mean) / std`` with the **population** std (sklearn's
    StandardScaler); a constant column gives 0.  MLlib's StandardScaler uses
    the sample std, so it is not used."""
    stats = df.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"__sd_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))
    for c in cols:
        z = (F.col(c) - F.col(f"__mu_{c}")) / F.nullif(F.col(f"__sd_{c}"), F.lit(0.0))
        z = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(z, F.lit(0.0)))
        out = out.withColumn(f"{prefix}{c}", F.bround(z, digits) if digits is not None else z)
    return out.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])


def one_hot(df: DataFrame, cols: list[str] | dict[str, list], values: dict[str, list] | None = None) -> DataFrame:
    """``pd.get_dummies``: one INT column ``<col>_<value>`` per listed value; a
    null, or a value that is not listed, gives zeros.

    The output schema depends on the values, so the wide form takes them as
    an argument; for a column of any cardinality use ``one_hot_long``."""
    vals = values or cols
    extra = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
             for c in cols for v in vals[c]]
    return df.select("*", *extra)


def one_hot_long(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One-hot in long form: a row (key, column, value) for every 1 of the wide
    form.  Any number of distinct values, no pass to find them, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (df.select(key, F.explode(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("p"))
            .select(key, "p.column", "p.value"))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2, seed: int = 42,
                     out: str = "is_test", bucket_bits: int = 20) -> DataFrame:
    """Exact stratified split: in each class, the ``round(f * n)`` rows with
    the smallest ``xxhash64(seed, key)`` (ties by key) are the test set.

    Deterministic, so a recomputed partition after an executor loss gives
    the same split.  No per-class sort of all rows: rows are hashed into
    ``2**bucket_bits`` ordered buckets, per-(class, bucket) counts give the
    boundary bucket of each class, and only that bucket's rows are ranked.
    ``key`` must identify rows (deduplicate copies first).
    """
    shift = 64 - bucket_bits
    x = (df.withColumn("__h", F.xxhash64(F.lit(seed), F.col(key)))
         .withColumn("__b", F.shiftright("__h", shift)))
    counts = x.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (counts.withColumn("__cum", F.sum("__c").over(w))
           .withColumn("__n", F.sum("__c").over(Window.partitionBy(label)))
           .withColumn("__k", F.bround(F.col("__n") * F.lit(test_fraction), 0).cast("long")))
    boundary = (cum.where((F.col("__cum") >= F.col("__k")) & (F.col("__cum") - F.col("__c") < F.col("__k")))
                .select(label, F.col("__b").alias("__bstar"), (F.col("__k") - F.col("__cum") + F.col("__c"))
                        .alias("__need")))
    # one row per class; its size decides how it is joined
    x2 = x.join(boundary, label, "left")
    in_b = x2.where(F.col("__b") == F.col("__bstar"))
    ranked = in_b.withColumn("__rn", F.row_number().over(
        Window.partitionBy(label).orderBy("__h", key))).withColumn(out, F.col("__rn") <= F.col("__need"))
    rest = x2.where(F.col("__bstar").isNull() | (F.col("__b") != F.col("__bstar"))).withColumn(
        out, F.coalesce(F.col("__b") < F.col("__bstar"), F.lit(False)))
    cols = df.columns + [out]
    return reduce(DataFrame.unionByName, [rest.select(*cols), ranked.select(*cols)])


def split_counts(split: DataFrame, label: str, out: str = "is_test") -> DataFrame:
    return split.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(out).alias("n_test"))
