"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: one sortable type); component is the smallest node
    reachable.  Each round is written to the shared folder: the plan stays short and lost executors only
    reread files.  Minima are aggregated before the shuffle; a hub's links meet its minimum in a plain
    equi-join, which adaptive execution may split, and never in a list."""
    cur = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur, seen = materialize(cur, "links"), None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
