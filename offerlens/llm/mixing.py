"""Mixing sources to target weights (operator 4), DataFrame operations only.

Targets: sources in code-point order (null last) get the weights in turn; the
total is shared by weight, no target above ``cap`` times its source's size,
the excess reshared among the others.  With sources sorted by cap over weight
the capped ones are a prefix, so running sums give the fixed point at once.

Sampling (Pareto order sampling): a source at m copies per document takes
floor(m) whole copies of each as certain; for the rest every document has the
inclusion probability l = m - floor(m) and the rank (u / (1-u)) / (l / (1-l))
with u from a hash of seed and id.  The sample's size is fixed in words: along
the ranks documents are taken while they fit the words still wanted, one that
does not fit is passed over (``refill``), and one document of those left closes
the gap where its size brings the sum nearer.

Ranks are positions along u, found without one task per source: u is cut into
buckets of about ``BUCKET`` documents, buckets are summed up first, and a
window only orders the documents of one bucket.

Defined results: a null or blank text has size 0; null is a source of its own;
a source of size 0 has target 0; equal rows are documents of their own, ranked
next to each other; an empty table gives an empty table; other columns are not
carried; reruns agree, as nothing but the rows and the seed enters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, null_free, table

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
BUCKET = 1024


def uniform(id_text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of a hash of seed and id."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), id_text)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs, sid, target) from (source, source_size, n_docs); one row per source."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.col("sid"), F.lit(len(weights))) + 1)
    s = sizes.withColumn("sid", F.row_number().over(named) - 1).withColumn("weight", w.cast("long"))
    s = s.withColumn("limit", F.col("source_size") * cap)
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("sid"))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"total": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole),
                       "limits_before": F.coalesce(F.sum("limit").over(before), F.lit(0)),
                       "weights_before": F.coalesce(F.sum("weight").over(before), F.lit(0))})
    s = s.withColumn("share", (F.col("total") - F.col("limits_before")) / (F.col("weights") - F.col("weights_before")))
    s = s.withColumn("capped", F.col("weight") * F.col("share") >= F.col("limit"))
    # along the order the first source that is not capped sets the level of all behind it
    first_free = F.min(F.when(~F.col("capped"), F.struct("limits_before", "weights_before", "share"))).over(whole)
    s = s.withColumn("level", first_free["share"])
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return s.select("source", "source_size", "n_docs", "sid", target.alias("target"))


def refill(left: DataFrame, gap: DataFrame) -> DataFrame:
    """(sid, rounds) for documents ``left`` (sid, size, position) and words wanted ``gap`` (sid, gap): going on
    along the positions, a document that fits is taken and one that does not is passed over.  Those taken
    have, in some round, a position up to ``until`` and a size up to ``half``, or the position ``until``.

    A round goes on to the document that brings the gap below its half: the first larger than half of it
    that fits, or the one with which the others exceed half.  So rounds grow with the logarithm of the gap.
    """
    fits = F.col("size") <= F.col("gap")
    open_ = materialize(left.join(gap, "sid").where(fits), "mix-open")
    small = F.col("size") <= F.col("gap") / 2
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("sid", "bucket").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rounds = gap.limit(0).select("sid", F.lit(0).cast("long").alias("until"), F.col("gap").alias("half"))
    while not open_.isEmpty():
        d = open_.withColumns({"bucket": F.floor(F.col("position") / BUCKET), "add": F.when(small, F.col("size")).otherwise(0)})
        full = d.groupBy("sid", "bucket").agg(F.sum("add").alias("words"))
        full = full.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"))
        d = d.join(full, ["sid", "bucket"]).withColumn("words", F.col("words_before") + F.sum("add").over(upto))
        used = F.when(small, F.col("words")).otherwise(F.col("words") + F.col("size"))
        ends = F.when(small, F.col("words") > F.col("gap") / 2).otherwise(used <= F.col("gap"))
        end = F.min(F.when(ends, F.struct(F.col("position").alias("until"), used.alias("used"))))
        none = F.struct(F.lit(2 ** 63 - 1).alias("until"), F.max("words").alias("used"))
        s = d.groupBy("sid", "gap").agg(F.coalesce(end, none).alias("end"))
        s = materialize(s.select("sid", F.col("end.until").alias("until"), (F.col("gap") / 2).alias("half"),
                                 (F.col("gap") - F.col("end.used")).alias("gap")), "mix-round")
        rounds = rounds.union(s.drop("gap"))
        open_ = open_.drop("gap").join(s.select("sid", "until", "gap"), "sid")
        open_ = materialize(open_.where((F.col("position") > F.col("until")) & fits).drop("until"), "mix-open")
    return rounds.groupBy("sid").agg(F.collect_list(F.struct("until", "half")).alias("rounds"))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Plan of the mix for ``rows`` (id, source, size and columns to carry; a written table, as it is read
    again): the same with source_size, target, copies (int) and taken (words)."""
    carried = rows.columns
    sized = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = materialize(targets(sized, weights, cap), "mix-sources")
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(per_doc).cast("long")
    s = sources.withColumnRenamed("source", "_source").withColumns({
        "whole": whole, "rest": per_doc - whole, "wanted": F.col("target") - whole * F.col("source_size"),
        "buckets": F.ceil(F.col("n_docs") / BUCKET)})
    d = rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "n_docs")
    id_text = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    d = d.withColumn("u", uniform(id_text, seed)).withColumn("bucket", F.floor(F.col("u") * F.col("buckets")))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("rest") / (1 - F.col("rest")))
    d = d.withColumn("rank", F.when(F.col("rest") > 0, odds))

    full = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    full = full.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"),
                       F.coalesce(F.sum("docs").over(earlier), F.lit(0)).alias("docs_before"))
    inside = Window.partitionBy("sid", "bucket").orderBy("rank", "u", F.col("id").asc_nulls_first(), "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.join(full, ["sid", "bucket"]).withColumns({
        "position": F.col("docs_before") + F.row_number().over(inside), "words": F.col("words_before") + F.sum("size").over(upto)})
    taken = F.col("rank").isNotNull() & (F.col("words") <= F.col("wanted"))
    d = d.withColumn("in", taken).drop("words_before", "docs_before", "bucket", "buckets", "u", "rank")
    ranked = materialize(d, "mix-ranked")

    def gaps(ranked: DataFrame) -> DataFrame:
        return ranked.groupBy("sid").agg((F.first("wanted") - F.coalesce(F.sum(F.when(F.col("in"), F.col("size"))), F.lit(0))).alias("gap"))

    def others(ranked: DataFrame) -> DataFrame:
        return ranked.where(~F.col("in") & (F.col("rest") > 0)).select("sid", "size", "position")

    def fitted(r: Column) -> Column:
        return ((F.col("position") <= r["until"]) & (F.col("size") <= r["half"])) | (F.col("position") == r["until"])

    ranked = ranked.join(refill(others(ranked), gaps(ranked)), "sid", "left")
    later = (F.col("rest") > 0) & F.coalesce(F.exists("rounds", fitted), F.lit(False))
    ranked = materialize(ranked.withColumn("in", F.col("in") | later).drop("rounds"), "mix-refilled")

    left = others(ranked).join(gaps(ranked), "sid")
    near = F.abs(F.col("gap") - F.col("size"))
    close = left.where(near < F.col("gap")).groupBy("sid").agg(F.min(F.struct(near.alias("d"), "position"))["position"].alias("closing"))
    out = ranked.join(close, "sid", "left")
    extra = F.col("in") | F.coalesce(F.col("position") == F.col("closing"), F.lit(False))
    out = out.withColumn("copies", (F.col("whole") + extra.cast("int")).cast("int"))
    return out.select(*carried, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def sizes(docs: DataFrame) -> DataFrame:
    """(id, source, size) of documents; size counts words."""
    size = F.regexp_count(null_free(F.col("text")), F.lit(WORD)).cast("long")
    return docs.select(F.col("doc_id").alias("id"), "source", size.alias("size"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    rows = materialize(sizes(table(spark, sf_dir, "documents")), "mix-sizes")
    out = mix(rows)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    kept = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-documents")
    size = F.regexp_count(null_free(F.col("text")), F.lit(WORD)).cast("long")
    rows = materialize(kept.select(F.col("doc_id").alias("id"), "source", size.alias("size"), "_row"), "mix-sizes")
    plan = mix(rows).where("copies > 0").select(F.col("_row").alias("_r"), "copies")
    out = kept.join(plan, F.col("_row") == F.col("_r"))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
w AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM s),
c AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS share
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
  SELECT *, weight * share >= cap AS capped FROM c),
t AS (
  SELECT source, source_size, sid, CASE WHEN capped THEN cap::DOUBLE
    ELSE weight * (SELECT arg_min(share, cap::DOUBLE / weight) FROM f WHERE NOT capped) END AS target FROM f),
m AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS per FROM t),
p AS (
  SELECT *, floor(per)::BIGINT AS whole, per - floor(per) AS rest, target - floor(per) * source_size AS wanted FROM m),
r AS (
  SELECT d.doc_id, d.size, p.*, row_number() OVER (
    PARTITION BY p.sid ORDER BY CASE WHEN rest > 0 THEN (u / (1 - u)) / (rest / (1 - rest)) END, u, doc_id, d.size) AS position
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
walk(sid, position, used, picked) AS (
  SELECT sid, 0::BIGINT, 0::BIGINT, FALSE FROM p
  UNION ALL
  SELECT r.sid, r.position, CASE WHEN r.rest > 0 AND k.used + r.size <= r.wanted THEN k.used + r.size ELSE k.used END,
    r.rest > 0 AND k.used + r.size <= r.wanted
  FROM walk k JOIN r ON r.sid = k.sid AND r.position = k.position + 1),
x AS (
  SELECT r.*, k.picked FROM r JOIN walk k USING (sid, position)),
g AS (
  SELECT sid, any_value(wanted) - coalesce(sum(size) FILTER (WHERE picked), 0) AS gap FROM x GROUP BY sid),
z AS (
  SELECT x.sid, arg_min(position, struct_pack(d := abs(gap - size), p := position)) AS closing
  FROM x JOIN g USING (sid) WHERE NOT picked AND rest > 0 AND abs(gap - size) < gap GROUP BY x.sid)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN picked OR position IS NOT DISTINCT FROM closing THEN 1 ELSE 0 END) * size)::BIGINT AS taken,
  (whole + CASE WHEN picked OR position IS NOT DISTINCT FROM closing THEN 1 ELSE 0 END)::INTEGER AS copies
FROM x LEFT JOIN z USING (sid)
"""
