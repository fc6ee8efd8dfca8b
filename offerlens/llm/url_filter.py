"""URL filters with host word segmentation (operator 8).

A url is split into host and path; the longest rule that fits decides.  Other
urls are judged by a multinomial naive Bayes model over tokens of host and
path, trained on the urls that a rule decides.  Host labels are written
without spaces, so each is first split into words: a unigram model of the
words in the pages' visible text and Viterbi over the label.

Words, tokens and labels are counted with Spark over all pages; the unigram
table holds every word.  Each distinct host label is segmented once, from the
counts of the words that it may hold: stretches of the label of up to
``LONGEST`` letters meet the words in an equi-join, longer words by their first
``LONGEST`` letters.  Each distinct (host, path) is judged once; token weights
meet the tokens in an equi-join.

Defined results: a null url, or one without ``://``, has empty host and path,
no rule and no token, so the classes' prior decides; ties go to allow;
repeated rows are judged alike; without any url that a rule decides all other
urls are allowed; very long urls are read whole; an empty table gives an empty
table; other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import null_free, table

#: (rule, verdict): host and path of a rule are cut at its first slash.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
LONGEST = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[0])):
        h, p = r[:r.index("/")], r[r.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens_of(text: Column) -> Column:
    """Runs of letters of any script and digits, lower-case; digits in a row are one 0."""
    clean = F.regexp_replace(F.lower(text), r"[0-9]+", "0")
    return F.array_remove(F.split(clean, r"[^\p{L}0]+"), "")


def unigrams(pages: DataFrame) -> DataFrame:
    """(word, n): the words of the visible text."""
    text = F.regexp_replace(null_free(F.col("html")), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    word = F.explode(tokens_of(text))
    return pages.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def segment(label: str, cost: dict[str, float], unknown: float) -> list[str]:
    """Cheapest split of ``label``; a word that is not in the model costs ``unknown`` and ln 10 per letter."""
    letter = math.log(10)
    longest = max(map(len, cost), default=0)
    best: list[tuple[float, int]] = [(0.0, 0)]
    free = 0  # where an unknown word up to here begins cheapest, as each costs the same and ln 10 per letter
    for end in range(1, len(label) + 1):
        if best[end - 1][0] - (end - 1) * letter < best[free][0] - free * letter:
            free = end - 1
        known = ((best[at][0] + cost[label[at:end]], at) for at in range(max(0, end - longest), end) if label[at:end] in cost)
        best.append(min(known, default=(math.inf, 0)))
        best[end] = min(best[end], (best[free][0] + unknown + (end - free) * letter, free))
    out, end = [], len(label)
    while end:
        out.append(label[best[end][1]:end])
        end = best[end][1]
    return out[::-1]


def segments(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(label, words) for distinct host labels and the model (word, n), a written table, as it is read again."""
    import pyarrow as pa

    total = words.agg(F.sum("n")).first()[0] or 1
    unknown = math.log(total) + math.log(10)
    labels = materialize(labels.select("label", F.monotonically_increasing_id().alias("no")), "host-labels")
    # each place's next letters first, so that stretches do not carry the whole label
    ahead = labels.select("no", F.col("label").alias("_l"), F.explode(F.sequence(F.lit(1), F.length("label"))).alias("at"))
    ahead = ahead.select("no", (F.length("_l") - F.col("at") + 1).alias("room"), F.col("_l").substr(F.col("at"), F.lit(LONGEST)).alias("ahead"))
    pieces = ahead.select("no", "room", "ahead", F.explode(F.sequence(F.lit(1), F.length("ahead"))).alias("k"))
    pieces = pieces.select("no", F.substring("ahead", F.lit(1), F.col("k")).alias("piece"), "room")
    pieces = pieces.groupBy("no", "piece").agg(F.max("room").alias("room"))
    keyed = words.select(F.substring("word", 1, LONGEST).alias("piece"), "word", F.col("n").alias("count"))
    hits = pieces.join(keyed, "piece").where(F.length("word") <= F.col("room"))
    hits = hits.groupBy("no").agg(F.collect_list("word").alias("known"), F.collect_list("count").alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("label", "known", "counts")))
            got = [segment(x, {w: math.log(total / n) for w, n in zip(known or (), counts or ())}, unknown) for x, known, counts in rows]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(got, pa.list_(pa.string()))], names=["label", "words"])

    return labels.join(hits, "no", "left").select("label", "known", "counts").mapInArrow(run, "label string, words array<string>")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page (page_id, url, html)."""
    host, path = split_url(F.col("url"))
    urls = materialize(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    distinct = urls.groupBy("host", "path").agg(F.count("*").alias("n")).withColumns({"rule": rule, "ruled": verdict})
    distinct = materialize(distinct.withColumn("key", F.xxhash64("host", "path")), "distinct-urls")

    parts = tokens_of(F.col("host"))
    labels = distinct.select(F.explode(parts).alias("label")).distinct()
    words = segments(labels, materialize(unigrams(pages), "unigrams"))
    in_host = distinct.select("key", "host", "path", F.explode(parts).alias("label")).join(words, "label")
    in_host = in_host.select("key", "host", "path", F.explode("words").alias("token")).withColumn("token", F.concat(F.lit("host:"), F.col("token")))
    in_path = distinct.select("key", "host", "path", F.explode(tokens_of(F.col("path"))).alias("token"))
    tokens = in_host.union(in_path.withColumn("token", F.concat(F.lit("path:"), F.col("token"))))
    tokens = materialize(tokens.groupBy("key", "host", "path", "token").agg(F.count("*").alias("k")), "url-tokens")

    decided = distinct.where(F.col("ruled").isNotNull())
    by_class = {r["ruled"]: r["n"] for r in decided.groupBy("ruled").agg(F.sum("n").alias("n")).collect()}
    n_block, n_allow = by_class.get("block", 0), by_class.get("allow", 0)
    prior = math.log((n_block + 1) / (n_allow + 1)) if n_block and n_allow else -1.0
    at = ["host", "path"]
    seen = tokens.join(decided.select(*at, "n", "ruled"), at)
    table_ = seen.groupBy("token").agg(*[F.sum(F.when(F.col("ruled") == c, F.col("k") * F.col("n")).otherwise(0)).alias(c) for c in ("block", "allow")])
    table_ = materialize(table_, "token-classes")
    sums = table_.agg(F.sum("block"), F.sum("allow"), F.count("*")).first()
    blocks, allows, kinds = sums[0] or 0, sums[1] or 0, sums[2] or 0
    weight = F.log((F.col("block") + 1) / F.lit(float(blocks + kinds + 1))) - F.log((F.col("allow") + 1) / F.lit(float(allows + kinds + 1)))
    # a token that no rule has decided says only how large the classes are
    unseen = math.log((allows + kinds + 1) / (blocks + kinds + 1))
    scored = tokens.join(table_.select("token", weight.alias("w")), "token", "left")
    sums = scored.groupBy(*at).agg(F.round(F.sum(F.col("k") * F.coalesce("w", F.lit(unseen))), 9).alias("s"))
    both = F.lit(bool(n_block and n_allow))
    learnt = F.when(both & (F.coalesce("s", F.lit(0.0)) + prior > 0), F.lit("block")).otherwise(F.lit("allow"))
    verdicts = distinct.join(sums, at, "left").select(*at, "rule", F.coalesce("ruled", learnt).alias("verdict"))
    return urls.join(verdicts, at).select("page_id", "host", "path", "rule", "verdict")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
