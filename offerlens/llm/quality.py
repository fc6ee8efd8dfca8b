"""Quality rules by distribution divergence (operator 5), DataFrame operations only.

Base counts of every text, then two histograms per document, each held against
the reference of its language by Jensen-Shannon distance (base 2):

* character classes: a-z, ASCII white space, A-Z, other letters, digits, the
  symbols ``#*$%&|<>``, other ASCII punctuation, anything else;
* common words: the ``COMMON`` most frequent words (lower case) of the
  language, and one class for all other words.

References are counts over all documents of the language, built in a pass of
its own.  A document is judged only from a minimum length on, and only against
a reference of ``REFERENCE_WORDS`` words or more.

References are one row per language.  Up to ``BROADCAST_ROWS`` of them are
broadcast; with more, documents and references meet in an equi-join on
language and a salt, so that a frequent language is not one task.

Defined results: a null, empty or blank text has counts 0 and fails the base
rule; null is a language of its own; repeated rows are judged each for itself;
texts are read whole; an empty table gives an empty table; input columns named
like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, null_free, table, without

COMMON = 20                # common words per language
WINDOW = 8                 # words of a window that may repeat
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
CLASS_MIN_WORDS, CLASS_DISTANCE = 30, 0.28
WORDS_MIN_WORDS, WORDS_DISTANCE = 50, 0.42
REFERENCE_WORDS = 2000
BROADCAST_ROWS, SALTS = 1000, 64
#: Character classes are taken out of the text one after the other.
CLASSES = {
    "lower": "[a-z]+", "space": SPACES, "upper": "[A-Z]+", "letter": r"\p{L}+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+",
    "punctuation": r"""[!"'()+,\-./:;=?@\[\\\]^_`{}~]+""", "other": None,
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur twice or more. Windows are compared by 64-bit hashes; equal ones stand side
    by side once sorted, so that the cost is n log n for any text."""
    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(F.slice(h, i + 1, WINDOW)))

    def covered(v):
        def marked(p):
            return F.filter(p, lambda e, k: F.get(p, k - 1)["h"].eqNullSafe(e["h"]) | F.get(p, k + 1)["h"].eqNullSafe(e["h"]))
        pairs = F.array_sort(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _let(pairs, lambda p: F.array_sort(F.transform(marked(p), lambda e: e["i"])))
        steps = _let(places, lambda p: F.transform(p, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(p, k - 1)))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(v):
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(covered(v))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(_let(hashed, lambda h: _let(windows(h), count))).cast("long")


def with_classes(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with _n_<class>: code points of every class."""
    left, chain = text, docs
    for name, pattern in CLASSES.items():
        if pattern is None:
            return chain.withColumn(f"_n_{name}", F.char_length(F.col(left)))
        chain = chain.withColumn(f"_r_{name}", F.regexp_replace(F.col(left), pattern, ""))
        chain = chain.withColumn(f"_n_{name}", F.char_length(F.col(left)) - F.char_length(F.col(f"_r_{name}")))
        left = f"_r_{name}"
    return chain


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, the class counts (_n_*) and the text as _text."""
    d = without(docs, BASE).withColumn("_text", null_free(F.col(f"`{text_col}`"))).withColumn("_words", words_of(F.col("_text")))
    d = with_classes(d, "_text")
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return d.withColumns({
        "n_words": F.size("_words").cast("long"), "word_chars": (F.char_length("_text") - F.col("_n_space")).cast("long"),
        "n_symbols": F.col("_n_symbol").cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_words"))}).drop("_words", *[f"_r_{c}" for c in CLASSES if c != "other"])


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per language: class counts, the common words and their counts, the number of words."""
    d = docs.select(F.col(f"`{lang_col}`").alias("lang"), null_free(F.col(f"`{text_col}`")).alias("_text"))
    classes = with_classes(d, "_text").groupBy("lang").agg(*[F.sum(f"_n_{c}").cast("double").alias(c) for c in CLASSES])
    words = d.select("lang", F.explode(words_of(F.lower("_text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    words = materialize(words, "language-words")
    total = words.groupBy("lang").agg(F.sum("n").alias("ref_words"))
    top = words.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("k") <= COMMON)
    listed = F.sort_array(F.collect_list(F.struct("k", "word", "n")))
    top = top.groupBy("lang").agg(listed.alias("c")).select("lang", F.transform("c", lambda x: x["word"]).alias("common"), F.transform("c", lambda x: x["n"]).alias("common_n"))
    same = lambda a, b: F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang"))
    joined = classes.alias("a").join(total.alias("b"), same("a", "b"), "left").join(top.alias("c"), same("a", "c"), "left")
    out = joined.select(F.col("a.lang").alias("ref_lang"), F.array(*[F.col(f"a.{c}") for c in CLASSES]).alias("ref_classes"),
                        F.coalesce("ref_words", F.lit(0)).alias("ref_words"), "common",
                        F.concat("common_n", F.array(F.col("ref_words") - F.aggregate("common_n", F.lit(0).cast("long"), lambda a, x: a + x))).alias("ref_common"))
    return materialize(out, "language-references")


def js_distance(p: Column, q: Column, p_sum: Column, q_sum: Column) -> Column:
    """Jensen-Shannon distance of two histograms (arrays of counts); 0 where one of them is empty."""
    def half(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: F.struct((x / p_sum).alias("a"), (y / q_sum).alias("b")))
    total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + 0.5 * (half(t["a"], t["b"]) + half(t["b"], t["a"])))
    return F.when((p_sum > 0) & (q_sum > 0), F.sqrt(F.greatest(total, F.lit(0.0)))).otherwise(F.lit(0.0))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with the base counts, base_failed, class_distance, words_distance and kept."""
    ref = references(docs, text_col, lang_col)
    d = base_counts(without(docs, ["base_failed", "class_distance", "words_distance", "kept"]), text_col)
    same = F.col(f"`{lang_col}`").eqNullSafe(F.col("ref_lang"))
    if ref.count() <= BROADCAST_ROWS:
        d = d.join(F.broadcast(ref), same, "left")
    else:
        salted = ref.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = d.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS))).join(salted, same & (F.col("_salt") == F.col("_s")), "left").drop("_salt", "_s")
    # every word between spaces of its own: taking out " w " shortens the text by w's occurrences
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col("_text")), SPACES, "  "), F.lit(" "))
    d = d.withColumn("_spaced", spaced).withColumn("_spaced_bytes", F.octet_length("_spaced"))
    counts = F.transform("common", lambda w: _let(F.concat(F.lit(" "), w, F.lit(" ")), lambda c: (
        (F.col("_spaced_bytes") - F.octet_length(F.replace(F.col("_spaced"), c, F.lit("")))) / F.octet_length(c))))
    d = d.withColumn("_common", counts)
    rest = F.col("n_words") - F.aggregate("_common", F.lit(0.0), lambda a, x: a + x)
    sum_of = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    classes = F.array(*[F.col(f"_n_{c}").cast("double") for c in CLASSES])
    d = d.withColumns({
        "class_distance": js_distance(classes, F.col("ref_classes"), F.char_length("_text").cast("double"), sum_of("ref_classes")),
        "words_distance": js_distance(F.concat("_common", F.array(rest)), F.col("ref_common"), F.col("n_words").cast("double"), F.col("ref_words").cast("double"))})
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    known = F.coalesce(F.col("ref_words"), F.lit(0)) >= REFERENCE_WORDS
    odd = ((F.col("n_words") >= CLASS_MIN_WORDS) & (F.col("class_distance") > CLASS_DISTANCE)) | \
          ((F.col("n_words") >= WORDS_MIN_WORDS) & (F.col("words_distance") > WORDS_DISTANCE))
    d = d.withColumn("kept", ~F.col("base_failed") & ~(known & F.coalesce(odd, F.lit(False))))
    return d.drop("_text", "_spaced", "_spaced_bytes", "_common", "ref_lang", "ref_classes", "ref_words", "common", "ref_common", *[f"_n_{c}" for c in CLASSES])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select("doc_id", *BASE, "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"),
                              F.round("words_distance", 6).alias("words_distance"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules keep.

    The row number keeps Catalyst from pushing the filter below the verdict's
    projections, where it would repeat their expressions once per use."""
    judged = judge(docs).withColumn("_row", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_row") >= 0)).select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t0 FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t0, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t0, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    regexp_replace(t0, '[a-z]+', '', 'g') AS t1 FROM d),
c2 AS (SELECT *, regexp_replace(t1, '[\x20\x09-\x0D]+', '', 'g') AS t2 FROM w),
c3 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM c2),
c4 AS (SELECT *, regexp_replace(t3, '\p{L}+', '', 'g') AS t4 FROM c3),
c5 AS (SELECT *, regexp_replace(t4, '[0-9]+', '', 'g') AS t5 FROM c4),
c6 AS (SELECT *, regexp_replace(t5, '[#*$%&|<>]+', '', 'g') AS t6 FROM c5),
c7 AS (SELECT *, regexp_replace(t6, '[!"''()+,\-./:;=?@\[\\\]^_`{}~]+', '', 'g') AS t7 FROM c6),
cl AS (
  SELECT rid, doc_id, lang, ws, ls, t0, length(t0) AS n_chars, len(ws)::BIGINT AS n_words, (length(t0) - (length(t1) - length(t2)))::BIGINT AS word_chars,
    (length(t5) - length(t6))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    [length(t0) - length(t1), length(t1) - length(t2), length(t2) - length(t3), length(t3) - length(t4), length(t4) - length(t5),
     length(t5) - length(t6), length(t6) - length(t7), length(t7)] AS cs FROM c7),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], chr(1)) AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM cl WHERE len(ws) >= 8)),
rep AS (
  SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
rw AS (SELECT rid, sum(CASE WHEN p IS NULL THEN 8 ELSE least(8, i - p) END)::BIGINT AS n FROM rep GROUP BY rid),
rc AS (SELECT lang, j, sum(cs[j])::DOUBLE AS q FROM cl, range(1, 9) AS r(j) GROUP BY lang, j),
rct AS (SELECT lang, sum(q) AS qs FROM rc GROUP BY lang),
cj AS (
  SELECT rid, sum(CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0 END + CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0 END) / 2 AS v
  FROM (SELECT rid, cs[j]::DOUBLE / n_chars AS a, q / qs AS b FROM cl JOIN rc ON cl.lang IS NOT DISTINCT FROM rc.lang
    JOIN rct ON cl.lang IS NOT DISTINCT FROM rct.lang WHERE n_chars > 0 AND qs > 0) GROUP BY rid),
tok AS (SELECT rid, lang, lower(unnest(ws)) AS word FROM cl),
lw AS (SELECT lang, word, count(*) AS n FROM tok GROUP BY lang, word),
lt AS (SELECT lang, sum(n)::DOUBLE AS total FROM lw GROUP BY lang),
top AS (SELECT lang, word, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM lw) WHERE k <= 20),
dw AS (SELECT rid, lang, word, count(*) AS n FROM tok GROUP BY ALL),
hist AS (
  SELECT cl.rid, n_words, total, top.n AS q, coalesce(dw.n, 0) AS p FROM cl JOIN top ON cl.lang IS NOT DISTINCT FROM top.lang
    JOIN lt ON cl.lang IS NOT DISTINCT FROM lt.lang LEFT JOIN dw ON dw.rid = cl.rid AND dw.word = top.word),
full_hist AS (
  SELECT rid, p / n_words::DOUBLE AS a, q / total AS b FROM hist WHERE n_words > 0
  UNION ALL SELECT rid, (any_value(n_words) - sum(p)) / any_value(n_words)::DOUBLE, (any_value(total) - sum(q)) / any_value(total) FROM hist WHERE n_words > 0 GROUP BY rid),
wj AS (
  SELECT rid, sum(CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0 END + CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0 END) / 2 AS v
  FROM full_hist GROUP BY rid),
j AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
    n_words < 20 OR 100 * coalesce(rw.n, 0) > 30 * n_words AS base_failed, sqrt(greatest(coalesce(cj.v, 0), 0)) AS cd, sqrt(greatest(coalesce(wj.v, 0), 0)) AS wd,
    coalesce(total, 0) >= 2000 AS known
  FROM cl LEFT JOIN rw USING (rid) LEFT JOIN cj USING (rid) LEFT JOIN wj USING (rid) LEFT JOIN lt ON cl.lang IS NOT DISTINCT FROM lt.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (known AND ((n_words >= 30 AND cd > 0.28) OR (n_words >= 50 AND wd > 0.42))) AS kept,
  round(cd, 6) AS class_distance, round(wd, 6) AS words_distance
FROM j
"""
