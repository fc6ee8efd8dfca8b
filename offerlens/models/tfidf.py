"""TF-IDF with the reference's weighting (1-2-grams, min_df, max_features,
smooth idf + 1, L2 norm), in two forms:

* ``tfidf_long``: one row per (document, term).
  Vocabulary selection is a top-k (bounded by ``max_features``), so the
  vocabulary broadcast has a proven size bound.
* ``tfidf_vectors``: the same weights as MLlib sparse vectors for models
  (CountVectorizerModel over the same vocabulary, idf shifted by +1 like the reference).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.regex import WORD

# A token is a run of 2+ word characters (the reference's (?u)\b\w\w+\b).
TOKEN = f"[{WORD}]{{2,}}"


def words(text: Column) -> Column:
    """Lower-cased tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def with_grams(toks: Column, ngram_max: int = 2) -> Column:
    """Tokens followed by their 2-grams (space-joined); ``toks`` is a column of its own, it is read several times."""
    if ngram_max < 2:
        return toks
    big = F.filter(F.zip_with(toks, F.slice(toks, 2, F.greatest(F.size(toks), F.lit(1))),
                              lambda a, b: F.concat(a, F.lit(" "), b)), lambda x: x.isNotNull())
    return F.concat(toks, big)


def term_counts(docs: DataFrame, terms: str) -> DataFrame:
    """(term, df, cf): rows of ``docs`` whose array ``terms`` holds the term, and all its occurrences.

    A row hands on its terms once for cf and its distinct ones once for df, so one hash aggregate on the term,
    reduced in each task before the shuffle, gives both: no (document, term) row is shuffled."""
    t = F.col(terms)
    marked = F.concat(F.transform(t, lambda x: F.struct(x.alias("term"), F.lit(0).alias("first"))),
                      F.transform(F.array_distinct(t), lambda x: F.struct(x.alias("term"), F.lit(1).alias("first"))))
    each = docs.select(F.explode_outer(marked).alias("m")).where(F.col("m").isNotNull()).select("m.term", "m.first")
    return each.groupBy("term").agg(F.sum("first").alias("df"), F.sum(1 - F.col("first")).alias("cf"))


def vocabulary(counts: DataFrame, n_docs: DataFrame, min_df: int = 2, max_features: int | None = 30000) -> DataFrame:
    """(term, df, idf): terms in >= min_df documents, the ``max_features`` most
    frequent over the corpus (ties by term), idf = ln((1+n)/(1+df)) + 1."""
    stats = counts.where(F.col("df") >= min_df)
    if max_features:
        stats = stats.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    return (stats.crossJoin(F.broadcast(n_docs))
            .select("term", "df", (F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")))


def _weighing(vocab: list, terms_col: str, out: str) -> list:
    """Stages from an array of terms to its L2-normalised weights over ``vocab`` (rows with term and idf)."""
    return [CountVectorizerModel.from_vocabulary([r["term"] for r in vocab], terms_col, "_tf"),
            ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in vocab]), inputCol="_tf", outputCol="_w"),
            Normalizer(p=2.0, inputCol="_w", outputCol=out)]


def tfidf_long(df: DataFrame, key: str, text: str, min_df: int = 2, max_features: int | None = 30000,
               ngram_max: int = 2, materialize: bool = True, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Returns (weights (key, term, tfidf), vocabulary (term, df, idf)).

    Rows of the same key are one document (each counts in n).  Texts meet by
    key once; counts, weights and the norm are then taken inside a document's
    row over the vocabulary, which the driver holds (at most ``max_features``
    rows; without that limit everything stays in joins).  ``carry``: columns
    of ``df`` that every weight gets, as a join on the key would.  With
    ``materialize`` the documents' terms are written once as a table in the
    shared folder (``spark.checkpoint.dir``).
    """
    spark = df.sparkSession
    own = [F.collect_list(F.struct(*carry)).alias("carried")] if carry else []
    docs = df.groupBy(key).agg(F.collect_list(text).alias("_texts"), F.count(F.lit(1)).alias("_rows"), *own)
    rest = [key, "_rows", *(["carried"] if carry else [])]
    docs = docs.select(*rest, F.transform("_texts", words).alias("_words"))
    docs = docs.select(*rest, F.flatten(F.transform("_words", lambda w: with_grams(w, ngram_max))).alias("terms"))
    if materialize:
        from offerlens.session import materialize as mat
        docs = mat(docs, "terms")
    n_docs = docs.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("double").alias("n"))
    vocab = vocabulary(term_counts(docs, "terms"), n_docs, min_df, max_features)
    docs = docs.where(F.col(key).isNotNull())
    if not max_features:
        tf = docs.select(key, F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())
        w = tf.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")).join(vocab.select("term", "idf"), "term")
        w = w.withColumn("raw", F.col("tf") * F.col("idf"))
        norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
        out = w.join(norm, key).select(key, "term", (F.col("raw") / F.col("norm")).alias("tfidf"))
        return (out.join(df.select(key, *carry), key) if carry else out), vocab
    if carry:
        docs = docs.withColumn("carried", F.explode_outer("carried"))
    rest = [key, *[F.col(f"carried.{c}") for c in carry]]
    held = vocab.collect()
    vocab = spark.createDataFrame(held, vocab.schema)
    if not held:
        none = docs.select(*rest, F.lit("").alias("term"), F.lit(0.0).alias("tfidf"))
        return none.where(F.lit(False)), vocab
    vectors = PipelineModel(stages=_weighing(held, "terms", "_vec")).transform(docs)
    sparse = vectors.select(*rest, F.unwrap_udt("_vec").alias("_s"))
    weights = F.arrays_zip(F.col("_s.indices").alias("at"), F.col("_s.values").alias("tfidf"))
    pairs = sparse.select(key, *carry, F.explode_outer(weights).alias("p")).where(F.col("p").isNotNull())
    names = spark.createDataFrame([(i, r["term"]) for i, r in enumerate(held)], "at int, term string")
    out = pairs.select(key, *carry, "p.at", "p.tfidf").join(F.broadcast(names), "at")
    return out.select(key, *carry, "term", "tfidf"), vocab


def tfidf_vectors(df: DataFrame, text: str, out: str = "tfidf", min_df: int = 2,
                  max_features: int = 30000, ngram_max: int = 2) -> PipelineModel:
    """Fit the MLlib form; ``model.transform(df)[out]`` are L2-normalised
    sparse vectors with the reference's weights (helper columns start with
    ``_``; select what you need).  The vocabulary (at most
    ``max_features`` terms, ties by term) and the idf vector live in the
    driver model; both come from one aggregation over the terms."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=TOKEN, gaps=False, toLowercase=True,
                         minTokenLength=1)
    stages = [tok]
    if ngram_max >= 2:
        stages += [NGram(n=2, inputCol="_tok", outputCol="_big"),
                   SQLTransformer(statement="SELECT *, concat(_tok, _big) AS _terms FROM __THIS__")]
        terms_col = "_terms"
    else:
        terms_col = "_tok"
    docs = PipelineModel(stages=stages).transform(df)
    n_docs = df.agg(F.count(F.lit(1)).cast("double").alias("n"))
    held = vocabulary(term_counts(docs, terms_col), n_docs, min_df, max_features).collect()
    if not held:
        raise ValueError(f"no term occurs in {min_df} rows")
    return PipelineModel(stages=stages + _weighing(held, terms_col, out))


def vocabulary_terms(model: PipelineModel) -> list[str]:
    """The fitted vocabulary (bounded by max_features), index order."""
    for st in model.stages:
        if hasattr(st, "vocabulary"):
            return list(st.vocabulary)
    raise ValueError("no CountVectorizer stage")


def mean_terms_by_cluster(weights: DataFrame, labels: DataFrame, key: str, cluster: str = "cluster",
                          top: int = 15) -> DataFrame:
    """Top terms per cluster by mean TF-IDF over the cluster's documents
    (a document without the term counts as 0).  The ranking window holds
    one cluster's vocabulary terms: bounded by the vocabulary size.
    Weights that carry ``cluster`` already (``tfidf_long``'s ``carry``) meet no labels again."""
    from pyspark.sql import Window
    sizes = labels.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    w = weights if cluster in weights.columns else weights.join(labels.select(key, cluster), key)
    s = (w.groupBy(cluster, "term").agg(F.sum("tfidf").alias("s"))
         .join(F.broadcast(sizes), cluster).select(cluster, "term", (F.col("s") / F.col("n")).alias("mean_tfidf")))
    w = Window.partitionBy(cluster).orderBy(F.desc("mean_tfidf"), F.asc("term"))
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
