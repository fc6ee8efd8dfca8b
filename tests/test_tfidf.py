"""TF-IDF against plain Python, with repeated and null keys, and what it shuffles."""

import math
import re
from collections import Counter

import numpy as np
import pytest


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = [(1, "fr", "alpha beta alpha beta gamma"), (2, "fr", "Beta gamma gamma"), (2, "en", "alpha beta"), (3, "en", None),
         (4, None, "gamma delta a"), (None, "fr", "delta alpha beta"), (5, "en", "")]


def _plain_tfidf(max_features):
    docs = {}
    for k, _, t in TEXTS:
        toks = re.findall(r"\w{2,}", (t or "").lower())
        docs.setdefault(k, Counter()).update(toks + [" ".join(p) for p in zip(toks, toks[1:])])
    df, cf = Counter(t for c in docs.values() for t in c), sum(docs.values(), Counter())
    terms = sorted((t for t in df if df[t] >= 2), key=lambda t: (-cf[t], t))[:max_features]
    idf = {t: math.log((1 + len(TEXTS)) / (1 + df[t])) + 1 for t in terms}
    out = {}
    for k, c in docs.items():
        raw = {t: c[t] * idf[t] for t in terms if c[t]}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out |= {(k, t): v / norm for t, v in raw.items() if k is not None}
    return out


@pytest.mark.parametrize("max_features,limit", [(4, 4), (30000, 99), (None, 99)])
def test_tfidf_of_repeated_and_null_keys(spark, max_features, limit):
    from offerlens.models.tfidf import mean_terms_by_cluster, tfidf_long
    df = spark.createDataFrame(TEXTS, "k int, lang string, t string")
    w, _ = tfidf_long(df, "k", "t", 2, max_features, materialize=False)
    got, want = {(r.k, r.term): r.tfidf for r in w.collect()}, _plain_tfidf(limit)
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], [want[k] for k in want])
    carried, _ = tfidf_long(df, "k", "t", 2, max_features, materialize=False, carry=("lang",))
    means = [{(r.lang, r.term): (r.mean_tfidf, r.rank) for r in mean_terms_by_cluster(x, df.select("k", "lang"), "k", "lang", 3).collect()}
             for x in (w, carried)]
    assert means[0].keys() == means[1].keys() and np.allclose([means[0][k] for k in means[0]], [means[1][k] for k in means[0]])


def test_tfidf_shuffles_no_document_terms(spark):
    from offerlens.models.tfidf import term_counts, tfidf_long
    df = spark.createDataFrame(TEXTS, "k int, lang string, t string")
    w, _ = tfidf_long(df, "k", "t", 2, 30, materialize=False)
    assert not re.search(r"hashpartitioning\([^)]*term", _plan(w))
    arrays = spark.createDataFrame([(["b", "a", "b"],), (["b"],), ([],)], "t array<string>")
    counts = term_counts(arrays, "t")
    assert {(r.term, r.df, r.cf) for r in term_counts(arrays, "t").collect()} == {("a", 1, 1), ("b", 2, 3)}
    # shuffled by the term alone, after a partial aggregation
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", _plan(counts))) == {"term"}


def test_no_term_at_all(spark):
    from offerlens.models.tfidf import tfidf_long
    df = spark.createDataFrame([(1, "a b")], "k int, t string")
    assert tfidf_long(df, "k", "t", 2, 30, materialize=False)[0].count() == 0
