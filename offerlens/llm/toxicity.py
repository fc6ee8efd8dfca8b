"""Toxicity by weak supervision (operator 6).

1. Voters.  From at most ``LABELLED_ROWS`` labelled rows (fixed by a hash of
   the id; rows with crc32(id) mod 4 = 2 are never used) come the terms that
   mark the toxic class: words (lexicon) and beginnings of words (patterns,
   ``abc*``).  A term needs ``MIN_SUPPORT`` toxic rows and a smoothed share of
   toxic rows of ``MIN_PRECISION``; one that a better term implies is left
   out.  The first ``VOTERS`` vote, the first ``TERMS`` are features.
2. Label model.  Every document's votes are counted by pattern of votes over
   the whole table.  Voters whose votes correlate form groups; the evidence of
   k like votes of a group with mean correlation r counts 1 / (1 + (k - 1) r).
    Expectation maximisation estimates each voter's rate in either class,
   with the class balance and the rates in the labelled sample as prior (the
   sample weighs as much as the corpus); a round is one aggregation, the
   driver sees two numbers per voter.
3. Classifier.  Logistic regression on term features, fitted to the posterior
   labels of at most ``TRAINING_ROWS`` documents that are not held out.

Scores read the text alone.  Defined results: a null or empty text has no
term and gets the score of the intercept; labels that are null or name no
document are ignored, of repeated ones the largest counts; without any toxic
row all scores are the prior; repeated rows get equal scores; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..session import materialize
from .common import add_columns, null_free, table

LABELLED_ROWS = 20_000
TRAINING_ROWS = 20_000
VOTERS, TERMS = 60, 200
MIN_SUPPORT, MIN_PRECISION = 6, 0.9
PREFIXES = (4, 5, 6, 7, 8)
ROUNDS = 8
GROUPED_FROM = 0.15        # correlation from which two voters are in a group
THRESHOLD = 0.3
HELD_OUT = 2

_WORDS = re.compile(r"[^\W\d_]+")


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == HELD_OUT


def bounded(rows: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of the id.  A hash below a share that leaves about
    twice as many comes first, so that tasks do not each send ``n`` rows to the merge."""
    total = rows.count()
    h = F.xxhash64("doc_id")
    share = min(1.0, (2 * n + 1000) / max(total, 1))
    few = rows if share >= 1 else rows.where(F.col("doc_id").isNotNull() & (h <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)))))
    return few.orderBy(h, "doc_id").limit(n)


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def word_set(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def find_terms(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, float, float]], float]:
    """The terms with their rates among toxic and other rows, best first, and the share of toxic rows; all from the
    bounded labelled sample."""
    import pyarrow as pa

    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = bounded(known, LABELLED_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")   # at most LABELLED_ROWS rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {"": [0, 0]}
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                y = int(toxic == 1)
                seen[""][y] += 1
                for t in {t for w in word_set(text) for t in terms_of(w)}:
                    seen.setdefault(t, [0, 0])[y] += 1
            if len(seen) > 200_000:
                yield _counts(seen)
                seen = {"": [0, 0]}
        yield _counts(seen)

    def _counts(seen) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                           pa.array([v[1] for v in seen.values()], pa.int64())], names=["term", "clean", "toxic"])

    counts = rows.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = materialize(counts, "term-counts")
    totals = counts.where("term = ''").first()
    n_clean, n_toxic = (totals["clean"], totals["toxic"]) if totals else (0, 0)
    prior = (n_toxic + 1) / (n_clean + n_toxic + 2)
    precision = (F.col("toxic") + 0.1) / (F.col("toxic") + F.col("clean") + 0.5)
    good = counts.where((F.col("term") != "") & (F.col("toxic") >= MIN_SUPPORT) & (precision >= max(MIN_PRECISION, prior)))
    best = good.orderBy((F.col("toxic") * F.log(precision / prior)).desc(), F.col("term").endswith("*").desc(), F.length("term"), "term").limit(10 * TERMS)
    kept, stems = [], {}
    for r in best.collect():
        word = r["term"].rstrip("*")
        if any(word[:n] in stems for n in PREFIXES if n <= len(word)):       # a better pattern implies it
            continue
        inside = [c for stem, c in stems.items() if stem.startswith(word)]
        if inside:                                                           # it must be as good beyond a narrower pattern
            toxic, clean = max(inside)
            if r["toxic"] - toxic < MIN_PRECISION * (r["toxic"] - toxic + r["clean"] - clean + 1):
                continue
        kept.append((r["term"], r["toxic"] / n_toxic, r["clean"] / max(n_clean, 1)))
        if r["term"].endswith("*"):
            stems[word] = (r["toxic"], r["clean"])
    return kept[:TERMS], prior


_LOOKUPS: dict[tuple, dict] = {}


class _Hits(dict):
    """Word -> indices of the terms that it is or begins with."""

    def __init__(self, terms: tuple[str, ...]):
        super().__init__()
        self.index = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        got = tuple(self.index[t] for t in terms_of(word) if t in self.index)
        if len(self) < 400_000:
            self[word] = got
        return got


def with_hits(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``docs`` with hits: sorted indices of the terms in the text."""
    key = tuple(terms)

    def run(texts: list) -> list[list]:
        if key not in _LOOKUPS:
            _LOOKUPS[key] = _Hits(key)
        hits = _LOOKUPS[key]
        return [[sorted({i for got in map(hits.__getitem__, word_set(t)) if got for i in got}) for t in texts]]

    return add_columns(docs, StructType([StructField("hits", ArrayType(IntegerType(), False), False)]), "text", run)


class Posterior:
    """P(toxic | fired voters) under rates, groups and correlations of the voters."""

    def __init__(self, prior: float, group: list[int], corr: list[float], high: list[float], low: list[float]):
        self.b0, self.group, self.corr = math.log(prior / (1 - prior)), group, corr
        clip = lambda x: min(max(x, 1e-6), 1 - 1e-6)
        self.fire = [math.log(clip(h) / clip(lo)) for h, lo in zip(high, low)]
        self.silent = [math.log((1 - clip(h)) / (1 - clip(lo))) for h, lo in zip(high, low)]
        self.all_silent: dict[int, tuple[float, int]] = {}
        for j, g in enumerate(group):
            s, k = self.all_silent.get(g, (0.0, 0))
            self.all_silent[g] = s + self.silent[j], k + 1

    def __call__(self, fired: list[int]) -> float:
        z, by_group = self.b0, {}
        for j in fired:
            f, s, k = by_group.get(self.group[j], (0.0, 0.0, 0))
            by_group[self.group[j]] = f + self.fire[j], s + self.silent[j], k + 1
        for g, (silent, k) in self.all_silent.items():
            f, s, m = by_group.get(g, (0.0, 0.0, 0))
            r = self.corr[g]
            z += f / (1 + max(m - 1, 0) * r) + (silent - s) / (1 + max(k - m - 1, 0) * r)
        return 1 / (1 + math.exp(-min(max(z, -50), 50)))


def label_model(hits: DataFrame, rates: list[tuple[float, float]], prior: float) -> Posterior:
    """The label model of the voters (the first terms), estimated from the votes of all documents."""
    import pyarrow as pa

    n = len(rates)
    fired = F.filter("hits", lambda j: j < n)
    votes = materialize(hits.select(fired.alias("fired")).groupBy("fired").agg(F.count("*").alias("n")), "votes")
    both = votes.select("n", "fired", F.explode("fired").alias("a")).select("n", "a", F.explode("fired").alias("b"))
    pairs = {(r["a"], r["b"]): r["n"] for r in both.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}   # at most VOTERS^2 rows
    total = votes.agg(F.sum("n")).first()[0] or 0
    group, corr = correlations(n, pairs, total)

    sample_toxic, sample_clean = total * prior, total * (1 - prior)
    high, low = [h for h, _ in rates], [lo for _, lo in rates]   # rate of a vote among toxic documents, and among others
    model = Posterior(prior, group, corr, high, low)
    for _ in range(ROUNDS if n else 0):

        def expect(batches: Iterator[pa.RecordBatch], model: Posterior = model) -> Iterator[pa.RecordBatch]:
            sums: dict[int, float] = {-1: 0.0}
            for b in batches:
                for js, k in zip(b.column("fired").to_pylist(), b.column("n").to_pylist()):
                    p = model(js) * k
                    for j in (-1, *js):
                        sums[j] = sums.get(j, 0.0) + p
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.float64())], names=["j", "p"])

        per = {r["j"]: r["p"] for r in votes.mapInArrow(expect, "j int, p double").groupBy("j").agg(F.sum("p").alias("p")).collect()}
        toxic = per.get(-1, 0.0)
        high = [(per.get(j, 0.0) + sample_toxic * rates[j][0] + 0.5) / (toxic + sample_toxic + 1) for j in range(n)]
        low = [(pairs.get((j, j), 0) - per.get(j, 0.0) + sample_clean * rates[j][1] + 0.05) / (total - toxic + sample_clean + 1) for j in range(n)]
        model = Posterior(prior, group, corr, high, low)
    return model


def correlations(n: int, pairs: dict[tuple[int, int], int], total: int) -> tuple[list[int], list[float]]:
    """Group of every voter, and by group number the mean correlation of its voters."""
    import numpy as np
    if not n or total < 2:
        return list(range(n)), [0.0] * n
    m = np.zeros((n, n))
    for (a, b), c in pairs.items():
        m[a, b] = c / total
    p = m.diagonal()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = (m - np.outer(p, p)) / np.outer(sd, sd)
    group = np.arange(n)
    for a in range(n):
        for b in range(a):
            if corr[a, b] >= GROUPED_FROM:
                group[group == group[a]] = group[b]
    mean = [0.0] * n
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        if len(at) > 1:
            inner = corr[np.ix_(at, at)]
            mean[g] = max(float((inner.sum() - len(at)) / (len(at) * (len(at) - 1))), 0.0)
    return group.tolist(), mean


def fit_linear(rows: list[tuple[list[int], float]], n: int, prior: float) -> tuple[list[float], float]:
    """Logistic regression on term presence against soft labels (Newton steps on at most ``TERMS`` weights)."""
    import numpy as np
    start = math.log(prior / (1 - prior))
    if not rows or not n:
        return [0.0] * n, start
    x = np.zeros((len(rows), n + 1), np.float32)
    x[:, n] = 1
    for i, (hits, _) in enumerate(rows):
        x[i, hits] = 1
    y = np.array([p for _, p in rows])
    w = np.zeros(n + 1)
    w[n] = start
    penalty = np.full(n + 1, 1.0)
    penalty[n] = 1e-3

    def loss(w) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * (penalty * w * w).sum())

    now = loss(w)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(hess.astype(np.float64), grad), 1.0
        while size > 1e-4 and loss(w - size * step) > now:     # convex: shorter steps until the loss falls
            size /= 2
        if size <= 1e-4:
            break
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-6 * abs(now):
            break
    return w[:n].tolist(), float(w[n])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text)."""
    found, prior = find_terms(docs, labels)
    terms = [t for t, _, _ in found]
    hits = materialize(with_hits(docs.select("doc_id", null_free(F.col("text")).alias("text")), terms).drop("text"), "term-hits")
    n = min(VOTERS, len(terms))
    posterior = label_model(hits, [(h, lo) for _, h, lo in found[:n]], prior)
    sample = bounded(hits.where(~held_out(F.col("doc_id"))), TRAINING_ROWS)
    rows = [(list(r["hits"]), posterior([j for j in r["hits"] if j < n])) for r in sample.select("hits").collect()]
    linear, bias = fit_linear(rows, len(terms), prior)
    v = F.array(*[F.lit(float(x)) for x in linear]) if terms else F.array().cast("array<double>")
    z = F.lit(bias) + F.aggregate("hits", F.lit(0.0), lambda a, j: a + F.get(v, j))
    return hits.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    out = score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
