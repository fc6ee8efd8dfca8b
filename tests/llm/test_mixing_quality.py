"""Operators 4 and 5."""

import collections
import math
import re

from pyspark.sql import functions as F

from offerlens.llm import mixing, quality
from offerlens.session import materialize


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Reshare the excess until no source is above its limit."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest, all_w = total - sum(fixed.values()), sum(w[i] for i in free)
        over = [i for i in free if w[i] * rest / all_w >= cap * sizes[i]]
        if not over:
            return [fixed.get(i, w[i] * rest / all_w if free else 0.0) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}
        if len(fixed) == len(sizes):
            return [fixed[i] for i in range(len(sizes))]


def test_targets(spark, rng):
    for n in (1, 2, 3, 7, 20):
        sizes = [rng.choice([0, 1, 10, 100, 5000]) + rng.randint(0, 9) for _ in range(n)]
        rows = [(f"s{i:02d}" if i < n - 1 else None, s, 3) for i, s in enumerate(sizes)]
        got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long, n_docs long")).orderBy("sid").collect()
        assert [r.source for r in got] == [r[0] for r in rows]
        for r, want in zip(got, brute_targets(sizes)):
            assert math.isclose(r.target, want, rel_tol=1e-12, abs_tol=1e-9)


def test_mix(spark, rng):
    rows = [(i, f"s{min(i % 7, 3)}", rng.randint(0, 300)) for i in range(4000)] + [(None, None, 5), (None, None, 5), (9, "s1", 10), (9, "s1", 10)]
    docs = materialize(spark.createDataFrame(rows, "id long, source string, size long"), "mix-test")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.id is None, r.id or 0, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    taken, target, biggest = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert r.taken == r.copies * r.size and r.copies <= 3
        taken[r.source] += r.taken
        target[r.source] = r.target
        biggest[r.source] = max(biggest[r.source], r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(biggest[s] / 2, 1) if s else True


def greedy(docs, wanted):
    """Along the ranks what fits is taken; one of those left closes the gap where that is nearer."""
    got, gap, left = set(), wanted, []
    for k, (i, size) in enumerate(docs):
        if size <= gap:
            got.add(i)
            gap -= size
        else:
            left.append((size, k, i))
    near = min(((abs(gap - size), k, i) for size, k, i in left), default=(gap,))
    return got | {near[2]} if near[0] < gap else got


def test_long_document_is_passed_over(spark, rng):
    """A document larger than its source's wanted words, at every tenth of the ranks."""
    rows = []
    for s in range(10):
        ids = range(s * 1000, s * 1000 + 400)
        u = dict(spark.createDataFrame([(i,) for i in ids], "id long").select("id", mixing.uniform(F.col("id").cast("string"))).collect())
        long_one = sorted(ids, key=u.get)[s * 40]
        rows += [(i, f"s{s}", 80_000 if i == long_one else rng.choice([0, 50, 100, 150, 3000 if s % 2 else 100]), u[i]) for i in ids]
    rows.append((-1, "z", 2_000_000, 0.5))
    docs = materialize(spark.createDataFrame(rows, "id long, source string, size long, place double"), "mix-long")
    by = {}
    for r in mixing.mix(docs, weights=(1,) * 10 + (150,)).collect():
        by.setdefault(r.source, []).append(r)
    assert len(by) == 11
    for source, rs in by.items():
        per = rs[0].target / rs[0].source_size
        wanted = rs[0].target - math.floor(per) * rs[0].source_size
        want = greedy([(r.id, r.size) for r in sorted(rs, key=lambda r: (r.place, r.id))], wanted) if per % 1 else set()
        assert {r.id for r in rs if r.copies > math.floor(per)} == want
        assert source == "z" or abs(sum(r.taken for r in rs) - rs[0].target) <= 50 and 40_000 > wanted > 10_000


def test_mix_edges(spark, edge_docs, empty_docs):
    docs = edge_docs.withColumns({"size": F.lit(1), "target": F.lit("clash"), "copies": F.lit(0)})
    rows = materialize(mixing.sizes(docs), "mix-edge")
    assert mixing.mix(rows).count() == edge_docs.count()
    assert mixing.mix(materialize(mixing.sizes(empty_docs), "mix-empty")).count() == 0
    out = mixing.stage_mix(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    assert mixing.stage_mix(spark, empty_docs, "").count() == 0


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORDS.findall(text or "")
    seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark, edge_docs, rng):
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "é#", "😀"]) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 6))) for _ in range(150)]
    texts += [" ".join(["x"] * n) for n in (7, 8, 9, 16, 40)] + [None, "", "\n\n", "\x0b\x0c a \r b\x1c c"] + [r.text for r in edge_docs.collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("n_words", F.lit("clash"))
    got = {r.i: r for r in quality.base_counts(df).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in quality.BASE) == brute(t)


def test_judge(spark, edge_docs, empty_docs, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    both = docs.union(edge_docs.select(docs.columns)).withColumn("kept", F.lit("clash"))
    got = quality.judge(both).collect()
    assert len(got) == both.count()
    for r in got:
        n, *_, rep = brute(r.text)
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.base_failed and r.kept)
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")
    clean = quality.judge(docs).join(good, "doc_id").where("not base_failed").agg(F.avg(F.col("kept").cast("int")), F.count("*")).first()
    assert clean[0] == 1.0 and clean[1] > 20
    assert quality.judge(empty_docs).count() == 0
    assert quality.stage_quality(spark, edge_docs, "").columns == edge_docs.columns


def test_many_languages_join_without_broadcast(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    want = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)
    assert {r.doc_id: r.kept for r in quality.judge(docs).collect()} == want


def test_distance(spark):
    row = spark.range(1).select(
        quality.js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(5.0)), F.lit(1.0), F.lit(5.0)).alias("far"),
        quality.js_distance(F.array(F.lit(2.0), F.lit(4.0)), F.array(F.lit(1.0), F.lit(2.0)), F.lit(6.0), F.lit(3.0)).alias("same")).first()
    assert row.far == 1.0 and row.same == 0.0


def test_op4_query_takes_what_fits(spark, sf):
    """The registered query over a whole given table against the walk along the ranks."""
    u = mixing.uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("u")
    source = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", u)
    by = collections.defaultdict(list)
    for r in mixing.op4_mixing(spark, sf).join(source, "doc_id").collect():
        by[r.source].append(r)
    for rs in by.values():
        per = rs[0].target / rs[0].source_size if rs[0].source_size else 0.0
        wanted = rs[0].target - math.floor(per) * rs[0].source_size
        want = greedy([(r.doc_id, r.size) for r in sorted(rs, key=lambda r: (r.u, r.doc_id))], wanted) if per % 1 else set()
        assert {r.doc_id for r in rs if r.copies > math.floor(per)} == want
        assert all(r.taken == r.copies * r.size for r in rs)
