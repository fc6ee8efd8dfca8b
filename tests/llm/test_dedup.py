"""Operators 2, 7 and 9 against brute force."""

import bisect
import collections
import hashlib
import math
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from offerlens.llm import embedding_dedup, simhash, suffix_array, suffix_dedup
from offerlens.llm.common import Scratch
from offerlens.llm.components import components
from offerlens.llm.suffix_array import suffix_ranks


def reach(n, links):
    """Smallest index reachable."""
    at = list(range(n))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, j in links:
        a, b = root(i), root(j)
        at[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(spark, rng):
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)] + [(100 + i, 101 + i) for i in range(25)] + [(300, 301 + i) for i in range(20)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = reach(400, links)
    assert got == {i: want[i] for i in {x for p in links if p[0] != p[1] for x in p}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text, w=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + w]) for i in range(len(words) - w + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def hamming_links(f, radius):
    f = np.array(f, np.uint64)
    return [(i, int(j) + i + 1) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= radius)]


def test_simhash_of_documents(spark, sf, edge_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        edge_docs.where("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text")).withColumn("fp", F.lit("clash"))
    rows = simhash.simhash_groups(docs).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    f = [brute_fingerprint(r.text) for r in texts]
    ids = [r.doc_id for r in texts]
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    at = reach(len(ids), hamming_links([f[i] for i in order], 3))
    want = {ids[i]: (f[i], ids[order[at[k]]]) for k, i in enumerate(order)}
    assert {r.id: (r.fp % 2 ** 64, r.component_id) for r in rows} == want


def test_simhash_edges(spark, edge_docs, empty_docs):
    rows = simhash.simhash_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    blank = [r for r in rows if r.fp == 0]
    assert len(blank) == 4 and {r.component_id for r in blank} == {1}
    assert simhash.simhash_groups(empty_docs).count() == 0
    kept = simhash.stage_near_duplicates(spark, edge_docs, "").collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "4", "5", "None", "7", "8", "9"])


def test_simhash_hot_buckets(spark):
    rng = np.random.default_rng(0)
    f = set()
    for base in rng.integers(0, 2 ** 63, 2, dtype=np.uint64):
        for _ in range(150):
            x = int(base)
            for q in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(q)
            f.add(x)
    f = np.array(sorted(f), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    for radius in (0, 3, 5):
        got = {r.fp: r.component for r in simhash.groups(df, radius, 32).collect()}
        at = reach(len(f), hamming_links(f, radius))
        mine, theirs = collections.defaultdict(set), collections.defaultdict(set)
        for x, a in zip(f.view(np.int64).tolist(), at):
            mine[got[x]].add(x)
            theirs[a].add(x)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def brute_vectors(rows, cosine):
    n = len(rows)
    good = [lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links = []
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                    links.append((j, i))
    count = collections.Counter(x for p in links for x in p)
    at = reach(n, links)
    groups = collections.defaultdict(list)
    for i, a in enumerate(at):
        if rows[i][0] is not None:
            groups[a].append(rows[i][0])
    return [(rows[i][0], count[i], min(groups[at[i]], default=None)) for i in range(n)]


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        base = rng.standard_normal(20) if i % 5 == 0 else base  # noqa: F821
        v = base + rng.standard_normal(20) * rng.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((int(rng.integers(0, 10_000)), np.float32(v).tolist(), int(i % 2)))
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 20, 0), (4, [float("nan")] * 20, 0), (5, [float("inf")] + [1.0] * 19, 0), (6, [None] + [1.0] * 19, 0),
             (7, [1.0] * 20, None), (8, [1.0] * 20, None), (9, [1.0] * 3, 0), (10, [2.0] * 3, 0), (11, [2.0] * 3, 0), (11, [2.0] * 3, 0), (None, [2.0] * 3, 0),
             (12, [1e30] * 20, 1), (13, [1e-30] * 20, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    want = sorted(brute_vectors(rows, 0.93), key=key)
    for tile in (4096, 16):
        got = embedding_dedup.near_duplicates(df, tile=tile).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_tiles_of_vectors_equal_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    x = np.float32(base[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 16)) * rng.choice([0.05, 0.3, 0.8], 3000)[:, None])
    u = embedding_dedup.unit_rows(x)
    m = rng.integers(1, 4, 3000)
    for left in (0, 1300):
        links = np.einsum("ik,jk->ij", u, u) >= 0.93
        np.fill_diagonal(links, False)
        if left:
            links[:left, :left] = links[left:, left:] = False
        got, root = embedding_dedup.tile_links(x, m, left, 0.93)
        assert got.tolist() == (links * m[None, :]).sum(axis=1).tolist()
        at = reach(3000, zip(*np.nonzero(np.triu(links))))
        assert len(set(zip(root.tolist(), at))) == len(set(at)) == len(set(root.tolist()))


def test_vectors_are_copied_seldom(spark, monkeypatch):
    """A vector goes into one tile where its label fits one, else into one per chunk of its label, and in rounds."""
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, rng.standard_normal(8).tolist(), 1, 8) for i in range(6000)]
    classes = spark.createDataFrame(rows, "cid long, label int, vec array<double>, m long, d int")
    copies, run = [], type(classes).mapInArrow
    monkeypatch.setattr(type(classes), "mapInArrow", lambda self, *a, **k: copies.append(self.count()) or run(self, *a, **k))
    whole = embedding_dedup.link_tiles(classes).where("n is not null").groupBy("a").agg(F.sum("n")).collect()
    assert sum(copies) <= 2 * 6000
    copies.clear()
    cut = embedding_dedup.link_tiles(classes, tile=2000).where("n is not null").groupBy("a").agg(F.sum("n")).collect()
    assert sorted(whole) == sorted(cut) and len(whole) > 1000
    assert sum(copies) == 3 * 6000 and max(copies) <= 2 * embedding_dedup.ROUND * 6000


@pytest.mark.parametrize("local", [0, 40, 10 ** 6])
def test_suffix_ranks(spark, rng, monkeypatch, local):
    monkeypatch.setattr(suffix_array, "LOCAL", local)
    strings = [[rng.randint(1, 2) for _ in range(rng.randint(1, 14))] for _ in range(30)] + [[1] * 9, [1] * 10]
    df = spark.createDataFrame([(i, x, [1] * len(x)) for i, x in enumerate(strings)], "rid long, syms array<long>, lens array<long>")
    got = {r.rid: r.ranks for r in suffix_ranks(Scratch(spark, "ranks"), df, 1000).collect()}
    suffixes = sorted(x[k:] for x in strings for k in range(len(x)))
    assert all(got[i][k] == bisect.bisect_left(suffixes, x[k:]) for i, x in enumerate(strings) for k in range(len(x)))


def covered(texts, length):
    seen = collections.defaultdict(list)
    for i, b in enumerate(texts):
        for k in range(len(b) - length + 1):
            seen[b[k:k + length]].append((i, k))
    out = [bytearray(len(b)) for b in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                out[i][k:k + length] = b"\1" * length
    return out


@pytest.mark.parametrize("length,local", [(400, suffix_array.LOCAL), (suffix_dedup.STAGE_LENGTH, 0)])
def test_suffix_dedup(spark, rng, empty_docs, monkeypatch, length, local):
    monkeypatch.setattr(suffix_array, "LOCAL", local)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(n))

    passages = [words(120) for _ in range(3)]
    rows = []
    for i in range(30):
        t = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p, a = rng.choice(passages), rng.randint(0, 200)
            t += " " + p[a:a + rng.randint(200, 800)] + " " + words(rng.randint(0, 30))
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "a" * 1500), (103, "ab" * 700), (104, rows[3][1]), (104, rows[3][1]), (105, words(150)), (106, "x" * 399), (107, "x" * 400),
             (108, "x" * 399), (None, passages[0])]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = {r.n: r for r in suffix_dedup.remove_repeats(df, length=length).collect()}
    texts = [(t or "").encode() for _, t in rows]
    for n, (b, c) in enumerate(zip(texts, covered(texts, length))):
        spans = sum(1 for k in range(len(c)) if c[k] and (k == 0 or not c[k - 1]))
        kept = bytes(x for x, y in zip(b, c) if not y)
        r = got[n]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(b), sum(c), spans, kept)
    assert suffix_dedup.remove_repeats(empty_docs).count() == 0


def test_suffix_heads_keep_the_order(rng):
    """Bytes of a head sort as its symbols do, equal ones in a row too; what is cut is marked."""
    import numpy as np
    strings = [[rng.choice([1, 2, 2 ** 63, 2 ** 64 - 1]) for _ in range(rng.randint(1, 9))] for _ in range(60)] + [[2] * 9, [1] * 8 + [2], []]
    syms = np.array([x for s in strings for x in s], np.uint64)
    suffixes = [s[k:k + 5] for s in strings for k in range(len(s))]          # what counts ends after 5 symbols or with the string
    until = np.arange(len(syms)) + np.array([len(x) for x in suffixes])
    got, deep = suffix_dedup.heads(syms, until, 5)
    pairs = sorted(zip(got.to_pylist(), suffixes))
    assert not deep.any() and [x for _, x in pairs] == sorted(suffixes)
    assert all((a == b) == (x == y) for (a, x), (b, y) in zip(pairs, pairs[1:]))
    cut, deep = suffix_dedup.heads(syms, until, 2)
    assert deep.tolist() == [1 + sum(a != b for a, b in zip(x, x[1:])) > 2 for x in suffixes]
    assert all(len(x) <= 24 for x in cut.to_pylist())
    assert len(suffix_dedup.heads(syms[:0], until[:0], 2)[0]) == 0


@pytest.mark.parametrize("head", [suffix_dedup.HEAD, 1])
def test_suffix_dedup_sorts_by_heads(spark, rng, monkeypatch, head):
    """Ordinary and periodic texts need no round of the difference cover; with heads of one phrase it gives the same."""
    monkeypatch.setattr(suffix_array, "LOCAL", 0)
    monkeypatch.setattr(suffix_dedup, "HEAD", head)
    sizes = []

    def ranks(scratch, strings, depth):
        sizes.append(strings.count())
        return suffix_ranks(scratch, strings, depth)

    monkeypatch.setattr(suffix_dedup, "suffix_ranks", ranks)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(4, 9))) for _ in range(n))

    passages = [words(120) for _ in range(2)]
    texts = [words(30) + passages[i % 2][i * 7:600] + words(20) for i in range(6)] + [words(40), "La " * 300 + words(30), words(9) + "La " * 250, "x" * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df).collect()}
    raw = [t.encode() for t in texts]
    assert got == {i: bytes(x for x, y in zip(b, c) if not y) for i, (b, c) in enumerate(zip(raw, covered(raw, 400)))}
    assert sizes == [0] if head > 1 else sizes[0] > 0


def test_suffix_stage(spark, edge_docs):
    out = suffix_dedup.stage_suffix_dedup(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {1, 2, 3, 5, 6, 7, 8, 9, None} | ({4} if 4 in rows else set())
    assert rows[8].text == "naïve café 漢字 😀 \x00 tab\tend" and rows[1].text is None


def test_query_digest_is_of_the_remaining_bytes(spark, sf):
    rows = suffix_dedup.op7_suffix_dedup(spark, sf).collect()
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    cover = covered([docs[i] for i in ids], 400)
    want = {i: hashlib.sha256(bytes(x for x, y in zip(docs[i], c) if not y)).hexdigest() for i, c in zip(ids, cover)}
    assert {r.doc_id: r.kept_sha256 for r in rows} == want


def test_suffix_counts_need_no_driver_table_and_no_sort_aggregate(spark):
    """Offsets of sorted partitions are constants of the plan, and a run's stretches are counted by a hash aggregate."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    scratch = Scratch(spark, "plans")
    rows = spark.createDataFrame([(i, 0, i % 2, 1, i % 5) for i in range(50)], "rid long, k int, kind int, len long, a long")
    got = suffix_array._smaller(scratch, rows, ["a"])
    assert "Join" not in plan(got)
    assert {(r.rid, r.n0, r.n1, r.same) for r in got.collect()} == {(i, i % 5 * 5, i % 5 * 5, 10) for i in range(50)}
    assert suffix_array._smaller(scratch, rows.where("rid < 0"), ["a"]).count() == 0
    found = spark.createDataFrame([(b"p", 0, 3, b"s", i, 2 * i, 2 * i + 3) for i in range(1, 9)] + [(b"p", 0, 3, b"t", 9, 18, 21)],
                                  "prefix binary, off int, more int, stretch binary, rid long, first int, last int")
    seen = []
    kinds = suffix_dedup._kinds(SimpleNamespace(keep=lambda df: seen.append(df) or df), found)
    assert "SortAggregate" not in plan(seen[0])
    out = {bytes(r.stretch): r for r in kinds.collect()}
    assert [out[s].n for s in (b"s", b"t")] == [8, 1]
    assert all(r.first == 2 * r.rid and r.last == 2 * r.rid + 3 for r in out.values())      # one row's own columns
