"""Operator 12 against a plain model over dictionaries, and the Elias-Fano sequences against numpy."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import ngram_lm as lm
from offerlens.llm.elias_fano import EliasFano, Siblings, pack, unpack


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 3), (1000, 100), (1000, 10 ** 9), (700, 2 ** 50), (3000, 3000)])
def test_sequences(n, top):
    rng = np.random.default_rng(n)
    x = np.sort(rng.integers(0, top, n))
    e = EliasFano.build(x)
    assert (e.at(np.arange(n)) == x).all()
    asked = np.r_[rng.integers(0, top + 50, 500), x, x + 1]
    assert (e.successor(asked) == np.searchsorted(x, asked)).all()
    for width in (0, 1, 7, 33, 51):
        kept = x & ((1 << width) - 1)
        assert (unpack(pack(kept, width), width, np.arange(n)) == kept).all()


def test_siblings():
    rng = np.random.default_rng(5)
    groups = [np.unique(rng.integers(0, 50, rng.integers(0, 9))) for _ in range(200)]
    starts = np.r_[0, np.cumsum([len(g) for g in groups])]
    made = Siblings.build(starts, np.concatenate(groups))
    parent, child = np.repeat(np.arange(-1, 200), 50), np.tile(np.arange(50), 201)
    want = [int(starts[p] + np.searchsorted(groups[p], c)) if p >= 0 and c in groups[p] else -1 for p, c in zip(parent, child)]
    assert made.find(parent, child).tolist() == want


def brute(rows, held_out):
    def floor(p):
        return 2 ** (-math.ceil(-math.log2(p) * 64 - 1e-9) / 64)

    def tokens(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [0]
    train = [tokens(t) for i, t in rows if not held_out(i)]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip([1] + t, t))
    three = collections.Counter(p for t in train for p in zip([1] + t, t, t[1:]))
    n2, t2, n3, t3 = (collections.Counter() for _ in range(4))
    for (v, w), n in two.items():
        n2[v] += n
        t2[v] += 1
    for (u, v, w), n in three.items():
        n3[u, v] += n
        t3[u, v] += 1
    total, kinds = sum(one.values()), len(one)
    out = []
    for i, text in rows:
        t = tokens(text)
        base = score = 0.0
        for k, w in enumerate(t):
            p1 = p = (one[w] + 0.1) / (total + 0.1 * (kinds + 1))
            v = t[k - 1] if k else 1
            if n2[v]:
                p = (floor((two[v, w] - 0.75) / n2[v]) if two[v, w] else 0) + floor(0.75 * t2[v] / n2[v]) * p
            u = (t[k - 2] if k > 1 else 1) if k else None
            if k and n3[u, v]:
                p = (floor((three[u, v, w] - 0.75) / n3[u, v]) if three[u, v, w] else 0) + floor(0.75 * t3[u, v] / n3[u, v]) * p
            base, score = base + math.log10(p1), score + math.log10(p)
        out.append((i, held_out(i), len(t), sum(one[w] > 0 for w in t), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 0


def scored(frame):
    got = lm.score_documents(frame, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in got.collect()], key=str)


@pytest.mark.parametrize("chunk,shard,hot", [(1_000_000, 2_000_000, 1000), (4, 40, 8), (2, 100, 1000)])
def test_against_plain_model(spark, rng, monkeypatch, chunk, shard, hot):
    for name, value in (("CHUNK", chunk), ("SHARD", shard), ("HOT", hot), ("BUCKET", shard)):
        monkeypatch.setattr(lm, name, value)
    words = ["the", "The", "a", "b", "é", "漢字", "x\x00", "\x1c", "c.", "d"]
    rows = [(i, " ".join(rng.choice(words[:3] * 3 + words) for _ in range(rng.randint(0, 30)))) for i in range(50)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (None, "no id"), (None, "no id"), (1, "repeated id"), (103, "the\x0bthe\x0cthe\rnew" * 9), (104, "only unknown wörds " * 5)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    assert scored(frame) == brute(rows, held)


def test_nothing_to_learn(spark, empty_docs):
    assert scored(empty_docs) == []
    alone = next(i for i in range(9) if held(i))
    frame = spark.createDataFrame([(alone, "a b")], "doc_id long, text string")
    assert scored(frame) == [(alone, True, 3, 0, 0, 0.0, 0.0)]


def test_registered_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in lm.op12_lm_score(spark, sf).collect()], key=str)
    want = brute(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a - b) < 1e-4 for x, y in zip(got, want) for a, b in zip(x[5:], y[5:]))


def test_probabilities_sum_to_at_most_one():
    u, v, w = (np.array(x) for x in zip(*sorted({(a, b, c) for a in (4, 5) for b in (4, 5, 6) for c in (4, 6, 7)})))
    trie, _ = lm.build_trie(u, v, w, np.arange(1, len(u) + 1), {}, 0.75)
    word, pair, triple = trie.find(np.full(10, 4), np.full(10, 5), np.arange(10))
    a3 = np.where(triple >= 0, lm.value_of(trie.code("a3", np.maximum(triple, 0)), 0.0), 0.0)
    assert 0.97 < a3.sum() + lm.value_of(trie.code("g3", pair[:1]), 1.0)[0] <= 1
