"""Operator 13 against brute force (its SQL is compared in test_pipeline)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import hard_negatives as hn


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (33, 64, 41), (70, 35, 129), (64, 64, 64), (100, 0, 20)])
def test_strassen(shape):
    m, d, n = shape
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2 ** 40, 2 ** 40, (m, d)), rng.integers(-2 ** 20, 2 ** 20, (n, d))
    for leaf in (1, 4, 16):
        assert (hn.strassen(a, b, leaf) == a @ b.T).all()


def brute(rows, is_anchor, positives=5, negatives=3):
    ok = [(i, r) for i, r in enumerate(rows) if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    q = {i: [math.floor(256 * x) for x in r[1]] for i, r in ok}
    out = []
    for i, a in ok:
        if not is_anchor(a[0]):
            continue
        other = sorted(((-sum(x * y for x, y in zip(q[i], q[j])), r[0] is None, r[0] or 0, r) for j, r in ok if j != i), key=lambda x: x[:3])
        for p in [x for x in other if x[3][2] == a[2]][:positives]:
            window = [x for x in other if x[3][2] != a[2] and 50 * -p[0] <= 100 * -x[0] <= 95 * -p[0]]
            out += [(a[0], p[3][0], k + 1, x[3][0], -p[0], -x[0]) for k, x in enumerate(window[:negatives])]
    return sorted(out, key=str)


def got(rows, frame, monkeypatch, size):
    monkeypatch.setattr(hn, "ANCHORS", size)
    monkeypatch.setattr(hn, "CANDIDATES", size)
    found = hn.hard_negatives(hn.valid(frame, F.col("label")), F.col("vec_id") % 5 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted([tuple(r) for r in found.collect()], key=str)


@pytest.mark.parametrize("size", [3, 1024])
def test_edge_rows(spark, rng, monkeypatch, size):
    rows = [(k, [rng.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(6)], rng.choice([0, 0, 0, 1, 2]), "x") for k in range(40)]
    rows += [(5, [0.5] * 6, 0, "x"), (5, [0.5] * 6, 0, "x"), (6, [0.5] * 6, 1, "x"), (6, [0.5] * 6, 1, "x")]       # repeated rows and ids
    rows += [(None, [0.5] * 6, 0, "x"), (None, [0.25] * 6, 1, None), (50, None, 0, "x"), (55, [0.5] * 6, None, "x"), (60, [], 0, "x"),
             (65, [0.5, None, 1.0], 0, "x"), (70, [float("nan")] * 6, 0, "x"), (75, [float("inf")] * 6, 1, "x"), (80, [0.5, 0.5], 0, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rid string")
    assert got(rows, frame, monkeypatch, size) == brute(rows, lambda i: i is not None and i % 5 == 0)


def test_empty_and_too_large(spark, monkeypatch):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert got([], frame, monkeypatch, 4) == []
    frame = spark.createDataFrame([(k, [1e15, 1.0], 0) for k in range(6)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        got([], frame, monkeypatch, 4)
