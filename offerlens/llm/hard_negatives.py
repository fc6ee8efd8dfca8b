"""Hard-negative mining by Strassen products of integer tiles (operator 13).

Anchors (a stated query set) meet all rows in tiles: anchors are dealt to
``ANCHORS``-sized groups, all rows to ``CANDIDATES``-sized ones, and every
pair of groups is one tile.  A tile's scores are one matrix product over int64,
computed by Strassen's recursion: odd sides are padded with zeros, seven
products of halves are added and subtracted, and small halves are multiplied
directly.  Additions of integers are exact, so the scores are, too (modulo 2^64
in between; the scores themselves must fit, see below).

Two rounds over the tiles: the first keeps a heap of the best rows of the same
label per anchor, the second a heap per (anchor, positive) of the best rows of
another label whose score lies in the positive's window.  Heaps of one anchor
merge: inside a task from tile to tile, then between tasks by a ranked window
over at most ``k`` rows per task and anchor.

Defined results: rows with a null label, a null vector or any null or
non-finite component take no part; missing components of shorter vectors count
as zero, an empty vector scores zero with everything; a row is never its own
positive or negative, repeated rows are rows of their own; rows with a null id are no anchors and
stand behind equal scores with an id; scores times 100 beyond 64 bits raise an
error; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import table

POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows on either side of a tile (a tile has about so many).
ANCHORS, CANDIDATES = 1024, 1024
#: Sides of at most this length are multiplied directly.
LEAF = 16


def strassen(a, b, leaf: int = LEAF):
    """``a @ b.T`` of two int64 matrices (rows x components)."""
    import numpy as np

    (m, d), n = a.shape, len(b)
    if min(m, n, d) <= leaf:
        return a @ b.T
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, n % 2), (0, d % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, k, j = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]     # b is held transposed
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out


def matrix(lists):
    """An Arrow list column of integers as a matrix, shorter rows padded with zeros."""
    import numpy as np
    size = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = values
    return out


def best(scores, allowed, k: int):
    """(row, column, score) of the first ``k`` allowed columns of each row, higher scores and then lower columns first."""
    import numpy as np
    least = np.iinfo(np.int64).min
    left = np.where(allowed, scores, least)
    at = np.arange(len(left))
    rows, cols = [], []
    for _ in range(min(k, left.shape[1])):
        top = left.argmax(axis=1)
        good = allowed[at, top] & (left[at, top] != least)
        if not good.any():
            break
        rows.append(at[good])
        cols.append(top[good])
        left[at[good], top[good]] = least
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    return rows, cols, scores[rows, cols]


def keep_best(heaps: list, k: int):
    """Merged heaps (anchor, place, order, score, other, no id): the first ``k`` of each (anchor, place)."""
    import numpy as np
    anchor, place, other, score, void = (np.concatenate(x) for x in zip(*heaps))
    order = np.lexsort((other, void, -score, place, anchor))
    anchor, place = anchor[order], place[order]
    first = np.r_[True, (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1])] if len(order) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    order = order[rank < k]
    heap = tuple(np.concatenate(x)[order] for x in zip(*heaps))
    return heap


def valid(vectors: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(rid, vec_id, label, vec): the rows that take part, with integer components; a written table."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), F.col(f"`{vec_col}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x.cast("double") * scale)))
    return materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "vectors")


def heaps(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, k: int, windows: bool) -> DataFrame:
    """(anchor, place, other, score): heaps of ``k`` rows per anchor and place, merged inside each task.

    ``anchors``: rid, label, vec and, with ``windows``, wanted (the positives' scores): then a place is one of the
    positives and rows of another label inside its window count, else the only place has the rows of the same label."""
    import pyarrow as pa

    across, down = -(-n_anchors // ANCHORS) or 1, -(-n_rows // CANDIDATES) or 1
    wanted = F.col("wanted") if windows else F.lit(None).cast("array<long>")
    own = anchors.select(F.lit(0).alias("side"), "rid", F.lit(None).cast("long").alias("vec_id"), "label", "vec", wanted.alias("wanted"),
                         F.pmod(F.xxhash64("rid"), F.lit(across)).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("b"))
    all_ = rows.select(F.lit(1).alias("side"), "rid", "vec_id", "label", "vec", F.lit(None).cast("array<long>").alias("wanted"),
                       F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("a"), F.pmod(F.xxhash64("rid"), F.lit(down)).cast("int").alias("b"))
    tiles = own.unionByName(all_).repartition("a", "b").sortWithinPartitions("a", "b", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        top = np.iinfo(np.int64).max

        def tile(t: pa.Table):
            t = t.combine_chunks()
            col = {c: t.column(c).chunk(0) for c in t.column_names}
            rid, n = col["rid"].to_numpy(), int((col["side"].to_numpy() == 0).sum())
            void = col["vec_id"].is_null().to_numpy(zero_copy_only=False)
            vec_id = col["vec_id"].fill_null(top).to_numpy()
            label = col["label"].dictionary_encode().indices.to_numpy()
            x = matrix(col["vec"])
            order = n + np.lexsort((rid[n:], vec_id[n:], void[n:]))
            big = int(max(x.max(initial=0), -x.min(initial=0)))
            if big * big * max(1, x.shape[1]) * 100 >= 2 ** 63:
                raise ValueError("components are too large for scores of 64 bits")
            scores = strassen(x[:n], np.ascontiguousarray(x[order]))
            same = label[:n, None] == label[order][None, :]
            found = []
            if windows:
                size = np.diff(col["wanted"].slice(0, n).offsets.to_numpy())
                goal = matrix(col["wanted"].slice(0, n))
                for place in range(goal.shape[1]):
                    p = goal[:, place, None]
                    inside = ~same & (100 * scores >= LOW * p) & (100 * scores <= HIGH * p) & (size > place)[:, None]
                    found.append((place, *best(scores, inside, k)))
            else:
                found.append((0, *best(scores, same & (rid[:n, None] != rid[order][None, :]), k)))
            return [(rid[r], np.full(len(r), place), vec_id[order[c]], s, void[order[c]]) for place, r, c, s in found]

        def batch(heap) -> pa.RecordBatch:
            anchor, place, other, score, void = heap
            return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(place.astype(np.int32)), pa.array(other, mask=void), pa.array(score)],
                                              names=["anchor", "place", "other", "score"])

        held: list[pa.RecordBatch] = []
        heap: list = []
        last = None

        def close():
            if held[0].column("side")[0].as_py() == 0 and held[-1].column("side")[-1].as_py() == 1:
                heap.extend(tile(pa.Table.from_batches(held)))
                heap[:] = [keep_best(heap, k)] if heap else []

        for whole in batches:
            a, b = whole.column("a").to_numpy(), whole.column("b").to_numpy()
            cuts = np.r_[0, 1 + np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)), len(a)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                now = (int(a[s]), int(b[s]))
                if held and now != last:
                    close()
                    held = []
                    if heap and now[0] != last[0]:
                        yield batch(heap[0])
                        heap = []
                held.append(whole.slice(s, e - s))
                last = now
        if held:
            close()
        if heap:
            yield batch(heap[0])

    return tiles.mapInArrow(run, "anchor long, place int, other long, score long")


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows of ``valid`` that ``anchor`` names."""
    n_rows, n_anchors = rows.agg(F.count("*"), F.count(F.when(anchor, 1))).first()
    anchors = rows.where(anchor)
    order = (F.col("score").desc(), F.col("other").asc_nulls_last())
    ranked = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    found = heaps(anchors, rows, n_anchors, n_rows, positives, False).withColumn("rank", ranked).where(F.col("rank") <= positives)
    one = F.struct("rank", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    near = materialize(found.groupBy("anchor").agg(F.sort_array(F.collect_list(one)).alias("near")), "positives")
    near = near.withColumnRenamed("anchor", "rid")
    asking = anchors.join(near, "rid").select("rid", "label", "vec", F.col("near.positive_score").alias("wanted"))
    ranked = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*order))
    hard = heaps(asking, rows, n_anchors, n_rows, negatives, True).withColumn("rank", ranked).where(F.col("rank") <= negatives)
    named = anchors.select("rid", F.col("vec_id").alias("anchor_id")).join(near, "rid").withColumnRenamed("rid", "anchor")
    out = hard.join(named, "anchor").withColumn("p", F.col("near")[F.col("place")])
    return out.select("anchor_id", "p.positive_id", "rank", F.col("other").alias("negative_id"), "p.positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 50, against all vectors."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(valid(table(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w AS rank, s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= 3
"""
