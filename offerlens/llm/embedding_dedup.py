"""Embedding near-duplicates by an exact cosine join in tiles (operator 2).

Vectors of one label and length are a group.  A group beyond a tile's size is
cut into chunks by a hash, every pair of chunks a tile; the size is one of
bytes, so that a vector is copied as seldom as memory allows.  Tiles are dealt
out in rounds by their first chunk: a round's copies are at most
``2 * ROUND`` times the vectors, and its shuffle files go before the next one.

Inside a tile vectors lie in the order of their nearest pivots, in blocks with
a centre and an angle around it.  Angles obey the triangle inequality: two
blocks whose centres are further apart than their angles and the link's allow
are skipped.  The others are multiplied in single precision; a product within
the error of such a sum of the threshold is decided in double precision.  A
tile hands on link counts per vector and a spanning forest of its links, never
the pairs.

Vectors that are equal, with equal labels, are one class with a multiplicity;
a row finds its class by the label and 128 bits of hashes of its vector.

Defined results: a null label, a null or empty vector, zero vectors and
vectors with null or non-finite components link with nothing and are kept;
vectors of different length do not link; repeated rows are vectors of their
own that link with each other; a null id is never a component's id unless no
other is there; an empty table gives an empty table; other columns are not
carried.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import Scratch, table
from .components import components
from .simhash import forest

COSINE = 0.93
TILE = 65536
TILE_BYTES = 16 << 20    # of a tile's vectors in single precision
ROUND = 2                # chunks whose tiles are dealt out at once
BLOCK = 1024             # vectors of a tile that are compared with as many others at once
SLACK = 1e-3             # rounding of the blocks' angles


def unit_rows(x):
    """Unit vectors of the rows of a matrix, in double precision."""
    import numpy as np
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)         # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(batch, name: str):
    """An Arrow list column whose lists have equal length, as a matrix."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def near_order(u):
    """The rows of ``u`` by their nearest pivots (rows at even distances), so that a block's rows lie close together."""
    import numpy as np
    pivots = u[:: max(1, len(u) // max(1, len(u) // BLOCK))]
    nearest = np.concatenate([(u[s:s + 8192] @ pivots.T).argmax(axis=1) for s in range(0, len(u), 8192)])
    return np.argsort(nearest, kind="stable")


def caps(u):
    """(start, end, centre, angle) of the blocks of the rows of ``u``."""
    import numpy as np
    out = []
    for s in range(0, len(u), BLOCK):
        rows = u[s:s + BLOCK]
        centre = rows.sum(axis=0, dtype=np.float64)
        size = np.sqrt(centre @ centre)
        centre = centre / size if size > 1e-6 else rows[0].astype(np.float64)
        out.append((s, s + len(rows), centre, np.arccos(np.clip((rows @ centre).min(), -1, 1))))
    return out


def tile_links(x, m, left: int, cosine: float):
    """(links, root) of the vectors in the rows of ``x`` (multiplicities ``m``): how many vectors each is linked with and
    the smallest row reachable over those links.  Rows before ``left`` meet those from there on, or each other if it is 0."""
    import numpy as np
    n, d = x.shape
    u = np.concatenate([unit_rows(x[s:s + 8192]).astype(np.float32) for s in range(0, n, 8192)])
    cut = left or n
    order = np.concatenate([near_order(u[:cut]), cut + near_order(u[cut:])]) if cut < n else near_order(u)
    u = u[order]
    x, m = x[order], m[order].astype(np.float64)
    error = (d + 8) * 2.0 ** -22
    reach = np.arccos(cosine) if -1 <= cosine <= 1 else np.pi
    ours = caps(u[:cut])
    theirs = [(a + cut, b + cut, c, r) for a, b, c, r in caps(u[cut:])] if left else ours
    links, pairs = np.zeros(n), []
    for a, b, centre, angle in ours:
        for e, f, other, width in theirs:
            if e < a and not left or np.arccos(np.clip(centre @ other, -1, 1)) > angle + width + reach + SLACK:
                continue
            product = u[a:b] @ u[e:f].T
            near = product >= cosine - error
            if not left and e == a:
                near &= np.arange(e, f)[None, :] > np.arange(a, b)[:, None]         # a pair once
            if not near.any():
                continue
            p, q = np.nonzero(near & (product < cosine + error))
            for s in range(0, len(p), 1 << 16):
                i, j = p[s:s + (1 << 16)], q[s:s + (1 << 16)]
                near[i, j] = np.einsum("ij,ij->i", unit_rows(x[a + i]), unit_rows(x[e + j])) >= cosine
            p, q = np.nonzero(near)
            if not len(p):
                continue
            links[a:b] += np.bincount(p, m[e + q], b - a)
            links[e:f] += np.bincount(q, m[a + p], f - e)
            tied = forest(n, [(a + p, e + q)]) if len(p) > BLOCK else None           # many links: few of them are kept
            p, q = (a + p, e + q) if tied is None else ((k := np.flatnonzero(tied != np.arange(n))), tied[k])
            pairs.append((p, q))
    if pairs:
        pairs = [(np.concatenate([p for p, _ in pairs]), np.concatenate([q for _, q in pairs]))]
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return links.astype(np.int64)[back], order[forest(n, pairs)[back]]


def link_tiles(classes: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """(a, b, n): links a-b of a spanning forest (n null), and partial link counts n of a (b null).
    classes: cid, label, vec (valid vectors), m (multiplicity), d (dimensions), a written table."""
    import pyarrow as pa

    where = ["label", "d"]
    room = F.greatest(F.lit(2), F.least(F.lit(tile), F.lit(TILE_BYTES) / (4 * F.col("d"))).cast("int"))
    chunks = F.when(F.col("n") <= room, F.lit(1)).otherwise(F.ceil(F.col("n") / F.floor(room / 2)))
    sizes = materialize(classes.groupBy(*where).agg(F.count("*").alias("n")).select(*where, chunks.cast("int").alias("chunks")), "vector-chunks")
    most = sizes.agg(F.max("chunks")).first()[0] or 0
    keys = [*where, "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def run(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            x = np.concatenate([matrix(b, "vec") for b in held])
            cid, m, own = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in ("cid", "m", "own"))
            i, j = (held[0].column(k)[0].as_py() for k in ("i", "j"))
            held.clear()
            left = int(np.searchsorted(own, j)) if i != j else 0
            links, root = tile_links(x, m, left, cosine) if i == j or 0 < left < len(x) else (np.zeros(len(x), np.int64), np.arange(len(x)))
            tied, counted = np.flatnonzero(root != np.arange(len(cid))), np.flatnonzero(links)
            a = np.concatenate([cid[tied], cid[counted]])
            other = pa.array(np.concatenate([cid[root[tied]], cid[counted]]), mask=np.arange(len(a)) >= len(tied))
            n = pa.array(np.concatenate([tied, links[counted]]), mask=np.arange(len(a)) < len(tied))
            return pa.RecordBatch.from_arrays([pa.array(a), other, n], names=["a", "b", "n"])

        held: list[pa.RecordBatch] = []
        last = None
        for whole in batches:
            ids = list(zip(*[whole.column(k).to_pylist() for k in keys]))
            s = 0
            for e in range(1, len(ids) + 1):
                if e == len(ids) or ids[e] != ids[s]:
                    if held and ids[s] != last:
                        yield run(held)
                    held.append(whole.slice(s, e - s))
                    last, s = ids[s], e
        if held:
            yield run(held)

    scratch, found = Scratch(classes.sparkSession, "vector-links"), []
    placed = classes.select("cid", "m", "vec", *where).join(sizes, where).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    for first in range(0, max(most, 1), ROUND):
        others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.least(c, "own").between(first, first + ROUND - 1))
        pair = F.transform(others, lambda c: F.struct(F.least(c, "own").alias("i"), F.greatest(c, "own").alias("j")))
        tiled = placed.withColumn("tile", F.explode(pair)).select(*where, "tile.i", "tile.j", "own", "cid", "m", "vec")
        tiled = tiled.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "own")
        found.append(scratch.keep(tiled.mapInArrow(compare, "a long, b long, n long")))
        if first + ROUND < most:
            del tiled
            scratch.drop()
    return classes.sparkSession.read.schema(found[0].schema).parquet(*[f._scratch for f in found])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vec_col}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = rows.where("usable").groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("m"))
    hashes = [F.xxhash64(F.lit(k), "vec").alias(f"h{k}") for k in (1, 2)]       # equal for 0.0 and -0.0, as the groups' keys are
    classes = classes.select("*", F.monotonically_increasing_id().alias("cid"), F.size("vec").alias("d"), *hashes)
    classes = materialize(classes, "vector-classes")
    found = link_tiles(classes, cosine, tile)
    counts = found.where("n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
    groups = components(found.where("n is null").select("a", "b")).select(F.col("node").alias("cid"), "component")
    # vectors stay behind: from here on a class goes by its number and hashes
    named = classes.select("cid", "label", "h1", "h2", "first", "m").join(counts, "cid", "left").join(groups, "cid", "left")
    named = named.select("label", "h1", "h2", "first", "m", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cid").alias("component"))
    named = materialize(named, "vector-groups")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("label", "h1", "h2", (F.col("links") + F.col("m") - 1).alias("n_links"), "component_id")
    good = rows.where("usable").select("vec_id", "label", *hashes).join(named, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
