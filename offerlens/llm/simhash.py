"""SimHash near-duplicates by bit-sliced comparison (operator 9).

Fingerprints: A-Z lower-cased, words, shingles of w words joined by spaces
(repeats included; a shorter text is one shingle), XXH64 with seed 42; a bit
is 1 if it is set in over half of the hashes.

Candidates: fingerprints at most r bits apart agree in at least two of r + 2
blocks of bits.  Every distinct fingerprint is dealt to one bucket per pair of
blocks; a bucket beyond ``TILE`` members is cut into chunks and every pair of
chunks is a tile of its own, so no task holds more than a tile at once and no
pair is lost.

Comparison: the bits of a tile are stored as vertical planes, 64 fingerprints
to a word.  For many queries at once the planes are xor-ed with the query's
bit and added to carry-save counters that start at 2^k - 1 - r, so the
overflow says "more than r"; a block is abandoned once all of its pairs have
overflowed.  A tile hands on a spanning forest of its links, not the links.

Defined results: null, empty and blank texts have fingerprint 0 and link like
any other; equal texts share a fingerprint and so a group; null ids form
groups like others, their component is the smallest id that is not null, if
any; texts are hashed whole; an empty table gives an empty table; output
columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .common import add_columns, null_free, table, without
from .components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
BITS = 64
TILE = 4096          # fingerprints of a bucket that are compared at once
QUERIES = 512        # of them as queries at once

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, w: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import numpy as np
    from xxhash import xxh64_digest
    words = (text or "").encode().translate(_LOWER).split()   # bytes.split: ASCII white space
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(w)))) if len(words) >= w else [b" ".join(words)]
    raw = b"".join([xxh64_digest(s, SEED) for s in shingles])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", w: int = SHINGLE, out_col: str = "fp") -> DataFrame:
    fields = StructType([StructField(out_col, LongType(), False)])
    return add_columns(docs, fields, text_col, lambda texts: [[fingerprint(t, w) for t in texts]])


def planes(f):
    """[64][words] vertical bit planes of fingerprints, padded to whole words."""
    import numpy as np
    n = -(-len(f) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[:len(f)] = f
    bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1)).view(np.uint64)


def near_pairs(f, last, radius: int):
    """Index pairs (i, j), i < j < last[i], at most ``radius`` bits apart; ``last[i]`` ends i's bucket in the
    sorted batch.  Yields arrays block by block."""
    import numpy as np
    k = max(1, int(radius).bit_length())
    begin = 2 ** k - 1 - radius
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    shifts = np.arange(63, -1, -1, dtype=np.uint64)
    for s in range(0, len(f), QUERIES):
        e = min(s + QUERIES, len(f))
        stop = int(last[s:e].max())
        if stop <= s + 1:
            continue
        vertical = planes(f[s:stop])
        at = np.arange(vertical.shape[1] * 64)
        wanted = (at[None, :] > np.arange(e - s)[:, None]) & (at[None, :] < (last[s:e] - s)[:, None])
        over = ~np.packbits(wanted, axis=1).view(np.uint64)
        query = ((f[s:e, None] >> shifts[None, :]) & np.uint64(1)) * ones          # [q][64], most significant first
        counters = [np.full_like(over, ones if begin >> b & 1 else 0) for b in range(k)]
        for b in range(BITS):
            carry = vertical[b][None, :] ^ query[:, b][:, None]
            for c in counters:
                c ^= carry
                carry &= ~c          # the counter bit was 1 and is 0 now
            over |= carry
            if b % 8 == 7 and (over == ones).all():
                break
        else:
            near = np.unpackbits((~over).view(np.uint8), axis=1)
            i, j = np.nonzero(near)
            yield i + s, j + s


def forest(n: int, pairs) -> "np.ndarray":
    """Smallest index reachable from each of n, over arrays of pairs."""
    import numpy as np
    label = np.arange(n)
    for i, j in pairs:
        while True:
            low = np.minimum(label[i], label[j])
            if (low == label[i]).all() and (low == label[j]).all():
                break
            for x in (i, j):
                np.minimum.at(label, label[x], low)
                np.minimum.at(label, x, low)
            label = label[label]
    while (label != label[label]).any():
        label = label[label]
    return label


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest of the links in every bucket of distinct fingerprints (column fp)."""
    import pyarrow as pa

    blocks = radius + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    buckets = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed[a] | signed[b])).alias("key"))
               for t, (a, b) in enumerate(combinations(range(blocks), 2))]
    dealt = fps.select("fp", F.explode(F.array(*buckets)).alias("b")).select("fp", "b.t", "b.key")
    chunks = F.ceil(F.col("n") / (tile // 2)).cast("int")
    hot = dealt.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > tile).select("t", "key", chunks.alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = F.when(F.col("chunks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, own).alias("i"), F.greatest(c, own).alias("j"))))
    tiled = dealt.join(hot, ["t", "key"], "left").select("fp", "t", "key", F.explode(tiles).alias("tile")).select("fp", "t", "key", "tile.i", "tile.j")
    keys = ["t", "key", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def run(rows):
            """Links among whole buckets: sorted columns t, key, i, j, fp."""
            change = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            ends = np.concatenate([change, [rows.shape[1]]])
            last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
            starts = np.concatenate([[0], ends[:-1]])
            alone = np.repeat(ends - starts == 1, ends - starts)
            f, last = rows[4][~alone].view(np.uint64), (last - np.cumsum(alone)[last - 1])[~alone]
            label = forest(len(f), near_pairs(f, last, radius))
            linked = np.flatnonzero(label != np.arange(len(f)))
            f = f.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(f[linked]), pa.array(f[label[linked]])], names=["a", "b"])

        held = np.zeros((5, 0), np.int64)
        for b in batches:
            new = np.stack([b.column(n).to_numpy().astype(np.int64) for n in (*keys, "fp")])
            held = np.concatenate([held, new], axis=1)
            if held.shape[1] > 4 * tile:
                differs = np.flatnonzero((held[:4] != held[:4, -1:]).any(axis=0))
                if len(differs):            # the last bucket may go on in the next batch
                    cut = differs[-1] + 1
                    yield run(held[:, :cut])
                    held = held[:, cut:]
        if held.shape[1]:
            yield run(held)

    found = tiled.repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")
    return found.distinct()


def groups(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, component) of distinct fingerprints: component is the smallest fingerprint reachable by links."""
    found = components(links(fps, radius, tile)).withColumnRenamed("node", "fp")
    return fps.select("fp").join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", w: int = SHINGLE,
                   radius: int = RADIUS) -> DataFrame:
    """One row per document: id, text hash, fp (long) and component_id (smallest id reachable)."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), null_free(F.col(f"`{text_col}`")).alias("text"))
    marked = with_fingerprint(texts.withColumn("h", F.xxhash64("text")), "text", w).drop("text")
    marked = materialize(marked, "fingerprints")
    fps = materialize(marked.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    labels = materialize(groups(fps, radius), "fingerprint-groups")
    whole = fps.join(labels, "fp").groupBy("component").agg(F.min("id").alias("component_id"))
    named = labels.join(whole, "component").select("fp", "component", "component_id")
    return marked.join(named, "fp")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every group the row with the smallest (id, text hash) stays, one row of equal ones."""
    found = simhash_groups(docs)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first"))
    first = first.select(F.col("first.id").alias("_id"), F.col("first.h").alias("_h"))
    rows = docs.withColumn("_k", F.xxhash64(null_free(F.col("text"))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_h"))
    return without(rows.join(first, same, "left_semi").dropDuplicates(["doc_id", "_k"]), ["_k"]).select(docs.columns)
