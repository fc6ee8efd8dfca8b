"""Distributed difference-cover suffix sorting of many strings of symbols.

``suffix_ranks`` is DC3 with Spark as the sorter.  Strings are rows of symbol
arrays; a string ends with a symbol smaller than all others, so no comparison
runs into another string.

1. Triples of symbols at positions k = 1, 2 (mod 3) are sorted by range
   partitions and named by their order.
2. Strings where equal names cover less than ``depth`` units of length go to
   a smaller instance: their names at k = 1 and at k = 2 (mod 3) are two
   strings each, and its ranks order the suffixes of such a name.  All other
   names are ranks already.
3. The remaining suffixes k = 0 are merged: against k = 1 by (symbol, rank of
   k + 1), against k = 2 by (symbol, symbol, rank of k + 2).  Both are plain
   sorts; a suffix's rank is the number of suffixes smaller than it.

An instance of at most ``LOCAL`` symbols is sorted by one task, by doubling.

A sorted partition counts inside itself, offsets come from one total per
partition.  Equal keys share a rank, so the result does not depend on how
tasks order them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Smaller than every symbol and rank.
END = -(1 << 63)
NO_LIMIT = 1 << 62
#: Instances of so many symbols or fewer take one task: fewer rounds on small leftovers.
LOCAL = 250_000


def doubling(syms, off):
    """For every suffix of the strings ``syms[off[i]:off[i+1]]`` the number of smaller suffixes."""
    import numpy as np
    n = len(syms)
    last = np.repeat(off[1:], np.diff(off))                # end of each suffix's string
    rank = np.unique(syms, return_inverse=True)[1].astype(np.int64) + 1
    at, step = np.arange(n), 1
    longest = int(np.diff(off).max()) if n else 0
    while step < longest:
        follow = np.where(at + step < last, np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])[:n], 0)
        rank = np.unique(rank * (n + 2) + follow, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    smaller = np.concatenate([[0], np.cumsum(np.bincount(rank, minlength=n + 1))])
    return smaller[rank]


def _local_ranks(strings: DataFrame) -> DataFrame:
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rid = np.concatenate([b.column("rid").to_numpy() for b in got])
        sizes = np.concatenate([np.diff(b.column("syms").offsets.to_numpy()) for b in got])
        off = np.concatenate([[0], np.cumsum(sizes)])
        ranks = doubling(np.concatenate([b.column("syms").flatten().to_numpy() for b in got]), off)
        yield pa.RecordBatch.from_arrays([pa.array(rid), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ranks))], names=["rid", "ranks"])

    return strings.select("rid", "syms").coalesce(1).mapInArrow(run, "rid long, ranks array<long>")


def _smaller(scratch: Scratch, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (rid, k, kind, len, keys) as (rid, k, kind, len, n0, n1, same): numbers of rows of kind 0 and of
    other kinds with smaller keys, and of rows with equal keys."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        v = np.stack([t.column(c).to_numpy() for c in keys])
        first = np.concatenate([[True], (v[:, 1:] != v[:, :-1]).any(axis=0)])
        group = np.cumsum(first) - 1
        zero = t.column("kind").to_numpy() == 0
        at = np.flatnonzero(first)
        n0 = np.concatenate([[0], np.cumsum(zero)])
        n1 = np.concatenate([[0], np.cumsum(~zero)])
        size = np.diff(np.concatenate([at, [len(zero)]]))
        out = pa.Table.from_arrays([t.column("rid"), t.column("k"), t.column("kind"), t.column("len"), pa.array(n0[at][group]), pa.array(n1[at][group]),
                                    pa.array(size[group]), pa.array(np.full(len(zero), part, np.int32))],
                                   names=["rid", "k", "kind", "len", "n0", "n1", "same", "part"])
        yield from out.to_batches(max_chunksize=1 << 16)

    ordered = rows.repartitionByRange(*[F.col(c) for c in keys]).sortWithinPartitions(*keys).select("rid", "k", "kind", "len", *keys)
    local = scratch.keep(ordered.mapInArrow(count, "rid long, k int, kind int, len long, n0 long, n1 long, same long, part int"))
    totals = sorted((r["part"], r["z"], r["n"] - r["z"]) for r in local.groupBy("part").agg(
        F.sum((F.col("kind") == 0).cast("long")).alias("z"), F.count("*").alias("n")).collect())      # a row per partition
    # offsets by partition, as constants of the plan
    zero = [0] * (totals[-1][0] + 1 if totals else 1)
    rest, z, o = list(zero), 0, 0
    for part, dz, do in totals:
        zero[part], rest[part] = z, o
        z, o = z + dz, o + do
    before = lambda counts: F.get(F.expr(f"array({', '.join(f'{n}L' for n in counts)})"), F.col("part"))
    out = local.select("rid", "k", "kind", "len", (F.col("n0") + before(zero)).alias("n0"), (F.col("n1") + before(rest)).alias("n1"), "same")
    out._scratch = local._scratch
    return out


def _by_string(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(rid, name): a string's values in order of k, from rows of (rid, k, value)."""
    listed = F.sort_array(F.collect_list(F.struct("k", value)))
    return rows.groupBy("rid").agg(F.transform(listed, lambda x: x[value]).alias(name))


def suffix_ranks(scratch: Scratch, strings: DataFrame, depth: int) -> DataFrame:
    """(rid, ranks): for every suffix of every string the number of smaller suffixes.  strings: rid (long),
    syms (array<long>), lens (array<long>).  Suffixes that agree over ``depth`` units of length or more may
    share a rank or stand in any order among themselves."""
    import pyarrow as pa

    if (strings.agg(F.sum(F.size("syms"))).first()[0] or 0) <= LOCAL:
        return scratch.keep(_local_ranks(strings))

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for b in batches:
            rid = b.column("rid").to_numpy()
            off = b.column("syms").offsets.to_numpy()
            off = off - off[0]
            syms = b.column("syms").flatten().to_numpy()
            lens = b.column("lens").flatten().to_numpy()
            n = np.diff(off)
            own = np.repeat(np.arange(len(n)), n)
            k = np.arange(len(syms)) - off[own]
            pick = np.flatnonzero(k % 3 != 0)
            left = n[own[pick]] - k[pick]                 # symbols to the end of the string
            s = np.concatenate([syms, [END, END]])
            ln = np.concatenate([lens, [0, 0]])
            t1 = np.where(left > 1, s[pick + 1], END)
            t2 = np.where(left > 2, s[pick + 2], END)
            total = np.where(left > 2, ln[pick] + ln[pick + 1] + ln[pick + 2], NO_LIMIT)
            cols = [rid[own[pick]], k[pick].astype(np.int32), s[pick], t1, t2, np.minimum(total, NO_LIMIT)]
            t = pa.Table.from_arrays([pa.array(c) for c in cols], names=["rid", "k", "a", "b", "c", "len"])
            yield from t.to_batches(max_chunksize=1 << 16)

    sampled = strings.mapInArrow(triples, "rid long, k int, a long, b long, c long, len long")
    named = _smaller(scratch, sampled.withColumn("kind", F.lit(1)), ["a", "b", "c"])
    kept = named
    kind = F.col("k") % 3
    named = kept.select((F.col("rid") * 2 + kind - 1).alias("rid"), F.floor(F.col("k") / 3).cast("int").alias("k"), F.col("n1").alias("name"), "len",
                        ((F.col("same") > 1) & (F.col("len") < depth)).alias("short"))
    # a string whose names are all told apart is ranked by them and stays out of the smaller instance
    listed = F.sort_array(F.collect_list(F.struct("k", "name", "len", "short")))
    lists = scratch.keep(named.groupBy("rid").agg(listed.alias("l"), F.max("short").alias("open")))
    scratch.drop(kept)
    names = F.transform("l", lambda x: x["name"])
    if lists.where("open").limit(1).count():
        inner = suffix_ranks(scratch, lists.where("open").select("rid", names.alias("syms"), F.transform("l", lambda x: x["len"]).alias("lens")), depth)
        each = F.posexplode(F.arrays_zip("l.name", "l.short", "ranks")).alias("k", "x")
        flat = scratch.keep(lists.where("open").select("rid", "l").join(inner, "rid").select("rid", each)
                            .select("rid", "k", F.col("x.name").alias("name"), F.col("x.short").alias("short"), F.col("x.ranks").alias("order")))
        # the suffixes of one name are neighbours in the smaller instance's order
        base = flat.where("short").groupBy("name").agg(F.min("order").alias("least"))
        better = flat.join(base, "name", "left").select("rid", "k", F.when(F.col("short"), F.col("name") + F.col("order") - F.col("least")).otherwise(F.col("name")).alias("name"))
        got = scratch.keep(lists.where("not open").select("rid", names.alias("ranks")).union(_by_string(better, "name", "ranks")))
        scratch.drop(lists, inner, flat)
    else:
        got = lists.select("rid", names.alias("ranks"))
        got._scratch = lists._scratch

    pair = got.select(F.floor(F.col("rid") / 2).cast("long").alias("rid"), F.pmod("rid", F.lit(2)).alias("half"), "ranks")
    halves = pair.groupBy("rid").agg(F.max(F.when(F.col("half") == 0, F.col("ranks"))).alias("r1"), F.max(F.when(F.col("half") == 1, F.col("ranks"))).alias("r2"))
    full = scratch.keep(strings.select("rid", "syms").join(halves, "rid", "left"))

    def keys_of(batches: Iterator[pa.RecordBatch], against: int) -> Iterator[pa.RecordBatch]:
        """Rows of kinds 0 and ``against`` with the keys that order them against each other."""
        import numpy as np
        for b in batches:
            out = []
            for rid, syms, r1, r2 in zip(b.column("rid").to_pylist(), *(b.column(c) for c in ("syms", "r1", "r2"))):
                s = np.asarray(syms.values)
                n = len(s)
                rank = np.full(n + 3, END, np.int64)
                for at, r in ((1, r1), (2, r2)):
                    if r.is_valid:
                        rank[at:n:3][:len(r)] = np.asarray(r.values)
                k = np.concatenate([np.arange(0, n, 3), np.arange(against, n, 3)])
                more = np.concatenate([s, [END, END]])
                if against == 1:
                    keys = [s[k], rank[k + 1], np.zeros(len(k), np.int64)]
                else:
                    keys = [s[k], more[k + 1], np.where(k + 2 < n, rank[k + 2], END)]
                kinds = k % 3
                out.append((np.full(len(k), rid), k.astype(np.int32), kinds.astype(np.int32), *keys, np.zeros(len(k), np.int64)))
            if out:
                t = pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rid", "k", "kind", "a", "b", "c", "len"])
                yield from t.to_batches(max_chunksize=1 << 16)

    shape = "rid long, k int, kind int, a long, b long, c long, len long"
    one = _smaller(scratch, full.mapInArrow(lambda it: keys_of(it, 1), shape), ["a", "b"])
    two = _smaller(scratch, full.mapInArrow(lambda it: keys_of(it, 2), shape), ["a", "b", "c"])
    # kind 0: smaller ones of kind 0 and 1 from the first sort, of kind 2 from the second; others: smaller ones of kind 0
    first = one.select("rid", "k", "kind", F.when(F.col("kind") == 0, F.col("n0") + F.col("n1")).otherwise(F.col("n0")).alias("n"))
    second = two.select("rid", "k", "kind", F.when(F.col("kind") == 0, F.col("n1")).otherwise(F.col("n0")).alias("n"))
    # a string's rows meet once: the sums per place and the string's list need no shuffle of their own
    merged = first.union(second).repartition("rid").groupBy("rid", "k").agg(F.sum("n").alias("n"))
    counts = _by_string(merged, "n", "n")
    joined = full.select("rid", "r1", "r2").join(counts, "rid")
    # a sampled suffix adds its rank among the sampled ones
    third = lambda k: F.floor(k / 3).cast("int")
    sample = F.transform("n", lambda x, k: x + F.when(k % 3 == 1, F.get("r1", third(k))).when(k % 3 == 2, F.get("r2", third(k))).otherwise(0))
    ranks = scratch.keep(joined.select("rid", sample.alias("ranks")))
    scratch.drop(one, two, full, got)
    return ranks
