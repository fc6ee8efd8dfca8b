"""Suffix-array dedup (operator 7): bytes in a repeated string of ``LENGTH`` bytes are removed.

1. Narrowing, without loss.  The least hash of 8 bytes among the first ``WIDE``
   (a share of ``LENGTH``) places of a string of ``LENGTH`` bytes anchors it, wherever the string stands, and
   the anchor's next ``LENGTH - WIDE + 1`` bytes are inside the string.  Only
   the surroundings of anchors whose bytes there occur at two places or more
   (equal texts count as one) can hold repeats; they become regions.
2. Suffix array.  Regions are cut at the anchors of narrower windows
   (``NARROW``), which again depend on nearby bytes alone.  The suffixes that
   start at anchors are strings of the phrases between anchors.  The windows
   inside a 400-byte string fix all anchors from its first one, a, to its last
   one, which is no nearer to a than ``LENGTH - 2 NARROW - GRAM + 2``.  So equal
   strings share the phrases from a to the first anchor beyond that distance,
   and the order of suffixes matters up to there.  Where ``HEAD`` phrases reach
   it, equal ones in a row counted as one, suffixes are sorted by these.
   Regions with other suffixes (deep ones) are sorted by the distributed
   difference-cover algorithm of ``suffix_array``.
3. Adjacent prefixes.  In suffix order neighbours that agree on the shared
   phrases form runs; a suffix without such a neighbour starts no repeat.
4. Remaining suffixes, those that start between anchors.  An anchor's strings
   together are one stretch of bytes.  Where an equal stretch occurs in the
   run, all of them are repeats.  In runs of several different stretches one
   of each is spread out, first into stretches of ``PART`` strings, which are
   compared in the same way, then those that still differ into single strings.
   Stretches and strings are compared by 128-bit hashes of all their bytes.
5. The covered bytes of every text are merged to spans and cut out.

Anchors, runs and strings are rows; what is collected per key is bounded by
one text's length, and counts are aggregated before the shuffle.

Defined results: a null text is empty and loses nothing; equal texts of 400
bytes or more lose all bytes, shorter texts none; repeated rows are equal
texts; a text of any length is read whole; an empty table gives an empty
table; a cut inside a character is left to the caller (the operator returns
bytes).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import Scratch, null_free, slices, table, without
from .suffix_array import suffix_ranks

LENGTH = 400
#: Windows of anchors for a length: 256 and 128 for 400 bytes.
WIDE, NARROW = 16 / 25, 8 / 25
#: What the pipeline's stage removes: passages of over 50 words, which may have fewer than 400 bytes.
STAGE_LENGTH = 250
GRAM = 8
PART = 16
#: Phrases that a task makes rows of at once (a longer region is handled alone).
SYMBOLS = 1 << 15
#: Phrases that a suffix is sorted by directly, equal ones in a row as one: windows of 128 bytes need 3 on average.
HEAD = 8


def anchors(buf: bytes, window: int, length: int):
    """(anchor, first, last): every anchor of ``buf`` with its first and last string; empty if it is too short."""
    import numpy as np
    n = len(buf) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    need = n + window - 1
    raw = np.frombuffer(buf, np.uint8)
    g = np.empty(need, np.uint64)
    for o in range(GRAM):
        part = np.frombuffer(buf, "<u8", (len(raw) - o) // GRAM, o)
        at = g[o::GRAM]
        at[:] = part[:len(at)]
    g *= np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    bits = max(need - 1, 1).bit_length()               # hash above, place below: the least is the leftmost of equals
    g >>= np.uint64(bits)
    g <<= np.uint64(bits)
    g |= np.arange(need, dtype=np.uint64)
    size = 1
    while size < window:                               # least of windows of growing size
        step = min(size, window - size)
        g = np.minimum(g[:-step], g[step:])
        size += step
    at = (g & np.uint64((1 << bits) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.concatenate([first[1:], [n]]) - 1


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = null_free(F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.cast("binary").alias("bytes"))


def regions(scratch: Scratch, texts: DataFrame, classes: DataFrame, length: int, window: int) -> DataFrame:
    """(rid, key, start, bytes): stretches of different texts that can hold repeats."""
    import pyarrow as pa

    inside = length - window + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_64_intdigest
        for b in (part for whole in batches for part in slices(whole, "bytes")):
            rows: list = [[], [], [], []]
            for i, buf in enumerate(b.column("bytes").to_pylist()):
                at, first, last = anchors(buf, window, length)
                if len(at):
                    rows[0].append(np.full(len(at), i))
                    rows[1].append(first)
                    rows[2].append(last + length)
                    rows[3].append(np.array([xxh3_64_intdigest(buf[p:p + inside]) for p in at.tolist()], np.uint64).view(np.int64))
            if rows[0]:
                cat = [np.concatenate(c) for c in rows]
                t = pa.Table.from_arrays([b.column("key").take(pa.array(cat[0])), pa.array(cat[1].astype(np.int32)), pa.array(cat[2].astype(np.int32)), pa.array(cat[3])], names=["key", "s", "e", "h"])
                yield from t.to_batches(max_chunksize=1 << 16)

    found = scratch.keep(texts.select("key", "bytes").mapInArrow(find, "key binary, s int, e int, h long"))
    place = F.xxhash64("key", "s")
    often = found.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a <> z").select("h")
    near = found.join(often, "h").groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("near"))
    near = near.join(classes, "key").select("key", "first", "near")
    whole = texts.join(near.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("first"))).select("key", "bytes", "near")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for rows in batches for part in slices(rows, "bytes")):
            out: list = [[], [], []]
            for key, buf, near in zip(*(b.column(c).to_pylist() for c in ("key", "bytes", "near"))):
                for s, e in merged((x["s"], x["e"]) for x in near):
                    out[0].append(key)
                    out[1].append(s)
                    out[2].append(buf[s:e])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["key", "start", "bytes"])

    kept = scratch.keep(whole.mapInArrow(cut, "key binary, start int, bytes binary").withColumn("rid", F.monotonically_increasing_id()))
    scratch.drop(found)
    return kept


def merged(spans) -> list[tuple[int, int]]:
    """Spans as maximal runs in order; touching ones are one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def heads(syms, until, size: int):
    """(bytes, which are deep): per place in ``syms`` the symbols from there to ``until``, as bytes in their order.
    Equal symbols in a row are one entry with their number, counted down where a larger symbol follows; what has
    more than ``size`` entries is cut there and deep."""
    import numpy as np
    import pyarrow as pa
    if not len(syms):
        return pa.array([], pa.binary()), np.zeros(0, bool)
    new = np.concatenate([[True], syms[1:] != syms[:-1]])
    start = np.flatnonzero(new)
    end = np.concatenate([start[1:], [len(syms)]])
    larger = np.concatenate([syms[start[1:]] > syms[start[:-1]], [False]])
    run = np.cumsum(new) - 1
    entries = run[until - 1] - run + 1
    out = []
    for at in range(0, len(syms), 1 << 16):
        k = np.arange(at, min(at + (1 << 16), len(syms)))[:, None]
        to = until[at:at + (1 << 16), None]
        r = np.minimum(run[k] + np.arange(size), len(start) - 1)
        times = np.minimum(end[r], to) - np.maximum(start[r], k)
        entry = np.empty(r.shape, [("sym", ">u8"), ("times", ">u4")])
        entry["sym"] = syms[start[r]]
        entry["times"] = np.where(larger[r] & (end[r] < to), 0xFFFFFFFF - times, times) & 0xFFFFFFFF
        n = np.minimum(entries[at:at + (1 << 16)], size)
        ends = np.concatenate([[0], np.cumsum(n * entry.itemsize)]).astype(np.int32)
        kept = entry[np.arange(size) < n[:, None]].tobytes()
        out.append(pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept)]))
    return pa.concat_arrays(out), entries > size


def phrases(regs: DataFrame, length: int, window: int) -> DataFrame:
    """(rid, k, sym, len, first, last, off, head, deep, prefix, stretch): the phrases of a region in order of k, and of
    each one's anchor the first and last string (last < first: none), the bytes from the first string to the anchor,
    the phrases that equal strings share as bytes in suffix order, whether these are cut, the hash of all of them,
    and of the bytes that its strings cover together."""
    import pyarrow as pa

    view = window + GRAM - 1
    shared, size = length - view - window + 1, HEAD
    names = ["rid", "k", "sym", "len", "first", "last", "off", "head", "deep", "prefix", "stretch"]

    def rows_of(found: list) -> pa.Table:
        import numpy as np
        from xxhash import xxh3_128_digest, xxh64_intdigest
        cols: list = [[] for _ in range(8)]
        prefix: list = []
        stretch: list = []
        n = 0
        for rid, buf, at, first, last in found:
            last = np.minimum(last, len(buf) - length)
            ends = np.concatenate([at[1:], [len(buf)]])
            syms = np.array([xxh64_intdigest(buf[p:q]) for p, q in zip(at.tolist(), ends.tolist())], np.uint64)
            raw = syms.tobytes()
            until = np.searchsorted(at, at + shared)
            some = (last >= first).tolist()
            for c, v in zip(cols, (np.full(len(at), rid), np.arange(len(at)), syms, ends - at, first, last, at - first, until + n)):
                c.append(v)
            n += len(at)
            prefix.extend(xxh3_128_digest(raw[8 * i:8 * u]) if x else None for i, (u, x) in enumerate(zip(until.tolist(), some)))
            stretch.extend(xxh3_128_digest(buf[p:q + length]) if x else None for p, q, x in zip(first.tolist(), last.tolist(), some))
        rid, k, syms, lens, first, last, off, until = (np.concatenate(c) for c in cols)
        head, deep = heads(syms, until, size)
        ints = [pa.array(c.astype(np.int32)) for c in (first, last, off)]
        return pa.Table.from_arrays([pa.array(rid), pa.array(k.astype(np.int32)), pa.array(syms.view(np.int64)), pa.array(lens), *ints, head, pa.array(deep),
                                     pa.array(prefix, pa.binary()), pa.array(stretch, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, "bytes")):
            found: list = []
            n = 0
            for rid, buf in zip(b.column("rid").to_pylist(), b.column("bytes").to_pylist()):
                at, first, last = anchors(buf, window, view)
                found.append((rid, buf, at, first, last))
                n += len(at)
                if n >= SYMBOLS:
                    yield from rows_of(found).to_batches(max_chunksize=1 << 16)
                    found, n = [], 0
            if found:
                yield from rows_of(found).to_batches(max_chunksize=1 << 16)

    return regs.select("rid", "bytes").mapInArrow(
        run, "rid long, k int, sym long, len long, first int, last int, off int, head binary, deep boolean, prefix binary, stretch binary")


def runs(rows: DataFrame, order: str) -> DataFrame:
    """Of rows (order, rid, prefix, ...) those that agree with a neighbour in suffix order, without the order; a
    partition's first and last run may go on in the next and stay."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        held: pa.Table | None = None      # the last row so far, with whether it agrees with the one before it
        agrees = True                     # the partition's first row may agree with the partition before
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if t.num_rows > 1:
                p = t.column("prefix")
                same = pc.equal(p.slice(1), p.slice(0, len(p) - 1)).to_numpy()
                before = np.concatenate([[agrees], same])
                yield from t.slice(0, t.num_rows - 1).filter(pa.array(before[:-1] | same)).combine_chunks().to_batches()
                agrees = bool(before[-1])
            held = t.slice(t.num_rows - 1) if t.num_rows else None
        if held is not None:
            yield from held.combine_chunks().to_batches()

    # equal prefixes may be many: they are dealt on by string, as a run may be cut anywhere
    ordered = rows.repartitionByRange(order, "prefix", "rid").sortWithinPartitions(order, "prefix").drop(order)
    return ordered.mapInArrow(adjacent, ordered.schema)


WHAT = ["prefix", "off", "more", "stretch"]


def _kinds(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """The different stretches of every run with the number of places and one of them (any, its columns together as a
    hash aggregate takes them from one row); rows may stand for several."""
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    one = [F.first(c).alias(c) for c in ("rid", "first", "last")]
    return scratch.keep(rows.groupBy(*WHAT).agg(n.alias("n"), *one))


def _resolved(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """(rid, s, e): stretches that occur twice or more."""
    return rows.join(kinds.where("n > 1").select(*WHAT), WHAT).select("rid", F.col("first").alias("s"), (F.col("last") + length).alias("e"))


def _mixed(kinds: DataFrame) -> DataFrame:
    """One place of each stretch, from runs with several different ones."""
    mixed = kinds.groupBy("prefix").agg(F.count("*").alias("kinds")).where("kinds > 1").select("prefix")
    return kinds.join(mixed, "prefix").select("rid", F.struct("first", "last", "off", F.least("n", F.lit(2)).alias("n")).alias("a"))


def _spread(regs: DataFrame, places: DataFrame, length: int, size: int) -> DataFrame:
    """Rows of shorter stretches: an anchor's strings dealt by their distance to it, ``size`` distances to a
    stretch.  prefix is the hash of the bytes that all strings at these distances hold, n is 2 where a stretch
    is known to occur again."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        names = ["rid", "first", "last", "off", "more", "prefix", "stretch", "n"]
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                rows: list = []
                for rid, buf, found in zip(*(part.column(c).to_pylist() for c in ("rid", "bytes", "a"))):
                    for x in found:
                        anchor = x["first"] + x["off"]
                        p = x["first"]
                        while p <= x["last"]:
                            low = (anchor - p) // size * size                    # distances low .. low + size - 1
                            q = min(x["last"], anchor - low)
                            # all strings at these distances hold the bytes from the nearest one's start on
                            core = xxh3_128_digest(buf[anchor - low:anchor - low - size + 1 + length]) if size > 1 else b""
                            rows.append((rid, p, q, anchor - p, q - p, core, xxh3_128_digest(buf[p:q + length]), x["n"]))
                            p = q + 1
                if rows:
                    t = pa.Table.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
                    yield from t.to_batches(max_chunksize=1 << 16)

    texts = regs.select("rid", "bytes").join(places.groupBy("rid").agg(F.collect_list("a").alias("a")), "rid")
    return texts.mapInArrow(run, "rid long, first int, last int, off int, more int, prefix binary, stretch binary, n long")


def _deep_runs(scratch: Scratch, found: DataFrame, depth: int, cols: list[str]) -> DataFrame:
    """The runs of suffixes whose head leaves their order open, by the ranks of the regions that hold such."""
    deep = found.where("deep and last >= first")
    listed = F.sort_array(F.collect_list(F.struct("k", "sym", "len")))
    strings = scratch.keep(found.join(deep.select("rid").distinct(), "rid").groupBy("rid").agg(listed.alias("l")).select(
        "rid", F.transform("l", lambda x: x["sym"]).alias("syms"), F.transform("l", lambda x: x["len"]).alias("lens")))
    ranks = suffix_ranks(scratch, strings, depth)
    rows = deep.join(ranks.select("rid", F.posexplode("ranks").alias("k", "rank")), ["rid", "k"]).select("rank", "rid", *cols)
    out = scratch.keep(runs(rows, "rank"))
    scratch.drop(strings, ranks)
    return out


def repeated(scratch: Scratch, regs: DataFrame, length: int, window: int) -> DataFrame:
    """(key, s, e): stretches of the texts that repeated strings cover; they may overlap."""
    import pyarrow as pa

    strings = scratch.keep(phrases(regs, length, window))
    shared = length - 2 * window - GRAM + 2         # what equal strings share ends at the first anchor beyond
    cols = ["first", "last", "off", "prefix", "stretch"]
    rows = strings.where("last >= first and not deep").select("head", "rid", *cols)
    deep = _deep_runs(scratch, strings, shared, cols)
    found = scratch.keep(runs(rows, "head").unionByName(deep))
    scratch.drop(strings, deep)

    # an anchor's strings are told apart by their places before it: the first one's, and how many there are
    rows = found.withColumn("more", F.col("last") - F.col("first"))
    runs_of = _kinds(scratch, rows)
    sure = _resolved(rows, runs_of, length)

    parts = scratch.keep(_spread(regs, _mixed(runs_of), length, PART))
    parts_of = _kinds(scratch, parts)
    close = _resolved(parts.where("n = 1"), parts_of, length)

    single = scratch.keep(_spread(regs, _mixed(parts_of), length, 1))
    twice = single.groupBy("stretch", "off").agg(F.sum("n").alias("all")).where("all > 1").select("stretch", "off")
    some = single.where("n = 1").join(twice, ["stretch", "off"]).select("rid", F.col("first").alias("s"), (F.col("first") + length).alias("e"))
    spans = sure.union(close).union(some).groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    out = regs.select("rid", "key", "start").join(spans, "rid")
    out = scratch.keep(out.select("key", F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e"))).alias("spans")))
    scratch.drop(found, runs_of, parts, parts_of, single)
    return out


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, wide: int | None = None,
            narrow: int | None = None) -> DataFrame:
    """(key, n, spans) for every different text: md5, number of rows, and covered stretches of its bytes (may overlap)."""
    wide, narrow = wide or round(length * WIDE), narrow or round(length * NARROW)
    if length - wide + 1 < GRAM or length - 2 * narrow - GRAM + 2 < 1:
        raise ValueError("windows must leave room for an anchor's bytes")
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    texts = _texts(docs, id_col, text_col)
    classes = scratch.keep(texts.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.max(F.octet_length("bytes")).alias("size")))
    regs = regions(scratch, texts, classes, length, wide)
    spans = repeated(scratch, regs, length, narrow)
    scratch.drop(regs)
    by_text = spans.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("size").alias("e")))
    covered = F.when((F.col("n") > 1) & (F.col("size") >= length), whole).otherwise(F.col("spans"))
    return classes.join(by_text, "key", "left").select("key", "n", covered.alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with kept (binary: the remaining bytes), n_bytes, n_removed and n_spans."""
    import pyarrow as pa

    fields = [StructField("kept", BinaryType()), StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())]
    base = without(docs, [f.name for f in fields])
    spans = repeats(docs, id_col, text_col, length).where("spans is not null").select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    text = null_free(F.col(f"`{text_col}`")).cast("binary")
    rows = base.join(spans, F.unhex(F.md5(text)) == F.col("_key"), "left").drop("_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text_col):
                out: list = [[], [], [], []]
                for buf, found in zip(b.column(text_col).cast(pa.binary()).to_pylist(), b.column("_spans").to_pylist()):
                    buf = buf or b""
                    cut = merged((x["s"], x["e"]) for x in found or ())
                    edges = [0, *(p for s in cut for p in s), len(buf)]
                    out[0].append(b"".join(buf[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)))
                    out[1].append(len(buf))
                    out[2].append(sum(e - s for s, e in cut))
                    out[3].append(len(cut))
                kept = [b.column(c) for c in b.schema.names if c != "_spans"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out[0], pa.binary()), *(pa.array(v, pa.int64()) for v in out[1:])],
                                                 names=[*(c for c in b.schema.names if c != "_spans"), *(f.name for f in fields)])

    return rows.mapInArrow(run, StructType(base.schema.fields + fields))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses, and a digest of what stays."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def stage_suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, length: int = STAGE_LENGTH) -> DataFrame:
    """Pipeline stage: texts without repeated stretches of ``length`` bytes. A cut may split a character: its rest becomes U+FFFD.
    Documents of which nothing is left go; n_chars follows the text."""
    out = remove_repeats(docs, length=length).withColumn("_text", F.make_valid_utf8(F.col("kept").cast("string")))
    out = out.where((F.octet_length("kept") > 0) | (F.col("n_removed") == 0))
    new = F.when(F.col("n_removed") > 0, F.col("_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.char_length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    cols = {"text": new} | ({"n_chars": chars} if chars is not None else {})
    return out.withColumns(cols).select(docs.columns)
