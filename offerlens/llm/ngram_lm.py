"""Language-model scores from Elias-Fano n-gram tries (operator 12).

A trigram model with interpolated absolute discounting (``DISCOUNT`` d):

    P3(w|u,v) = a3 + g3 P2(w|v),  a3 = (n(uvw) - d) / n(uv),  g3 = d types(uv) / n(uv)
    P2(w|v)   = a2 + g2 P1(w),    a2 = (n(vw) - d) / n(v),    g2 = d types(v) / n(v)
    P1(w)     = (n(w) + 0.1) / (N + 0.1 (V + 1))

A context that training never saw leaves a = 0, g = 1; a text's first word has
the context of its start only.  a and g are rounded down to powers of
2^(1 / ``STEPS``), kept as 12-bit codes, so that the probabilities of all words
(and of one unknown word) still sum to at most 1.

Texts are encoded once, in chunks with a dictionary of their own.  Chunks send their words to buckets, which add up
their counts and answer with ids and counts.  Each chunk sends its distinct triples (compressed) to the shards of the model, dealt by their first word (and, for
words with a thousandth of all tokens, by the second word as well).  A shard's task merges what the training texts
sent, builds the trie of its words (``elias_fano``), writes it to the shared folder, maps the file into memory and finds
all chunks' triples by successor searches.  The answers go back to the chunks, which add up their documents' tokens.  The number
of shards grows with the corpus, so that no task holds more than about ``SHARD`` tokens' triples.

Defined results: a null text is empty and has the end token only; rows with a
null id learn and count as rows of their own, as repeated rows do; texts beyond ``CHUNK`` words
are scored in pieces that know their neighbours' words; without any training
row every token is unknown and P1 is 1; an empty table gives an empty table;
other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .collocations import blocks
from .common import Scratch, null_free, table

DISCOUNT = 0.75
STEPS = 64
#: Words of a chunk, and tokens of the corpus for each shard of the model.
CHUNK, SHARD = 1_000_000, 500_000
#: Words of the corpus for each bucket of the word counts.
BUCKET = 4_000_000
HOT = 1000
END, START, PAD, UNKNOWN, FIRST_WORD = 0, 1, 2, 3, 4
NONE = 4095

#: Tokens and windows that are looked up at once.
AT_ONCE = 250_000

ENCODED = ("chunk long, words binary, trained binary, tokens long, rank binary, codes binary, rid array<long>, doc_id array<long>, held_out array<boolean>, "
           "size array<int>, skip array<int>, ahead array<int>")


def squeeze(x) -> bytes:
    """Integers as bytes, all first bytes before all second ones, compressed."""
    import numpy as np
    import zstandard
    width = 2 if x.dtype == np.uint16 else 4 if not len(x) or max(int(x.max()), -int(x.min())) < 2 ** 31 else 8
    raw = x.astype(f"<i{width}" if width > 2 else "<u2").view(np.uint8).reshape(len(x), width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def stretch(raw: bytes):
    """The integers of ``squeeze``."""
    import numpy as np
    import zstandard
    width = raw[0]
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(width, -1).T
    return np.ascontiguousarray(x).view("<u2" if width == 2 else f"<i{width}").ravel()


def squeeze_words(words: list[bytes]) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def stretch_words(raw: bytes) -> list[bytes]:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(raw).split()


def word_hashes(words: list[bytes]):
    import numpy as np
    import xxhash
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def encode(docs: DataFrame, doc_id: Column, text: Column, held_out: Column, chunk: int | None = None) -> DataFrame:
    """Chunks of texts: distinct words in the order of their hashes, their counts in training rows, their ranks by frequency, the codes (ranks; -1 is the
    end, -2 the start), and per piece of a document: row, id, role, number of codes, codes known before and after it."""
    import pyarrow as pa
    chunk = max(2, chunk or CHUNK)      # two words of a piece are the next one's context
    rows = docs.select(doc_id.cast("long").alias("doc_id"), null_free(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        part = TaskContext.get().partitionId() << 33
        n_rows = n_chunks = held = 0
        index: dict[bytes, int] = {}
        open_: list[bytes] = []         # tokens whose codes are not known yet
        made: list = []
        pieces: list[tuple] = []        # row, id, held out, words, whether it begins and ends the text, words before

        def look_up() -> None:
            a = pa.array(open_, pa.binary()).dictionary_encode()
            own = np.array([index.setdefault(w, len(index)) for w in a.dictionary.to_pylist()], np.int32)
            made.append(own[a.indices.to_numpy()] if len(own) else np.zeros(0, np.int32))
            open_.clear()

        def close() -> pa.RecordBatch:
            nonlocal n_chunks, held
            look_up()
            rid, ids, kept, n, begins, ends, before = zip(*pieces)
            begins, ends = np.array(begins), np.array(ends)
            size = np.array(n) + begins + ends
            skip, ahead = np.where(begins, 1, before), np.where(ends, 0, 1)
            stop = np.cumsum(size)
            codes = np.zeros(int(stop[-1]), np.int32)
            word = np.ones(len(codes), bool)
            word[(stop - size)[begins]] = word[(stop - 1)[ends]] = False
            words = list(index)
            order = np.argsort(word_hashes(words), kind="stable")
            seen = np.concatenate(made)
            rank = np.empty(len(words), np.int32)
            rank[np.argsort(-np.bincount(seen, minlength=len(words)), kind="stable")] = np.arange(len(words))
            codes[word] = rank[seen]
            codes[(stop - size)[begins]], codes[(stop - 1)[ends]] = -2, -1
            inside = np.arange(len(codes)) - np.repeat(stop - size, size)
            own = word & (inside >= np.repeat(skip, size)) & (inside < np.repeat(size - ahead, size)) & ~np.repeat(np.array(kept), size)
            trained = np.bincount(codes[own], minlength=len(index))
            lists = ((rid, pa.int64()), (ids, pa.int64()), (kept, pa.bool_()), (size, pa.int32()), (skip, pa.int32()), (ahead, pa.int32()))
            out = pa.RecordBatch.from_arrays(
                [pa.array([part + n_chunks]), pa.array([squeeze_words([words[i] for i in order])], pa.binary()), pa.array([squeeze(trained[rank[order]])], pa.binary()),
                 pa.array([int(trained.sum())]), pa.array([squeeze(rank[order])], pa.binary()), pa.array([squeeze(codes)], pa.binary()), *(pa.array([x], pa.list_(kind)) for x, kind in lists)],
                names=["chunk", "words", "trained", "tokens", "rank", "codes", "rid", "doc_id", "held_out", "size", "skip", "ahead"])
            n_chunks, held = n_chunks + 1, 0
            index.clear()
            made.clear()
            pieces.clear()
            return out

        for b in batches:
            for doc, text_, out in zip(*(b.column(k) for k in ("doc_id", "text", "held_out"))):
                doc, out, row = doc.as_py(), out.as_py(), part + n_rows
                n_rows += 1
                before: list[bytes] = []
                tokens: list[bytes] = []
                begins = True
                for block in blocks(text_.as_py()):
                    tokens += block.split()
                    while len(tokens) > chunk:                  # a piece that goes on
                        open_.extend(before + tokens[:chunk + 1])
                        pieces.append((row, doc, out, len(before) + chunk + 1, begins, False, len(before)))
                        before, tokens, begins = tokens[chunk - 2:chunk], tokens[chunk:], False
                        yield close()
                open_.extend(before + tokens)
                pieces.append((row, doc, out, len(before) + len(tokens), begins, True, len(before)))
                held += len(tokens) + 1
                if len(open_) > AT_ONCE:
                    look_up()
                if held > chunk:
                    yield close()
        if pieces:
            yield close()

    return rows.mapInArrow(run, ENCODED)


def count_words(chunks: DataFrame, tokens: int) -> DataFrame:
    """What the buckets of words answer each chunk: ids (small for frequent words) and counts of its words, bucket by
    bucket in the order of the chunk's words.  A row without a chunk has a bucket's number of training words and the
    ids and counts of those with a share of 1 / ``HOT`` of all tokens."""
    import pyarrow as pa
    bits = max(0, (tokens // BUCKET).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for b in batches:
            for i in range(b.num_rows):
                words, trained = stretch_words(b.column("words")[i].as_py()), stretch(b.column("trained")[i].as_py())
                bucket = (word_hashes(words) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
                cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(words)] if words else np.zeros(1, np.int64)
                ends = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]]), pa.array([b.column("chunk")[i].as_py()] * len(ends), pa.int64()),
                     pa.array([squeeze_words(words[s:e]) for s, e in ends], pa.binary()), pa.array([squeeze(trained[s:e]) for s, e in ends], pa.binary())],
                    names=["bucket", "chunk", "words", "trained"])

    def answer(key: tuple, t: pa.Table) -> pa.Table:
        import numpy as np
        no = key[0].as_py()
        parts = [stretch_words(x) for x in t.column("words").to_pylist()]
        a = pa.array([w for p in parts for w in p], pa.binary()).dictionary_encode()
        at = a.indices.to_numpy()
        c = np.bincount(at, np.concatenate([stretch(x) for x in t.column("trained").to_pylist()]), len(a.dictionary)).astype(np.int64)
        order = sorted(range(len(c)), key=lambda i: (-c[i], a.dictionary[i].as_py()))
        rank = np.empty(len(c), np.int64)
        rank[order] = np.arange(len(c))
        ids = np.where(c > 0, FIRST_WORD + (rank << bits) + no, UNKNOWN)
        cuts = np.cumsum([0, *map(len, parts)])
        often = c * HOT >= max(tokens, 1)
        pieces = [at[s:e] for s, e in zip(cuts[:-1], cuts[1:])]
        return pa.table({"chunk": pa.array([*t.column("chunk").to_pylist(), None], pa.int64()), "bucket": pa.array([no] * (len(parts) + 1), pa.int64()),
                         "ids": pa.array([*(squeeze(ids[p]) for p in pieces), squeeze(ids[often])], pa.binary()),
                         "c": pa.array([*(squeeze(c[p]) for p in pieces), squeeze(c[often])], pa.binary()),
                         "words": pa.array([None] * len(parts) + [int((c > 0).sum())], pa.int64())})

    sent = chunks.select("chunk", "words", "trained").mapInArrow(send, "bucket long, chunk long, words binary, trained binary")
    return sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, ids binary, c binary, words long")


def with_ids(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """``chunks`` with the ids and counts of their words in place of the words."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def join(t: pa.Table) -> pa.Table:
        import numpy as np
        mine = pc.is_null(t.column("bucket"))
        got, own = t.filter(pc.invert(mine)), t.filter(mine).drop_columns(["ids", "c", "bucket"])
        order, rank = np.argsort(got.column("bucket").to_numpy()), stretch(own.column("rank")[0].as_py())
        for name in ("ids", "c"):
            raw = got.column(name).to_pylist()
            x = np.zeros(len(rank), np.int64)
            x[rank] = np.concatenate([stretch(raw[i]) for i in order] or [x])
            own = own.append_column(pa.field(name, pa.binary()), pa.array([squeeze(x)], pa.binary()))
        return own.drop_columns(["rank"])

    own = chunks.drop("words", "trained", "tokens")
    schema = own.drop("rank").withColumns({"ids": F.lit(b""), "c": F.lit(b"")}).schema
    got = answers.where("chunk is not null").select("chunk", "bucket", "ids", "c")
    return own.unionByName(got, allowMissingColumns=True).groupBy("chunk").applyInArrow(join, schema)


def row_of(batch, i: int) -> dict:
    """A row whose lists are arrays."""
    out = {}
    for name in batch.schema.names:
        x = batch.column(name)[i]
        out[name] = x.values.to_numpy(zero_copy_only=False) if hasattr(x, "values") and x.is_valid else x.as_py()
    return out


class Chunk:
    """One row of ``with_ids`` as arrays."""

    def __init__(self, row: dict, n_train: int):
        import numpy as np
        codes = stretch(row["codes"])
        ids, c = (np.r_[stretch(row[k]), 0, 0].astype(np.int64) for k in ("ids", "c"))
        ids[-1], ids[-2], c[-1] = END, START, n_train
        self.x, self.c = ids[codes], c[codes]
        size, skip, ahead = (np.asarray(row[k], np.int64) for k in ("size", "skip", "ahead"))
        self.start = np.r_[0, np.cumsum(size)]
        inside = np.arange(len(codes)) - np.repeat(self.start[:-1], size)
        self.owned = (inside >= np.repeat(skip, size)) & (inside < np.repeat(size - ahead, size))   # tokens that count here
        self.inside, self.size = inside, size
        more = inside < np.repeat(size, size) - 1
        self.at = np.flatnonzero(more)                                                              # where windows begin
        third = np.r_[self.x[2:], PAD, PAD][:len(codes)]
        self.w = np.where(inside < np.repeat(size, size) - 2, third, PAD)[self.at]
        self.u, self.v = self.x[self.at], self.x[self.at + 1] if len(self.at) else self.x[:0]


def shard_of(u, v, hot: tuple, shards: int):
    """Shard of each window: by its first word, and by its second one where the first is hot."""
    import numpy as np
    mix = np.uint64(0x9E3779B97F4A7C15)
    words, pieces = hot
    salt = np.zeros(len(u), np.uint64)
    if len(words):
        at = np.minimum(np.searchsorted(words, u), len(words) - 1)
        hit = words[at] == u
        salt[hit] = (v[hit].astype(np.uint64) * mix >> np.uint64(33)) % pieces[at[hit]] + np.uint64(1)
    h = (u.astype(np.uint64) * mix ^ salt * np.uint64(0xC2B2AE3D27D4EB4F)) * mix
    return ((h >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)


def in_order(*keys):
    """The order by several keys, the first one first; two that fit into one number are compared at once."""
    import numpy as np
    if all(not len(k) or 0 <= k.min() and k.max() < 2 ** 31 for k in keys):
        keys = [keys[i] << 32 | keys[i + 1] if i + 1 < len(keys) else keys[i] for i in range(0, len(keys), 2)]
    return np.lexsort(keys[::-1])


def distinct(shard, u, v, w):
    """(first, inverse, count): the distinct windows in the order of (shard, u, v, w)."""
    import numpy as np
    order = in_order(shard, u, v, w)
    s = [x[order] for x in (shard, u, v, w)]
    new = np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in s])] if len(order) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    inverse = np.empty(len(order), np.int64)
    inverse[order] = number
    return order[new], inverse, np.bincount(number, minlength=int(new.sum()))


def code_of(p):
    """Codes of probabilities, rounded down."""
    import numpy as np
    with np.errstate(divide="ignore"):
        return np.minimum(np.ceil(-np.log2(p) * STEPS - 1e-9), NONE - 1).astype(np.uint16)


def value_of(code, missing: float):
    import numpy as np
    return np.where(code == NONE, missing, np.exp2(-code.astype(np.float64) / STEPS))


def build_trie(u, v, w, n, totals: dict, discount: float):
    """(trie, types): the trie of sorted distinct triples and their counts (w = PAD: the pair only ends there);
    ``totals``: counts of words whose pairs lie in several tries, for which ``types`` has this trie's part."""
    import numpy as np

    from .elias_fano import EliasFano, Siblings, Trie, pack
    new2 = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])] if len(u) else np.zeros(0, bool)
    pair = np.cumsum(new2) - 1
    pu, pv = u[new2], v[new2]
    n2 = np.bincount(pair, n, len(pu)).astype(np.int64)
    new1 = np.r_[True, pu[1:] != pu[:-1]] if len(pu) else np.zeros(0, bool)
    word = np.cumsum(new1) - 1
    wu = pu[new1]
    n1 = np.bincount(word, n2, len(wu))
    types1 = np.bincount(word, minlength=len(wu))
    split = [i for i, x in enumerate(wu.tolist()) if x in totals]
    n1[split] = [totals[int(wu[i])] for i in split]
    real = w != PAD
    tw, tn, tp = w[real], n[real], pair[real]
    n3, types3 = np.bincount(tp, tn, len(pu)), np.bincount(tp, minlength=len(pu))
    codes = {"g2": code_of(discount * types1 / n1), "a2": code_of((n2 - discount) / n1[word]),
             "g3": np.where(n3 > 0, code_of(discount * np.maximum(types3, 1) / np.maximum(n3, 1)), NONE).astype(np.uint16),
             "a3": code_of((tn - discount) / n3[tp])}
    codes = {k: pack(x, Trie.WIDTH) for k, x in codes.items()}
    trie = Trie(EliasFano.build(wu), Siblings.build(np.r_[np.flatnonzero(new1), len(pu)].astype(np.int64), pv),
                Siblings.build(np.r_[0, np.cumsum(types3)].astype(np.int64), tw), codes)
    return trie, {int(wu[i]): int(types1[i]) for i in split}


@dataclass
class Model:
    """The tries' folder and what all tasks know: numbers of tokens, words, texts and shards, hot words (ids, pieces), their counts."""
    folder: str
    tokens: int
    words: int
    texts: int
    shards: int
    hot: tuple
    totals: dict
    discount: float


def _place(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:09d}.trie"


def _blocks(chunks: DataFrame, shards: int, hot: tuple, n_train: int) -> DataFrame:
    """What each chunk sends to each shard: its distinct windows as sorted arrays, and how often training rows have them."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for b in batches:
            for i in range(b.num_rows):
                row = row_of(b, i)
                c = Chunk(row, n_train)
                trains = c.owned[c.at + 1] & ~np.repeat(np.asarray(row["held_out"], bool), c.size)[c.at]
                shard = shard_of(c.u, c.v, hot, shards)
                first, inverse, _ = distinct(shard, c.u, c.v, c.w)
                n = np.bincount(inverse, trains, len(first)).astype(np.int64)
                shard, u, v, w = (x[first] for x in (shard, c.u, c.v, c.w))
                cuts = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)] if len(shard) else np.zeros(1, np.int64)
                raw = [pa.array([squeeze(x[s:e]) for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()) for x in (u, v, w, n)]
                yield pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]]), pa.array(np.full(len(cuts) - 1, row["chunk"])), *raw],
                                                 names=["shard", "chunk", "u", "v", "w", "n"])

    return chunks.select("chunk", "codes", "held_out", "size", "skip", "ahead", "ids", "c") \
        .mapInArrow(run, "shard long, chunk long, u binary, v binary, w binary, n binary")


def plan(spark: SparkSession, answers: DataFrame, tokens: int, n_train: int, discount: float = DISCOUNT, folder: str | None = None) -> Model:
    """A model whose tries are not built yet; ``folder``: where they will be."""
    import numpy as np
    n_words = answers.agg(F.sum("words")).first()[0] or 0
    totals: dict[int, int] = {}         # of at most HOT words
    often = F.length("ids") > len(squeeze(np.zeros(0, np.int64)))
    for r in answers.where(F.col("chunk").isNull() & often).select("ids", "c").collect():
        totals |= dict(zip(stretch(r["ids"]).tolist(), stretch(r["c"]).tolist()))
    if n_train * HOT >= tokens and n_train:
        totals[START] = n_train
    ids = sorted(totals)
    hot = (np.array(ids, np.int64), np.array([-(-totals[x] * HOT // tokens) for x in ids], np.uint64))
    return Model(folder or scratch_path(spark, "ngram-lm"), tokens, n_words + bool(n_train), n_train, tokens // SHARD + 1, hot, totals, discount)


def fit_and_answer(chunks: DataFrame, model: Model) -> DataFrame:
    """(chunk, shard, found, id, types): each shard's task builds its trie from what training rows sent, writes it to
    the model's folder, maps it, and answers every chunk with the codes of its windows (those of g2, a2, g3 and a3
    one after the other).  Rows without a chunk have a hot word's number of followers in the shard."""
    import numpy as np
    import pyarrow as pa

    def work(key: tuple, t: pa.Table) -> pa.Table:
        from pyarrow import fs
        from pyspark import TaskContext
        no = key[0].as_py()
        u, v, w = (np.concatenate([stretch(x) for x in t.column(k).to_pylist()]).astype(np.int64) for k in ("u", "v", "w"))
        parts = [stretch(x) for x in t.column("n").to_pylist()]
        sizes, n = [len(x) for x in parts], np.concatenate(parts).astype(np.int64)
        order = in_order(u, v, w)               # what several chunks ask is looked up once
        u, v, w = u[order], v[order], w[order]
        new = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1])] if len(u) else np.zeros(0, bool)
        n = np.add.reduceat(n[order], np.flatnonzero(new)) if len(u) else n
        asked, known, types = (u[new], v[new], w[new]), n > 0, {}
        if known.any():
            trie, types = build_trie(*(x[known] for x in asked), n[known], model.totals, model.discount)
            store, root = fs.FileSystem.from_uri(model.folder)
            store.create_dir(root, recursive=True)
            own = f"{_place(root, no)}.{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(own) as out:
                out.write(trie.dump())
            store.move(own, _place(root, no))
            del trie
        once = look_up(open_trie(model.folder, no) if known.any() else None, *asked)
        codes = np.empty((4, len(u)), np.uint16)
        codes[:, order] = once[:, np.cumsum(new) - 1]
        cuts = np.cumsum([0, *sizes])
        found = [squeeze(codes[:, s:e].ravel()) for s, e in zip(cuts[:-1], cuts[1:])]
        chunk = t.column("chunk").to_pylist()
        return pa.table({"chunk": pa.array([*chunk, *[None] * len(types)], pa.int64()), "shard": pa.array([no] * (len(chunk) + len(types)), pa.int64()),
                         "found": pa.array([*found, *[None] * len(types)], pa.binary()), "id": pa.array([*[None] * len(chunk), *types], pa.int64()),
                         "types": pa.array([*[None] * len(chunk), *types.values()], pa.int64())})

    sent = _blocks(chunks, model.shards, model.hot, model.texts)
    return sent.groupBy("shard").applyInArrow(work, "chunk long, shard long, found binary, id long, types long")


def look_up(trie, u, v, w):
    """Codes of g2, a2, g3 and a3 of windows."""
    import numpy as np
    codes = np.full((4, len(u)), NONE, np.uint16)
    for s in range(0, len(u) if trie is not None else 0, AT_ONCE):
        some = slice(s, s + AT_ONCE)
        word, pair, triple = trie.find(u[some], v[some], w[some])
        for row, name, at in ((0, "g2", word), (1, "a2", pair), (2, "g3", pair), (3, "a3", triple)):
            hit = np.flatnonzero(at >= 0)
            codes[row, s + hit] = trie.code(name, at[hit])
    return codes


def open_trie(folder: str, shard: int):
    """The shard's trie, memory-mapped where the folder is a file system's; None if training sent nothing to it."""
    import pyarrow as pa
    from pyarrow import fs

    from .elias_fano import Trie
    store, root = fs.FileSystem.from_uri(folder)
    path = _place(root, shard)
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with (pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)) as f:
        return Trie.load(f.read_buffer())


def score(chunks: DataFrame, model: Model, answers: DataFrame) -> DataFrame:
    """(rid, doc_id, held_out, n_tokens, n_known, base_score, score) of every document of ``chunks``;
    ``answers``: a table of ``fit_and_answer``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    types = answers.where("chunk is null").groupBy("id").agg(F.sum("types").alias("types")).collect()      # at most HOT rows
    hot_g2 = {r["id"]: int(code_of(np.array([model.discount * r["types"] / model.totals[r["id"]]]))[0]) for r in types}
    hot_ids = np.array(sorted(hot_g2), np.int64)
    hot_codes = np.array([hot_g2[x] for x in sorted(hot_g2)], np.uint16)

    def add_up(t: pa.Table) -> pa.Table:
        mine = pc.is_null(t.column("shard"))
        got, own = t.filter(pc.invert(mine)), t.filter(mine)
        row = row_of(own.combine_chunks().to_batches()[0], 0)
        c = Chunk(row, model.texts)
        shard = shard_of(c.u, c.v, model.hot, model.shards)
        first, inverse, _ = distinct(shard, c.u, c.v, c.w)
        order = np.argsort(got.column("shard").to_numpy())
        raw = got.column("found").to_pylist()
        codes = np.concatenate([stretch(raw[i]).reshape(4, -1) for i in order] or [np.zeros((4, 0), np.uint16)], axis=1)
        codes = codes[:, inverse]
        if len(hot_ids):                        # words whose followers lie in several shards
            at = np.minimum(np.searchsorted(hot_ids, c.u), len(hot_ids) - 1)
            codes[0] = np.where(hot_ids[at] == c.u, hot_codes[at], codes[0])
        each = np.full((4, len(c.x) + 2), NONE, np.uint16)              # two places ahead: nothing is known before a piece
        each[:, c.at + 2] = codes
        n = len(c.x)
        g2, a2 = each[0, 1:n + 1].copy(), each[1, 1:n + 1].copy()       # of the window that begins one token earlier
        g3, a3 = each[2, :n].copy(), each[3, :n].copy()                 # and of the one two tokens earlier
        g3[c.inside < 2], a3[c.inside < 2] = NONE, NONE
        base = (c.c + 0.1) / (model.tokens + 0.1 * (model.words + 1))
        p = value_of(a3, 0.0) + value_of(g3, 1.0) * (value_of(a2, 0.0) + value_of(g2, 1.0) * base)
        piece = np.repeat(np.arange(len(c.size)), c.size)[c.owned]
        sums = [np.bincount(piece, x[c.owned], len(c.size)) for x in (np.ones(n), c.c > 0, np.log10(base), np.log10(p))]
        return pa.table({"rid": pa.array(row["rid"], pa.int64()), "doc_id": own.combine_chunks().column("doc_id").chunk(0)[0].values, "held_out": pa.array(row["held_out"], pa.bool_()),
                         "n_tokens": pa.array(sums[0].astype(np.int64)), "n_known": pa.array(sums[1].astype(np.int64)),
                         "base_score": pa.array(sums[2]), "score": pa.array(sums[3])})

    got = answers.where("chunk is not null").select("chunk", "shard", "found")
    parts = chunks.unionByName(got, allowMissingColumns=True).groupBy("chunk").applyInArrow(
        add_up, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    sums = [F.sum(k).alias(k) for k in ("n_tokens", "n_known", "base_score", "score")]
    return parts.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *sums)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", discount: float = DISCOUNT,
                    folder: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document; all others than ``held_out`` train the model.
    The model's tries stay in ``folder``; without one they are deleted when all windows are answered."""
    scratch = Scratch(docs.sparkSession, "lm-texts")
    raw = scratch.keep(encode(docs, F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), held_out))
    pieces = raw.select(F.explode(F.arrays_zip("ahead", "held_out")).alias("e"))
    n_train = pieces.where("e.ahead = 0 and not e.held_out").count()
    tokens = (raw.agg(F.sum("tokens")).first()[0] or 0) + n_train
    answers = scratch.keep(count_words(raw, tokens))
    scratch.drop()
    chunks = scratch.keep(with_ids(raw, answers))
    scratch.drop(raw)
    model = plan(docs.sparkSession, answers, tokens, n_train, discount, folder)
    scratch.drop(answers)
    found = scratch.keep(fit_and_answer(chunks, model))
    scratch.drop(*[] if folder else [model.folder])
    scored = scratch.keep(score(chunks, model, found))
    scratch.drop(chunks, found)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of nine tenths of them."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return score_documents(table(spark, sf_dir, "documents"), held_out)
