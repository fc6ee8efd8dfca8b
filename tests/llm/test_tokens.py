"""Operators 1, 3 and 10 against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from offerlens.llm import sentencepiece_codec as codec
from offerlens.llm import token_counts, token_records
from offerlens.llm.common import SLICE, SLICE_BYTES, slices, table, tokenizer_path
from offerlens.llm.crc32c import crc32c, masked
from offerlens.llm.wfst import Machine, Model
from offerlens.session import scratch_path

MODEL = tokenizer_path(codec.MODEL)
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ALPHABET = "abcdeéñ ▁  \n\tthe0123<s>ingon漢字ß\x00😀"


def random_texts(n, size=40, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_machine_equals_library():
    m = Machine(Model.load(MODEL))
    for t in random_texts(1500):
        want = SP.encode(t)
        assert m.path(codec.normalise(m, t)) == want
        assert m.count(codec.normalise(m, t)) == len(want)


def test_machine_forgets_without_changing():
    m = Machine(Model.load(MODEL))
    m.MAX_STATES = 20
    for t in random_texts(200, seed=2):
        assert m.path(codec.normalise(m, t)) == SP.encode(t)


def test_unigram_path_has_the_best_score():
    """The same pieces read as a unigram model: the path's score equals a plain dynamic program's."""
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"]
    scores = [0.0, -2.0, -3.0, -3.5, -4.0, -4.2, -5.0, -6.1, -5.5]
    m = Machine(Model(pieces, scores, [False] + [True] * 8, [], 0, "unigram", True, [False] * 9))
    rng = random.Random(3)
    for _ in range(300):
        t = "▁" + "".join(rng.choice("ab▁c") for _ in range(rng.randint(0, 12)))
        best = [0.0]
        for end in range(1, len(t) + 1):
            options = [best[end - n] - scores[m.ids[t[end - n:end]]] for n in range(1, 4) if end >= n and t[end - n:end] in m.ids]
            if t[end - 1] not in m.ids:
                options.append(best[end - 1] + 10.0 + 6.1)
            best.append(min(options))
        got = sum(16.1 if i == 0 else -scores[i] for i in m.path(t))
        assert abs(got - best[-1]) < 1e-9


def test_encode_and_decode(spark, edge_docs, empty_docs):
    docs = edge_docs.withColumn("ids", F.lit("clash"))
    rows = codec.decode(codec.encode(docs, MODEL), MODEL).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert list(r.ids) == SP.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert r.decoded == SP.decode(list(r.ids))
    out = codec.encode(empty_docs, MODEL)
    assert out.columns == [*empty_docs.columns, "ids"] and out.count() == 0
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert codec.decode(none, MODEL).first().decoded is None
    assert codec.decode_ids(MODEL, [4, 3 + 0xE9]) == SP.decode([4, 3 + 0xE9])


@pytest.mark.parametrize("chunk", [3, 50, 1 << 15])
def test_counts_for_any_chunks(spark, edge_docs, empty_docs, chunk):
    docs = (edge_docs if chunk > 3 else edge_docs.where("n_chars < 1000 or n_chars is null")).withColumn("n_tokens", F.lit("clash"))
    rows = token_counts.count_tokens(docs.withColumn("copy", F.col("text")), MODEL, chunk_chars=chunk).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_tokens, r.n_bytes) == (len(SP.encode(r.copy or "")), len((r.copy or "").encode()))
    assert token_counts.count_tokens(empty_docs, MODEL, chunk_chars=chunk).count() == 0


def test_chunk_maps_compose_associatively():
    for t in random_texts(60, 60, seed=4):
        parts = [token_counts.chunk_map(MODEL, t[i:i + 5]) for i in range(0, len(t), 5)] or [token_counts.chunk_map(MODEL, "")]
        left = parts[0]
        for p in parts[1:]:
            left = token_counts.compose(MODEL, left, p)
        right = parts[-1]
        for p in parts[-2::-1]:
            right = token_counts.compose(MODEL, p, right)
        assert left == right
        assert token_counts.apply_maps(MODEL, parts) == len(SP.encode(t))


def test_checksums():
    assert crc32c([b"123456789"])[0] == 0xE3069283

    def slow(b):
        c = 0xFFFFFFFF
        for x in b:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    rng = np.random.default_rng(0)
    strings = [rng.bytes(n) for n in (0, 1, 7, 1023, 1024, 1025, 4000)]
    assert crc32c(strings).tolist() == [slow(s) for s in strings]
    got = token_records.unframe(token_records.frames(strings))
    assert got == strings
    damaged = bytearray(token_records.frames([b"abcdef"])[0])
    damaged[13] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe([bytes(damaged)])
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def test_word_encoder_equals_library():
    rng = random.Random(5)
    bits = ["a", "foo", "foo,", "b.", "1,", "é.", " ", "  ", "\n", "\t", "'s", "12", "<|endoftext|>", "漢", "\u2003", "!!", "\x1c", "..", "\u3000x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    texts += [" ".join(rng.choice(["the,", "and.", "Of", "U.S.", "x,", "3.", "l'é,"]) for _ in range(8)) for _ in range(500)]
    path = tokenizer_path(token_records.VOCABULARY)
    e = token_records.WordEncoder(path)
    t = Tokenizer.from_file(path)
    for k in range(0, len(texts), 700):
        for text, got in zip(texts[k:k + 700], e.encode(texts[k:k + 700])):
            assert np.frombuffer(got, e.dtype).tolist() == t.encode(text, add_special_tokens=False).ids


def test_records_round_trip(spark, edge_docs, empty_docs):
    t = Tokenizer.from_file(tokenizer_path(token_records.VOCABULARY))
    folder = scratch_path(spark, "test-records")
    index = token_records.write_records(edge_docs, folder, tokenizer_path(token_records.VOCABULARY))
    back = token_records.with_start(token_records.read_records(index, folder)).collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0, tuple(t.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in edge_docs.collect()))
    got = sorted((r.doc_id is not None, r.doc_id or 0, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in back)
    assert got == want
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    shuffled = token_records.read_records(index.orderBy(F.rand(3)), folder).collect()
    assert sorted(zlib.crc32(r.ids) for r in shuffled) == sorted(zlib.crc32(r.ids) for r in back)
    empty = scratch_path(spark, "test-records-empty")
    assert token_records.read_records(token_records.write_records(empty_docs, empty, tokenizer_path(token_records.VOCABULARY)), empty).count() == 0


def test_one_pass_equals_two_and_query_equals_library(spark, sf):
    """Every document of a given table: the query's columns against the library, and the one pass against two."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    one = {r.doc_id: r for r in codec.encode_decode(docs, MODEL).collect()}
    two = {r.doc_id: r for r in codec.decode(codec.encode(docs, MODEL), MODEL).collect()}
    assert one == two
    rows = [(r.doc_id, len((r.text or "").encode()), SP.encode(r.text or "")) for r in docs.collect()]
    want = spark.createDataFrame(rows, "doc_id long, n_bytes long, ids array<int>")
    want = want.select("doc_id", "n_bytes", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"))
    got = codec.op1_sentencepiece(spark, sf)
    assert got.where("not round_trip").isEmpty()
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_slices_are_bounded_by_bytes():
    import pyarrow as pa
    texts = ["a" * SLICE_BYTES * 2, None, "", "b" * (SLICE_BYTES - 1), "cd"] + ["e"] * (2 * SLICE)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(0)
    parts = [s.column("t").to_pylist() for s in slices(batch, "t")]
    assert sum(parts, []) == texts and max(map(len, parts)) <= SLICE
    assert all(len(p) == 1 or sum(len(x or "") for x in p) <= SLICE_BYTES for p in parts)
    assert [p for s in slices(batch.slice(3, 5), "t") for p in s.column("t").to_pylist()] == texts[3:8]
    assert not list(slices(batch.slice(0, 0), "t"))
