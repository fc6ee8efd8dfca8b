"""SentencePiece encoding and decoding (operator 1).

``encode`` composes every text with the transducer of ``wfst`` and reads the
tropical shortest path.  A piece of a model never holds a space behind another
character, and a line break is no part of any piece, so the lattice of a text
is a chain of sub-lattices between those places; each sub-lattice (a segment)
is solved alone and frequent ones are kept in a bounded table per worker.

Defined results: a null or empty text gives no ids; the whole text is encoded
however long it is; equal rows give equal ids; an empty table gives an empty
table; an input column named like an output column is replaced by it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import add_columns, null_free, slices, table, tokenizer_path, without
from .wfst import SPACE, Machine, Model, machine

MODEL = "piece_bpe_32k.model"
#: Segments whose paths a worker keeps.
KEPT = 200_000


def segment_pattern(m: Machine) -> re.Pattern:
    """Segments of a normalised text: a run of spaces and what follows it, or a line break."""
    if any(SPACE in p.lstrip(SPACE) for p in m.ids) or any("\n" in p and len(p) > 1 for p in m.ids):
        return re.compile(r"(?s).+")     # pieces may cross: the text is one segment
    return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def normalise(m: Machine, text: str) -> str:
    if not text:
        return ""
    return ((" " if m.model.dummy_prefix else "") + text).replace(" ", SPACE)


class Paths(dict):
    """Segment -> its ids as 32-bit machine integers; missing ones are solved by the machine."""

    def __init__(self, m: Machine):
        super().__init__()
        self.machine = m

    def __missing__(self, segment: str) -> bytes:
        ids = array("i", self.machine.path(segment)).tobytes()
        if len(self) >= KEPT:
            self.clear()    # frequent segments come back first
        self[segment] = ids
        return ids


_PATHS: dict[str, tuple[Machine, re.Pattern, Paths]] = {}


def _paths(path: str):
    if path not in _PATHS:
        m = machine(path)
        _PATHS[path] = m, segment_pattern(m), Paths(m)
    return _PATHS[path]


def encode_text(path: str, text: str | None):
    """Ids of one text as a numpy array."""
    import numpy as np
    m, segments, paths = _paths(path)
    return np.frombuffer(b"".join(map(paths.__getitem__, segments.findall(normalise(m, text or "")))), dtype=np.int32)


def encode_texts(path: str, texts: list):
    """Ids of the texts as one Arrow array of lists."""
    import numpy as np
    import pyarrow as pa
    ids = [encode_text(path, t) for t in texts]
    ends = np.cumsum([0] + [len(i) for i in ids], dtype=np.int32)
    values = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids_col`` (array of int)."""
    fields = StructType([StructField(ids_col, ArrayType(IntegerType(), False))])
    return add_columns(docs, fields, text_col, lambda texts: [encode_texts(model_path, texts)])


_SURFACES: dict[str, tuple[list[bytes], bool]] = {}


def decode_ids(path: str, ids) -> str:
    """Text of a list of ids: bytes that are no UTF-8 become U+FFFD, control pieces vanish.  Reads the model
    file only; no machine is compiled for it."""
    if path not in _SURFACES:
        m = Model.load(path)
        byte = {i: b for b, i in enumerate(m.byte_ids)}
        _SURFACES[path] = [bytes([byte[i]]) if i in byte else " ⁇ ".encode() if i == m.unk_id else b"" if m.control[i]
                           else p.replace(SPACE, " ").encode() for i, p in enumerate(m.pieces)], m.dummy_prefix
    surfaces, dummy_prefix = _SURFACES[path]
    text = b"".join(map(surfaces.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if dummy_prefix and text[:1] == " " else text


def decode_lists(path: str, ids) -> list:
    """Texts of an Arrow array of lists of ids, one list at a time; null ids give null."""
    return [None if i.values is None else decode_ids(path, i.values.to_numpy(zero_copy_only=False).tolist()) for i in ids]


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the decoded text; null ids give null."""
    import pyarrow as pa

    base = without(df, [out_col])
    names = [*base.columns, out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, ids_col):
                texts = pa.array(decode_lists(model_path, b.column(ids_col)), pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, texts], names=names)

    return base.mapInArrow(run, StructType(base.schema.fields + [StructField(out_col, StringType())]))


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
                  out_col: str = "decoded") -> DataFrame:
    """``decode(encode(docs))`` in one pass: one Python worker a task instead of two."""
    fields = StructType([StructField(ids_col, ArrayType(IntegerType(), False)), StructField(out_col, StringType())])

    def run(texts: list) -> list:
        ids = encode_texts(model_path, texts)
        return [ids, decode_lists(model_path, ids)]

    return add_columns(docs, fields, text_col, run)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: number and hash of the ids, and whether the text came back.
    (A literal U+2581 is a space to the model and comes back as one.)"""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path(MODEL)
    out = encode_decode(docs, path)
    return out.select("doc_id", F.octet_length(null_free(F.col("text"))).cast("long").alias("n_bytes"),
                      F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
                      (F.col("decoded") == F.translate(null_free(F.col("text")), SPACE, " ")).alias("round_trip"))


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with their ids and the check of the round trip, without the text."""
    path = tokenizer_path(MODEL)
    out = encode_decode(docs, path)
    same = F.col("decoded") == F.translate(null_free(F.col("text")), SPACE, " ")
    return without(out.withColumn("round_trip", same).withColumn("n_ids", F.size("ids").cast("long")), ["text", "decoded"])
