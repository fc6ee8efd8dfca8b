"""Token counts by finite-state tokenizer compilation (operator 10).

The tokenizer of a SentencePiece file is compiled into the deterministic
transducer of ``wfst``, whose transitions carry the change of the token count.
Texts are cut into chunks; the transducer turns a chunk into a map from its
entry state to (exit state, tokens).  Behind the first place where the machine
is back in its start state whatever came before (a space after another
character, a line break) all values of a map agree, so a map is held as

* ``head``: characters before that place, to be run from the entry state,
* ``mid``: tokens between the first and the last such place,
* ``tail``: characters after the last one, which stand for the exit state.

A chunk without such a place is ``open``: all of it is ``head``.  Maps compose
associatively; a text's maps are combined pairwise in a scan of logarithmic
depth.  Chunks are spread over tasks as rows of their own, and only their maps
are shuffled.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each for itself; texts of any length are counted whole; an empty
table gives an empty table; output columns replace input columns of the same
name; the text column is not carried to the output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import null_free, table, tokenizer_path, without
from .sentencepiece_codec import segment_pattern
from .wfst import SPACE, Machine, machine

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 15
#: Segments whose counts a worker keeps.
KEPT = 400_000


class Counts(dict):
    """Segment -> token count; missing ones are run through the transducer."""

    def __init__(self, m: Machine):
        super().__init__()
        self.machine = m

    def __missing__(self, segment: str) -> int:
        n = self.machine.count(segment)
        if len(self) < KEPT:
            self[segment] = n
        return n


_COUNTS: dict[str, tuple[Machine, re.Pattern, Counts]] = {}


def _counts(path: str):
    if path not in _COUNTS:
        m = machine(path)
        _COUNTS[path] = m, segment_pattern(m), Counts(m)
    return _COUNTS[path]


def chunk_map(path: str, chunk: str) -> tuple[bool, str, int, str]:
    """The chunk's map: (open, head, mid, tail)."""
    _, segments, counts = _counts(path)
    parts = segments.findall(chunk.replace(" ", SPACE))
    if len(parts) < 2:
        return True, "".join(parts), 0, ""
    return False, parts[0], sum(map(counts.__getitem__, parts[1:-1])), parts[-1]


def compose(path: str, a: tuple, b: tuple) -> tuple[bool, str, int, str]:
    """The map of two neighbouring stretches of text."""
    if a[0]:
        return b[0], a[1] + b[1], b[2], b[3]
    if b[0]:
        return False, a[1], a[2], a[3] + b[1]
    _, segments, counts = _counts(path)
    return False, a[1], a[2] + b[2] + sum(map(counts.__getitem__, segments.findall(a[3] + b[1]))), b[3]


def apply_maps(path: str, maps: list[tuple]) -> int:
    """Tokens of a text from its chunks' maps, in order, run from the start state."""
    m, segments, counts = _counts(path)
    if all(x[0] and not x[1] for x in maps):
        return 0
    if m.model.dummy_prefix:
        maps = [(True, SPACE, 0, ""), *maps]
    while len(maps) > 1:
        maps = [compose(path, *maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    _, head, mid, tail = maps[0]
    return mid + sum(map(counts.__getitem__, segments.findall(head))) + sum(map(counts.__getitem__, segments.findall(tail)))


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text", chunk_chars: int = CHUNK) -> DataFrame:
    """``docs`` without its text, with n_bytes and n_tokens (long)."""
    import pyarrow as pa

    text = null_free(F.col(f"`{text_col}`"))
    kept = without(docs, [text_col, "n_bytes", "n_tokens"])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text.alias("text"),
                       F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept.columns]).alias("rest"))
    cut = F.expr(f"transform(sequence(0L, greatest(length(text) - 1L, 0L) div {chunk_chars}), "
                 f"k -> substring(text, int(k * {chunk_chars} + 1), {chunk_chars}))")
    chunks = rows.select("row", "rest", F.posexplode(cut).alias("k", "chunk"))
    chunks = chunks.select("row", "k", F.when(F.col("k") == 0, F.col("rest")).alias("rest"), "chunk",
                           F.octet_length("chunk").cast("long").alias("n_bytes"))

    def to_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [chunk_map(model_path, c) for c in b.column("chunk").to_pylist()]
            cols = [pa.array([x[i] for x in made], t) for i, t in enumerate((pa.bool_(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in ("row", "k", "rest", "n_bytes")] + cols,
                                             names=["row", "k", "rest", "n_bytes", "open", "head", "mid", "tail"])

    rest = chunks.schema["rest"].dataType.simpleString()
    maps = chunks.mapInArrow(to_maps, f"row long, k int, rest {rest}, n_bytes long, open boolean, head string, mid long, tail string")
    whole = maps.groupBy("row").agg(
        F.first("rest", ignorenulls=True).alias("rest"), F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("k", "open", "head", "mid", "tail"))).alias("maps"))

    def to_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [apply_maps(model_path, [(x["open"], x["head"], x["mid"], x["tail"]) for x in xs]) for xs in b.column("maps").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rest"), b.column("n_bytes"), pa.array(n, pa.int64())], names=["rest", "n_bytes", "n_tokens"])

    out = whole.mapInArrow(to_counts, f"rest {rest}, n_bytes long, n_tokens long")
    return out.select(*[F.col(f"rest.`{c}`").alias(c) for c in kept.columns], "n_bytes", "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under piece_bpe_32k.model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, tokenizer_path(MODEL))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
