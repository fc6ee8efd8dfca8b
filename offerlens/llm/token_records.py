"""Token ids as length-delimited binary records (operator 3).

A file holds frames: payload length (8 bytes), masked CRC-32C of those 8
bytes, the payload, masked CRC-32C of the payload, all little-endian.  A
payload is one document's ids, 2 bytes each where all ids fit, else 4.
Files hold contiguous ranges of the order (doc_id, hash of the text) and are
numbered along it.  Beside them an index table has a row per record (part,
place in the file, length, ids before it in its file), so that records can be
read in any order.  A file is written under an attempt's own name and renamed,
so a task that runs again replaces it by equal bytes.

Defined results: a null or empty text is a record of the end id alone; null
ids come first; repeated rows are records of their own, equal ones next to
each other; texts are encoded whole; an empty table gives no file and an
empty index; extra columns are not written.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import null_free, table, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
HEAD, FOOT = 12, 4
INDEX = "part int, doc_id long, at long, length long, width int, n_tokens long, before long"
#: Documents tokenised, and bytes read, at once.
DOCS_AT_ONCE, READ_AT_ONCE = 512, 8 << 20
#: Word pieces whose ids a worker keeps.
KEPT = 700_000


class WordEncoder:
    """Ids of texts by the tokenizers library; words met before are looked up.

    The vocabulary's pattern never joins a white-space character with what
    stands before it, nor letters with a comma or full stop behind them.  So a
    text whose words have one space or line break between them is the sequence
    of its words, each with the separator in front of it, and a word with such
    a mark behind its letters is the word and the mark.  Other texts, and those
    with the special string, are encoded in one piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        import numpy as np
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.kind = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.marks = dict(zip(",.\n", self._bytes([",", ".", "\n"])))
        self.model = self.tokenizer.model
        # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}
        self.space = chr(self.alphabet[32])
        self.known: dict[str, bytes] = {}

    def _bytes(self, strings: list[str]) -> list[bytes]:
        kind = self.kind
        return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _letters(self, word: str, space: str = "") -> bytes:
        """Ids of letters with at most a space in front: one piece of the pattern, so the model alone decides."""
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        return array(self.kind, [t.id for t in self.model.tokenize(space + mapped)]).tobytes()

    def _words(self, text: str) -> list[str] | None:
        """Words behind the first with the line break before them, if any; None for texts to encode in one piece."""
        words, between = text.split(), text.count(" ") + text.count("\n")
        if len(words) != between + 1 or sum(map(len, words)) + between != len(text) or any(s in text for s in self.special):
            return None
        return text.replace("\n", " \n").split(" ")

    def _learn(self, new: set[str]) -> None:
        known, marked = self.known, []
        for w in [w for w in new if w[-1] in ",." and w[-2:-1].isalpha()]:
            new.discard(w)
            marked.append(w)
            if w[:-1] not in known:
                new.add(w[:-1])
        listed = []
        for w in new:
            if w.isalpha():
                known[w] = self._letters(w, self.space)
            elif w[0] == "\n" and w[1:].isalpha():
                known[w] = self.marks["\n"] + self._letters(w[1:])
            else:
                listed.append(w)
        known.update(zip(listed, self._bytes([w if w[0] == "\n" else " " + w for w in listed])))
        known.update((w, known[w[:-1]] + self.marks[w[-1]]) for w in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT:
            self.known.clear()
        cut = [self._words(t) for t in texts]
        self._learn(set().union(*[c[1:] for c in cut if c]).difference(self.known))
        heads = iter(self._bytes([t if c is None else c[0] for t, c in zip(texts, cut)]))
        return [next(heads) + b"".join(map(self.known.__getitem__, c[1:] if c else ())) for c in cut]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload in its frame."""
    from .crc32c import crc32c, masked
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    sums = masked(crc32c(lengths + payloads)).astype("<u4")
    n = len(payloads)
    return [b"".join((a, sums[i].tobytes(), p, sums[n + i].tobytes())) for i, (a, p) in enumerate(zip(lengths, payloads))]


def unframe(chunks: list[bytes]) -> list[bytes]:
    """Payloads of whole frames; a wrong length or checksum raises."""
    from .crc32c import crc32c, masked
    payloads = [c[HEAD:-FOOT] for c in chunks]
    sums = masked(crc32c([c[:8] for c in chunks] + payloads)).astype("<u4")
    n = len(chunks)
    for i, (c, p) in enumerate(zip(chunks, payloads)):
        if int.from_bytes(c[:8], "little") != len(p) or c[8:HEAD] != sums[i].tobytes() or c[-FOOT:] != sums[n + i].tobytes():
            raise ValueError("a record is damaged")
    return payloads


def _place(folder: str, part: int) -> str:
    return f"{folder}/part-{part:06d}.rec"


def write_records(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Write the files to ``folder`` (a URI all executors see) and the index beside them; returns the index."""
    import pyarrow as pa

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), null_free(F.col(f"`{text_col}`")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(F.col("doc_id"), F.col("h")).sortWithinPartitions("doc_id", "h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyarrow import fs
        from pyspark import TaskContext
        task = TaskContext.get()
        part, at, before, out = task.partitionId(), 0, 0, None
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        store, root = fs.FileSystem.from_uri(folder)
        own = f"{_place(root, part)}.{task.taskAttemptId()}"
        for b in batches:
            for k in range(0, b.num_rows, DOCS_AT_ONCE):
                s = b.slice(k, DOCS_AT_ONCE)
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(own)
                made = frames([p + end for p in enc.encode(s.column("text").to_pylist())])
                out.write(b"".join(made))
                size = np.array([len(x) for x in made], np.int64)
                n = (size - HEAD - FOOT) // enc.dtype.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(size), part, np.int32)), s.column("doc_id"), pa.array(at + np.cumsum(size) - size), pa.array(size),
                     pa.array(np.full(len(size), enc.dtype.itemsize, np.int32)), pa.array(n), pa.array(before + np.cumsum(n) - n)],
                    names=["part", "doc_id", "at", "length", "width", "n_tokens", "before"])
                at, before = at + int(size.sum()), before + int(n.sum())
        if out is not None:
            out.close()
            store.move(own, _place(root, part))

    index = f"{folder}/index"
    ordered.mapInArrow(write, INDEX).write.parquet(index)
    return docs.sparkSession.read.schema(INDEX).parquet(index)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``index`` (any of its rows, in any order) with the column ids (binary, 4 bytes each, little-endian)."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, StructField, StructType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            part, at, length, width = (b.column(n).to_numpy() for n in ("part", "at", "length", "width"))
            order = np.lexsort((at, part))
            k = 0
            while k < len(order):           # neighbours in a file are read together
                i = order[k]
                stop, end = k + 1, at[i] + length[i]
                while stop < len(order) and part[order[stop]] == part[i] and at[order[stop]] == end and end - at[i] < READ_AT_ONCE:
                    end += length[order[stop]]
                    stop += 1
                with store.open_input_file(_place(root, int(part[i]))) as f:
                    f.seek(int(at[i]))
                    raw = f.read(int(end - at[i]))
                got = order[k:stop]
                chunks = [raw[at[j] - at[i]:at[j] - at[i] + length[j]] for j in got]
                ids = [np.frombuffer(p, f"<u{width[j]}").astype("<u4").tobytes() for j, p in zip(got, unframe(chunks))]
                rows = b.take(pa.array(got))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.binary())], names=[*b.schema.names, "ids"])
                k = stop

    return index.mapInArrow(read, StructType(index.schema.fields + [StructField("ids", BinaryType())]))


def with_start(index: DataFrame) -> DataFrame:
    """``index`` with start: ids of all records before it. One row per file is summed up, not one per record."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return index.join(parts, "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as records and read back."""
    folder = scratch_path(spark, "token-records")
    index = write_records(table(spark, sf_dir, "documents"), folder, tokenizer_path(VOCABULARY))
    back = read_records(index, folder)
    return with_start(back.select("part", "doc_id", "before", "n_tokens", F.octet_length("ids").alias("b"), F.crc32("ids").alias("ids_crc32"))) \
        .select("doc_id", "start", "n_tokens", "ids_crc32")
