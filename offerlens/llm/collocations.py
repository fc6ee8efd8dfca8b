"""Phrase collocations by stripes (operator 11).

A stripe is an associative counter: a prefix of k words keys the words that
follow it and how often.  Level k counts the stripes of prefixes of k words
inside chunks of the corpus (the empty prefix at level 0), and merges the
chunks' stripes elementwise after a shuffle by prefix.  A merged stripe holds
the extensions (phrases of k + 1 words), of which the largest is the most
frequent longer phrase that begins with the prefix; a prefix's total is its
entry in the stripe of one word less.

A phrase that occurs ``MIN_COUNT`` times is made of parts that do, so level k
only counts prefixes and next words that level k - 1 found frequent.  The
frequent phrases of a level reach the tasks as a Bloom filter of at most
``FILTER_BITS`` bits; what it lets through wrongly is counted exactly and
falls to ``MIN_COUNT``, so its size never changes a result.  From level 2 on
the texts are cut down to their runs of frequent word pairs.

A stripe of a very frequent prefix is cut by the hash of the next word: prefixes with at least a thousandth of
all words (a thousand at most, therefore) are known from the level before, and no piece of theirs has more than
about a thousandth of the words.  Stripes travel in blocks: all that one chunk has for one bucket of prefixes.

Defined results: a null text is empty, a null language is ``und``; repeated
rows count as often as they occur; a separator inside a word ends the piece;
texts of any length are read in blocks; an empty table gives an empty table;
other columns are not carried.  Products are decimals of 38 digits: 1000 a n below 10^38.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, null_free, table

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
#: Characters that end a piece; words are runs of anything but space and tab.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: Bytes of text split at once, and words whose stripes are merged before they leave a task.
BLOCK, CHUNK = 4 << 20, 1_000_000
#: Words of the corpus for each bucket of prefixes.
BUCKET = 1_000_000
FILTER_BITS, PROBES = 1 << 29, 4
#: Blocks of stripes that are made at once.
BLOCKS_AT_ONCE = 16
HOT = 1000
MIX = 0x9E3779B97F4A7C15
#: Candidates that one task ranks before the languages' lists are merged.
RANKED_AT_ONCE = 50_000


def blocks(text: str | None, size: int = BLOCK) -> Iterator[bytes]:
    """The lower-cased text (A-Z) in blocks that end where a word ends."""
    raw = (text or "").encode().lower()
    at = 0
    while len(raw) - at > size:
        cut = max(raw.rfind(b" ", at, at + size), raw.rfind(b"\t", at, at + size))
        if cut <= at:
            ahead = [x for x in (raw.find(b" ", at + size), raw.find(b"\t", at + size)) if x >= 0]
            if not ahead:
                break
            cut = min(ahead)
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def split(block: bytes) -> list[bytes]:
    """Words, with a full stop (which is never part of a word) where a piece ends."""
    return block.translate(bytes.maketrans(SEPARATORS, b"." * len(SEPARATORS))).replace(b".", b" . ").split()


@cache
def seed_of(lang: str) -> int:
    import xxhash
    return xxhash.xxh32_intdigest(lang.encode())


def word_hash(lang: str, word: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(word, seed=seed_of(lang))


def longer(h, next_):
    """Hashes of phrases with one more word; numpy uint64, modulo 2^64."""
    import numpy as np
    return (h ^ (h >> np.uint64(29))) * np.uint64(MIX) + next_


def probes(h, bits: int):
    """Bit numbers of hashes in a filter of ``bits`` (a power of two) bits."""
    import numpy as np
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [(h + np.uint64(k) * step * np.uint64(MIX) >> np.uint64(7)) & np.uint64(bits - 1) for k in range(PROBES)]


def passes(filter_, h):
    """Which hashes the filter (64-bit words) lets through."""
    import numpy as np
    out = np.ones(len(h), bool)
    for p in probes(h, 64 * len(filter_)):
        out &= (filter_[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


class Stripes:
    """Counts the stripes of prefixes of ``k`` words in the texts it is given."""

    def __init__(self, k: int, filters: list, hot: tuple, buckets: int):
        self.k, self.filters, self.hot, self.buckets = k, filters, hot, buckets
        self.carry: list = []
        self.clear()

    def clear(self) -> None:
        """Forget the words; the last ``k`` codes, whose next word is not known yet, are named anew."""
        import numpy as np
        kept = np.concatenate(self.carry)[-self.k:] if self.carry and self.k else np.zeros(0, np.int64)
        names = [self.names[c] if c >= 0 else None for c in kept] if len(kept) else []
        self.codes: dict = {}
        self.names: list = []
        self.hashes: list = []
        self.carry = [np.array([self.code(*x) if x else -1 for x in names], np.int64)]
        self.size = 0

    def code(self, lang: str, word: bytes) -> int:
        got = self.codes.setdefault((lang, word), len(self.names))
        if got == len(self.names):
            self.names.append((lang, word))
            self.hashes.append(word_hash(lang, word))
        return got

    def add(self, tokens: list[bytes], langs: list[str], counts: list[int]) -> None:
        """Tokens of consecutive blocks: ``counts`` tokens of each of ``langs``."""
        if tokens:
            self.carry.append(self.encode(tokens, langs, counts))
            self.size += len(tokens)

    def encode(self, tokens: list[bytes], langs: list[str], counts: list[int]):
        """Codes of the tokens; -1 where a piece ends and, above level 0, for words that are not frequent."""
        import numpy as np
        import pyarrow as pa
        encoded = pa.array(tokens, pa.binary()).dictionary_encode()
        words = encoded.dictionary.to_pylist()
        distinct = sorted(set(langs))
        number = {x: i for i, x in enumerate(distinct)}
        pair = encoded.indices.to_numpy().astype(np.int64) + np.repeat([number[x] * len(words) for x in langs], counts)
        seen = np.zeros(len(distinct) * len(words), bool)
        seen[pair] = True
        present = np.flatnonzero(seen)
        if b"." in words:
            present = present[present % len(words) != words.index(b".")]
        keys = [(distinct[i], words[j]) for i, j in zip((present // len(words)).tolist(), (present % len(words)).tolist())]
        h = [word_hash(*x) for x in keys]
        if self.k:
            good = passes(self.filters[0], np.array(h, np.uint64))
            present, keep = present[good], good.tolist()
            h, keys = [x for x, ok in zip(h, keep) if ok], [x for x, ok in zip(keys, keep) if ok]
        place = np.full(len(seen), -1, np.int64)
        known = len(self.codes)
        place[present] = codes = [self.codes.setdefault(x, len(self.codes)) for x in keys]
        fresh = [i for i, x in enumerate(codes) if x >= known]
        self.names += [keys[i] for i in fresh]
        self.hashes += [h[i] for i in fresh]
        return place[pair]

    def frequent(self, c):
        """(ok, hash): which places of the codes begin a frequent phrase of ``k`` words, and the phrases' hashes."""
        import numpy as np
        h = np.array(self.hashes, np.uint64)
        ok, grams = c >= 0, h[c]
        for j in range(1, self.k):
            ok = ok[:-1] & ok[1:]
            at = np.flatnonzero(ok)
            grams = longer(grams[:len(ok)], h[c[j:]])
            ok[at] = passes(self.filters[j], grams[at])
        return ok, grams

    def flush(self, last: bool = False):
        """Arrow batches of the stripes counted so far, in blocks: bucket, lang, prefix, next, n (lists)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        c, k = np.concatenate(self.carry), self.k
        at = np.zeros(0, np.int64)
        if self.names and len(c) > k:
            ok, grams = self.frequent(c)
            at = np.flatnonzero(ok[:-1] & ok[1:] if k else ok)      # a phrase and the one that begins a word later
        if not len(at):
            self.clear()
            return
        h = np.array(self.hashes, np.uint64)
        langs = sorted({x[0] for x in self.names})
        number = {x: i for i, x in enumerate(langs)}
        lang_of = np.array([number[x[0]] for x in self.names], np.int64)
        prefix, next_ = c[at] if k else lang_of[c[at]], c[at + k]
        for j in range(1, k):
            prefix = np.unique(prefix << 32 | c[at + j], return_inverse=True)[1]
        entry, example, count = np.unique(prefix.astype(np.int64) << 32 | next_, return_index=True, return_counts=True)
        next_, example = entry & 0xFFFFFFFF, at[example]
        own = grams[example] if k else np.array([word_hash(x, b"") for x in langs], np.uint64)[lang_of[c[example]]]
        hot, pieces = self.hot
        where = np.minimum(np.searchsorted(hot, own), max(len(hot) - 1, 0))
        salts = np.full(len(own), HOT, np.uint64) if not k else np.where(hot[where] == own, pieces[where], np.uint64(1)) if len(hot) else np.ones(len(own), np.uint64)
        bucket = longer(own, (h[next_] >> np.uint64(11)) % salts) >> np.uint64(20)
        bucket = (bucket % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, next_, example, count = (x[order] for x in (bucket, next_, example, count))
        start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        stop = np.r_[start[1:], len(bucket)]
        words = pa.array([x[1] for x in self.names], pa.binary()).cast(pa.string())
        for i in range(0, len(start), BLOCKS_AT_ONCE):
            some = slice(start[i], stop[i:i + BLOCKS_AT_ONCE][-1])
            lists = pa.array(np.r_[start[i:i + BLOCKS_AT_ONCE], some.stop].astype(np.int32) - np.int32(some.start))
            parts = [words.take(pa.array(c[example[some] + j])) for j in range(k)]
            text = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0] if k else pa.array([""] * len(example[some]))
            columns = [pa.array(langs, pa.string()).take(pa.array(lang_of[c[example[some]]])), text, words.take(pa.array(next_[some])), pa.array(count[some].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[start[i:i + BLOCKS_AT_ONCE]]), *(pa.ListArray.from_arrays(lists, x) for x in columns)],
                                             names=["bucket", "lang", "prefix", "next", "n"])
        if not last:
            self.clear()
        pa.default_memory_pool().release_unused()


def slices(batches) -> Iterator[tuple[list, list, list, bool]]:
    """Tokens of about ``BLOCK`` bytes of consecutive texts, the language and number of the tokens of each block, and
    whether the last document ends with them."""
    tokens: list[bytes] = []
    langs: list[str] = []
    counts: list[int] = []
    held = 0
    for b in batches:
        for i in range(b.num_rows):
            lang = b.column("lang")[i].as_py()
            for block in blocks(b.column("text")[i].as_py()):
                if held > BLOCK:
                    yield tokens, langs, counts, tokens[-1:] == [b"."]
                    tokens, langs, counts, held = [], [], [], 0
                found = split(block)
                tokens += found
                langs.append(lang)
                counts.append(len(found))
                held += len(block)
            tokens.append(b".")
            langs.append(lang)
            counts.append(1)
    yield tokens, langs, counts, True


def stripes(docs: DataFrame, k: int, filters: list, hot: tuple, buckets: int) -> DataFrame:
    """Merged stripes (lang, prefix, next, n) of prefixes of ``k`` words, without entries below ``MIN_COUNT``; at level 0
    an entry with a null next word has what all these amount to."""
    import pyarrow as pa
    share = docs.sparkSession.sparkContext.broadcast((filters, hot))
    chunk = CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Stripes(k, *share.value, buckets)
        for tokens, langs, counts, _ in slices(batches):
            made.add(tokens, langs, counts)
            if made.size > chunk:
                yield from made.flush()
        yield from made.flush(last=True)

    raw = docs.mapInArrow(count, "bucket long, lang array<string>, prefix array<string>, next array<string>, n array<long>")
    each = raw.repartition("bucket").select("bucket", F.explode(F.arrays_zip("lang", "prefix", "next", "n")).alias("e")).select("bucket", "e.*")
    each = each.groupBy("bucket", "lang", "prefix", "next").agg(F.sum("n").alias("n"))
    if k:
        return each.where(F.col("n") >= MIN_COUNT).drop("bucket")
    kept = F.when(F.col("n") >= MIN_COUNT, F.col("next"))
    return each.groupBy("bucket", "lang", "prefix", kept.alias("next")).agg(F.sum("n").alias("n")).drop("bucket")


def frequent_runs(docs: DataFrame, filters: list) -> DataFrame:
    """(lang, text): the texts cut down to their runs of frequent word pairs, each run a piece."""
    import pyarrow as pa
    share = docs.sparkSession.sparkContext.broadcast(filters)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        open_: list[bytes] = []                 # of a document that goes on: the run that may go on with it
        lang = ""
        for tokens, langs, counts, ends in slices(batches):
            if open_:
                tokens, langs, counts = open_ + tokens, [lang] + langs, [len(open_)] + counts
            if not tokens:
                continue
            made = Stripes(2, share.value, ((), ()), 1)
            c = made.encode(tokens, langs, counts)
            pair = made.frequent(c)[0] if made.names and len(c) > 1 else np.zeros(len(c) - 1, bool)
            lang, open_, stop = langs[-1], [], len(c)
            if not ends:
                stop = int(np.flatnonzero(~pair)[-1]) + 1 if not pair.all() else 0
                open_ = tokens[stop:]
            goes_on = np.r_[pair, False][:stop]
            inside = np.flatnonzero(goes_on | np.r_[False, pair][:stop])
            number = {x: i for i, x in enumerate(sorted(set(langs)))}
            own = np.repeat([number[x] for x in langs], counts)[inside]
            for name, i in number.items():
                here = inside[own == i]
                if len(here):
                    text = b" ".join([tokens[j] if more else tokens[j] + b"." for j, more in zip(here.tolist(), goes_on[here].tolist())])
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text.decode()])], names=["lang", "text"])

    return docs.mapInArrow(cut, "lang string, text string")


def frequent_filter(phrases: DataFrame, count: int):
    """The Bloom filter of the phrases' hashes as 64-bit words, of at most ``FILTER_BITS`` bits."""
    import numpy as np
    import pyarrow as pa
    bits = 64
    while bits < min(FILTER_BITS, 16 * count):
        bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.zeros(b.num_rows, np.uint64)
            for i, (lang, phrase) in enumerate(zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist())):
                words = np.array([word_hash(lang, w) for w in phrase.encode().split(b" ")], np.uint64)[:, None]
                own = words[0]
                for w in words[1:]:
                    own = longer(own, w)
                h[i] = own[0]
            p = np.concatenate(probes(h, bits)) if len(h) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))],
                                             names=["slot", "bit"])

    words = phrases.select("lang", "phrase").mapInArrow(places, "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("slot").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return out


def hot_prefixes(phrases: DataFrame, total: int) -> tuple:
    """Sorted hashes of the phrases with a share of 1 / ``HOT`` of all words (at most so many) and the pieces of their stripes."""
    import numpy as np
    rows = phrases.where(F.col("f") * HOT >= total).collect() if total else []
    found = {}
    for r in rows:
        own = None
        for w in r["phrase"].encode().split(b" "):
            x = np.array([word_hash(r["lang"], w)], np.uint64)
            own = x if own is None else longer(own, x)
        found[int(own[0])] = -(-r["f"] * HOT // total)
    order = sorted(found)
    return np.array(order, np.uint64), np.array([found[x] for x in order], np.uint64)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    docs = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), null_free(F.col(f"`{text_col}`")).alias("text"))
    filters: list = []
    hot: tuple = ((), ())
    levels: list[DataFrame] = []
    total = 0
    for k in range(LONGEST):
        if k == 2:
            docs = scratch.keep(frequent_runs(docs, filters))
        made = scratch.keep(stripes(docs, k, filters, hot, total // BUCKET + 1 if k else HOT))
        if k == 0:
            total = made.agg(F.sum("n")).first()[0] or 0
        phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
        levels.append(made.select("lang", "prefix", phrase.alias("phrase"), F.col("n").alias("f")))
        found = levels[-1].where("phrase is not null")
        n_found = found.count()
        if not n_found or k == LONGEST - 1:
            break
        filters.append(frequent_filter(found, n_found))
        hot = hot_prefixes(found, total)

    words = levels[0].groupBy("lang").agg(F.sum("f").alias("n"))
    entries = levels[0]
    for x in levels[1:]:
        entries = entries.unionByName(x)
    entries = entries.where("phrase is not null")
    found = entries.where("prefix <> ''").select("lang", "phrase", F.col("f").alias("a"))
    extended = entries.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("f").alias("extended"))
    totals_ = entries.select("lang", "phrase", "f")

    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    before = found.groupBy("lang", tail.alias("phrase")).agg(F.max("a").alias("preceded"))
    whole = found.join(extended, ["lang", "phrase"], "left").join(before, ["lang", "phrase"], "left")
    free = whole.where((F.coalesce("extended", F.lit(0)) < F.col("a")) & (F.coalesce("preceded", F.lit(0)) < F.col("a"))).select("lang", "phrase", "a")
    parts = free.withColumn("words", F.split("phrase", " "))
    parts = parts.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    parts = parts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
                         F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("rest"))
    parts = parts.join(totals_.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    parts = parts.join(totals_.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(words, "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    least = F.min(F.struct(score.cast("long").alias("score"), "cut", "l", "r")).alias("x")
    scored = scratch.keep(parts.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score"))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # a language's list is ranked in parts first, so that no task sorts all of its phrases
    parts = scored.count() // RANKED_AT_ONCE + 1
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    near = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    out = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS m FROM i),
f AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 100),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * k.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1:k.k], ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1:], ' ') JOIN n ON n.lang = k.lang
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k.k) = 1),
d AS (
  SELECT DISTINCT s.lang, s.phrase FROM s JOIN c ON c.lang = s.lang AND len(c.phrase) > len(s.phrase) AND 100 * c.a >= 100 * s.a
    AND strpos(' ' || c.phrase || ' ', ' ' || s.phrase || ' ') > 0),
o AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM s ANTI JOIN d USING (lang, phrase))
SELECT * FROM o WHERE rank <= 2000
"""
