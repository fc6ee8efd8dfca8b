"""Elias-Fano sequences and the n-gram trie of operator 12, as flat arrays that can be memory-mapped.

A sequence of n growing numbers below m keeps the lower log2(m / n) bits of each
packed side by side, and the upper bits in unary: about 2 + log2(m / n) bits a
number.  All queries are for whole arrays of positions or values at once.

The trie has three levels: words u, the words v that follow u, and the words w
that follow (u, v).  The children of all nodes of a level stand in one
sequence, made monotone by adding to each child the last value before its
siblings; pointers to where siblings begin are a monotone sequence, too.  A
child is found by one successor search relative to its context: the value
before the siblings plus the child's id.
"""

from __future__ import annotations

import json

import numpy as np

ONE = np.uint64(1)
_EACH_BYTE, _TOP_BITS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: The place of the k-th one in a byte.
_PLACE = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bits of each value side by side in 64-bit words (one spare word behind)."""
    out = np.zeros(-(-len(values) * width // 64) * 8 + 8, np.uint8)
    step = 1 << 16
    for s in range(0, len(values) if width else 0, step):
        part = values[s:s + step].astype(np.uint64)
        bits = (part[:, None] >> np.arange(width, dtype=np.uint64) & ONE).astype(np.uint8)
        got = np.packbits(bits.ravel(), bitorder="little")
        out[s * width // 8:s * width // 8 + len(got)] = got
    return out.view(np.uint64)


def unpack(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.int64)
    bit = at.astype(np.int64) * width
    word, off = bit >> 6, (bit & 63).astype(np.uint64)
    high = np.where(off > 0, words[word + 1] << (np.uint64(64) - np.maximum(off, ONE)), np.uint64(0))
    return ((words[word] >> off | high) & np.uint64((1 << width) - 1)).astype(np.int64)


def in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each 64-bit word: counts of ones up to each byte side by side in a word, then a table."""
    upto = words - (words >> ONE & np.uint64(0x5555555555555555))
    upto = (upto & np.uint64(0x3333333333333333)) + (upto >> np.uint64(2) & np.uint64(0x3333333333333333))
    upto = (upto + (upto >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH_BYTE
    k = k.astype(np.uint64)
    byte = np.bitwise_count((k * _EACH_BYTE | _TOP_BITS) - upto & _TOP_BITS).astype(np.uint64) << np.uint64(3)
    left = k - (upto << np.uint64(8) >> byte & np.uint64(255))
    return byte.astype(np.int64) + _PLACE[(words >> byte & np.uint64(255)).astype(np.int64), left.astype(np.int64)]


#: Words of the upper bits whose ones are counted together.
COUNTED = 2


class EliasFano:
    """Numbers that do not fall: ``arrays`` holds all of it."""

    def __init__(self, arrays: dict, n: int, width: int):
        self.arrays, self.n, self.width = arrays, n, width
        self.low, self.high, self.ones = (arrays[k] for k in ("low", "high", "ones"))

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        place = (values >> width) + np.arange(n)
        bits = np.zeros(-(-(int(place[-1]) + 2 if n else 1) // (64 * COUNTED)) * 64 * COUNTED, np.uint8)
        bits[place] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)][::COUNTED].astype(np.uint32)
        return cls({"low": pack(values, width), "high": high, "ones": ones}, n, width)

    def _place(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one or zero among the upper bits."""
        before = self.ones.astype(np.int64)
        if not ones:
            before = np.arange(len(before), dtype=np.int64) * 64 * COUNTED - before
        word = np.searchsorted(before, k, side="right") - 1
        left = k - before[word]
        word, out, open_ = word * COUNTED, np.empty(len(k), np.int64), np.arange(len(k))
        for _ in range(COUNTED):
            bits = self.high[word] if ones else ~self.high[word]
            count = np.bitwise_count(bits).astype(np.int64)
            here = left < count
            out[open_[here]] = word[here] * 64 + in_word(bits[here], left[here])
            open_, word, left = open_[~here], word[~here] + 1, (left - count)[~here]
            if not len(open_):
                break
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at positions."""
        return (self._place(i, True) - i) << self.width | unpack(self.low, self.width, i)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have upper bits below ``high``: the zero before them closes the upper bits ``high - 1``."""
        zeros = 64 * len(self.high) - int(self.ones[-1])
        known = (high > 0) & (high <= zeros)
        out = np.where(high > 0, self.n, 0)
        out[known] = self._place(high[known] - 1, False) - high[known] + 1
        return out

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(successor, whether it is ``x``): only values with the upper bits of ``x`` are compared, so their lower bits tell."""
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        s, e = self._below(high), self._below(high + 1)
        got = self._least(s.copy(), e.copy(), low)
        same = np.flatnonzero(got < e)
        found = np.zeros(len(x), bool)
        found[same] = unpack(self.low, self.width, got[same]) == low[same]
        return got, found

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value that is not below ``x`` (n if there is none)."""
        return self.find(x)[0]

    def _least(self, s: np.ndarray, e: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The first position from ``s`` to ``e`` whose lower bits are not below ``low``."""
        while True:                                     # halves all open stretches at once
            open_ = np.flatnonzero(s < e)
            if not len(open_):
                return s
            mid = (s[open_] + e[open_]) // 2
            less = unpack(self.low, self.width, mid) < low[open_]
            s[open_] = np.where(less, mid + 1, s[open_])
            e[open_] = np.where(less, e[open_], mid)


class Siblings:
    """The children of all nodes of one level."""

    def __init__(self, values: EliasFano, starts: EliasFano):
        self.values, self.starts = values, starts

    @classmethod
    def build(cls, starts: np.ndarray, ids: np.ndarray) -> Siblings:
        """``starts``: where each parent's children begin, and the end; ``ids``: growing among siblings."""
        size = np.diff(starts)
        last = np.where(size > 0, ids[np.maximum(starts[1:] - 1, 0)] + 1, 0) if len(ids) else np.zeros(len(size), np.int64)
        base = np.r_[0, np.cumsum(last)[:-1]] if len(last) else last
        return cls(EliasFano.build(ids + np.repeat(base, size)), EliasFano.build(starts))

    def find(self, parent: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Position of each parent's child, -1 where there is none."""
        out = np.full(len(parent), -1, np.int64)
        there = np.flatnonzero(parent >= 0)
        if not len(there) or not self.values.n:
            return out
        parent, ids = parent[there], ids[there]
        new = np.r_[True, parent[1:] != parent[:-1]]    # neighbours with the same parent share its place
        own, asked = np.cumsum(new) - 1, parent[new]
        start, end = self.starts.at(asked), self.starts.at(asked + 1)
        base = np.where(start > 0, self.values.at(np.maximum(start - 1, 0)) + 1, 0)
        got, found = self.values.find(base[own] + ids)
        hit = np.flatnonzero(found & (got >= start[own]) & (got < end[own]))
        out[there[hit]] = got[hit]
        return out


class Trie:
    """Words, pairs and triples with codes of ``WIDTH`` bits: ``g2`` of words as contexts, ``a2`` and ``g3`` of pairs (as
    events and as contexts), ``a3`` of triples."""

    CODES = ("g2", "a2", "g3", "a3")
    WIDTH = 12

    def __init__(self, words: EliasFano, pairs: Siblings, triples: Siblings, codes: dict):
        self.words, self.pairs, self.triples, self.codes = words, pairs, triples, codes

    def find(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple:
        """Positions of the words u, the pairs and the triples; -1 where there is none."""
        if not len(u):
            return (np.zeros(0, np.int64),) * 3
        new_u = np.r_[True, u[1:] != u[:-1]]            # neighbours with the same word or pair are looked up once
        new_v = new_u | np.r_[True, v[1:] != v[:-1]]
        asked = u[new_u]
        first = self.words.successor(asked) if self.words.n else np.full(len(asked), 0)
        hit = np.flatnonzero(first < self.words.n)
        found = np.full(len(asked), -1, np.int64)
        hit = hit[self.words.at(first[hit]) == asked[hit]] if len(hit) else hit
        found[hit] = first[hit]
        word = found[np.cumsum(new_u) - 1]
        pair = self.pairs.find(word[new_v], v[new_v])[np.cumsum(new_v) - 1]
        return word, pair, self.triples.find(pair, w)

    def code(self, name: str, at: np.ndarray) -> np.ndarray:
        return unpack(self.codes[name], self.WIDTH, at)

    def dump(self) -> bytes:
        """One file: a header that names the arrays, then the arrays at places divisible by 64."""
        arrays, meta = {}, {}
        for name, seq in (("words", self.words), ("pairs", self.pairs.values), ("pair_starts", self.pairs.starts),
                          ("triples", self.triples.values), ("triple_starts", self.triples.starts)):
            meta[name] = (seq.n, seq.width)
            arrays |= {f"{name}.{k}": x for k, x in seq.arrays.items()}
        arrays |= self.codes
        parts, index, at = [], {}, 0
        for name, x in arrays.items():
            raw = np.ascontiguousarray(x).tobytes()
            index[name] = (x.dtype.str, at, len(x))
            parts.append(raw + b"\0" * (-len(raw) % 64))
            at += len(parts[-1])
        head = json.dumps({"sequences": meta, "arrays": index}).encode()
        head += b" " * (-(len(head) + 8) % 64)
        return len(head).to_bytes(8, "little") + head + b"".join(parts)

    @classmethod
    def load(cls, buffer) -> Trie:
        """The trie over a (memory-mapped) buffer: arrays are views, nothing is copied."""
        size = int.from_bytes(bytes(buffer[:8]), "little")
        head = json.loads(bytes(buffer[8:8 + size]))
        arrays = {k: np.frombuffer(buffer, np.dtype(d), n, 8 + size + at) for k, (d, at, n) in head["arrays"].items()}
        seq = {k: EliasFano({x: arrays[f"{k}.{x}"] for x in ("low", "high", "ones")}, n, width) for k, (n, width) in head["sequences"].items()}
        return cls(seq["words"], Siblings(seq["pairs"], seq["pair_starts"]), Siblings(seq["triples"], seq["triple_starts"]),
                   {k: arrays[k] for k in cls.CODES})
