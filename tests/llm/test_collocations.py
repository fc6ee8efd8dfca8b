"""Operator 11 against brute force (its SQL is compared in test_pipeline)."""

import collections
import re

import numpy as np
import pytest

from offerlens.llm import collocations as co


def brute(rows, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            n[lang] += len(words)
            for m in range(1, 6):
                f[lang].update(words[i:i + m] for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        many = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in many.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in many.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def rows(rng):
    words = ["a", "b", "The", "the", "é", "漢", "x\x00", "\x1c", "9"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "]) for _ in range(n))
    out = [(text(rng.randint(0, 60)), rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    return out + [(None, "en"), ("", None), (" \t ", "en"), (". , \n", "de"), ("a b " * 400, "en"), ("a b c d e f " * 20, "fr")] + [("same old words here", "es")] * 7


@pytest.mark.parametrize("chunk,bits,hot", [(10, 64, 3), (3_000_000, 1 << 20, 1000)])
def test_against_brute_force(spark, rng, monkeypatch, chunk, bits, hot):
    for name, value in (("MIN_COUNT", 4), ("CHUNK", chunk), ("FILTER_BITS", bits), ("HOT", hot), ("BLOCK", 40 if chunk == 10 else 4 << 20), ("RANKED_AT_ONCE", chunk), ("BUCKET", 50)):
        monkeypatch.setattr(co, name, value)
    data = rows(rng)
    frame = spark.createDataFrame([(t, x, "clash", 1) for t, x in data], "text string, lang string, phrase string, n int").repartition(3)
    got = co.collocations(frame, top=9)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(data, 4, 9)


def test_nothing_to_find(spark, empty_docs, edge_docs):
    assert co.collocations(empty_docs).count() == 0
    assert co.collocations(edge_docs.where("doc_id <> 4")).count() == 0


def test_blocks_keep_words(rng):
    for text in ("", "word", "x" * 100, "a  b\tc " * 30, "long" * 20 + " tail " + "y" * 50 + " z", " " * 70):
        parts = list(co.blocks(text, 16))
        assert b"".join(parts) == text.encode() and [w for p in parts for w in co.split(p)] == co.split(text.encode())


def test_filter_lets_every_phrase_through(spark):
    phrases = [("en", f"w{i} w{i + 1}") for i in range(500)]
    for bits in (64, 1 << 13):
        co_bits, co.FILTER_BITS = co.FILTER_BITS, bits
        made = co.frequent_filter(spark.createDataFrame(phrases, "lang string, phrase string"), len(phrases))
        co.FILTER_BITS = co_bits
        assert len(made) <= bits // 64
        own = [co.longer(*(np.array([co.word_hash(x, w)], np.uint64) for w in p.encode().split())) for x, p in phrases]
        assert co.passes(made, np.concatenate(own)).all()
        if bits > 64:
            other = np.array([co.word_hash("xx", b"%d" % i) for i in range(2000)], np.uint64)
            assert co.passes(made, other).mean() < 0.1
