"""Operators 6 and 8."""

import math
import zlib

from pyspark.sql import functions as F

from offerlens.llm import toxicity, url_filter
from offerlens.session import materialize


def test_held_out_rule(spark):
    rows = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def planted(spark, rng, n=1200):
    """Documents of invented words; toxic ones hold marked words, in two families."""
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.15
        if toxic:
            marks = rng.sample(["zorgot", "quixba", "vexxor"], rng.randint(1, 3)) if i % 2 else [f"bwq{rng.choice(['an', 'el', 'is', 'ot'])}{k}x" for k in "ab"]
            for m in marks:
                words.insert(rng.randint(0, len(words)), m.upper() if rng.random() < 0.2 else m)
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(toxic)))
    truth = {i: t for i, t in labels}
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (10 ** 9, 1), (5, None)], "doc_id long, toxic int"), truth


def test_toxicity_held_out_accuracy(spark, rng):
    docs, labels, truth = planted(spark, rng)
    rows = toxicity.score(docs, labels).withColumn("h", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.h and r.doc_id in truth]
    right = sum((r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in held)
    assert len(held) > 100 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(spark, rng):
    docs, labels, _ = planted(spark, rng, 500)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in toxicity.score(docs, turned).collect()}
    assert one == two


def test_toxicity_edges(spark, edge_docs, empty_docs, rng):
    docs, labels, _ = planted(spark, rng, 400)
    both = docs.union(edge_docs.select("doc_id", "text"))
    rows = toxicity.score(both, labels).collect()
    assert len(rows) == both.count()
    none = labels.limit(0)
    assert len({round(r.score, 6) for r in toxicity.score(edge_docs, none).collect()}) == 1
    assert toxicity.score(empty_docs, labels).count() == 0


def test_label_model_separates():
    p = toxicity.Posterior(0.1, [0, 0, 2], [0.5, 0.5, 0.0], [0.6, 0.6, 0.3], [1e-4, 1e-4, 0.2])
    assert p([]) < 0.1 < 0.9 < p([0]) < p([0, 1]) <= 1
    assert p([2]) < 0.3


def test_linear_fit_has_zero_gradient(rng):
    rows = [(sorted(rng.sample(range(6), rng.randint(0, 4))), rng.random()) for _ in range(300)]
    w, b = toxicity.fit_linear(rows, 6, 0.2)
    grad = [sum(1 / (1 + math.exp(-b - sum(w[j] for j in h))) - y for h, y in rows if k in h) + w[k] for k in range(6)]
    assert max(map(abs, grad)) < 1e-2


URLS = [
    (1, "https://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    (2, "http://Example.NET/de/", "example.net", "/de/", "net/", "block"),
    (3, "http://example.com/de/x?q#f", "example.com", "/de/x", "example.com/de/", "block"),
    (4, "http://m.org/fr/y#t", "m.org", "/fr/y", "org/fr/", "allow"),
    (5, "http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    (6, "http://b.net?x=1", "b.net", "", None, None),
    (7, "http://net/", "net", "/", "net/", "block"),
    (8, "no scheme", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "x://y.org/FR/", "y.org", "/FR/", None, None),
    (11, "", "", "", None, None),
    (12, "a://b://c.net/en/", "b:", "//c.net/en/", None, None),
    (13, "http://c.net#/en/", "c.net", "", None, None),
    (13, "http://c.net#/en/", "c.net", "", None, None),
    (14, "http://ÀB.Org/fr/" + "z" * 50_000, "Àb.org", "/fr/" + "z" * 50_000, "org/fr/", "allow"),
    (None, "http://example.com/en/", "example.com", "/en/", None, None),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "<p>the other tion here</p><script>x()</script>") for i, u, *_ in URLS], "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    got = url_filter.judge(pages).collect()
    assert len(got) == len(URLS)
    by = {(r.page_id, r.host, r.path): r for r in got}
    for i, _, host, path, rule, verdict in URLS:
        r = by[i, host, path]
        assert r.rule == rule and (r.verdict == verdict if verdict else r.verdict in ("allow", "block"))
    assert url_filter.judge(pages.limit(0)).count() == 0


def brute_segment(label, cost, unknown):
    if not label:
        return 0.0, []
    options = []
    for n in range(1, min(len(label), url_filter.LONGEST) + 1):
        c, rest = brute_segment(label[n:], cost, unknown)
        options.append((cost.get(label[:n], unknown + n * math.log(10)) + c, [label[:n], *rest]))
    return min(options, key=lambda x: x[0])


def test_segment_is_cheapest(rng):
    cost = {"the": 1.0, "re": 2.0, "there": 3.5, "her": 2.5, "t": 4.0, "e": 4.0, "tion": 1.5, "on": 2.0}
    for _ in range(60):
        label = "".join(rng.choice(["the", "re", "t", "on", "x", "tion"]) for _ in range(rng.randint(0, 4)))[:11]
        words = url_filter.segment(label, cost, 9.0)
        assert "".join(words) == label
        got = sum(cost.get(w, 9.0 + len(w) * math.log(10)) for w in words)
        assert abs(got - brute_segment(label, cost, 9.0)[0]) < 1e-9


def test_every_word_is_in_the_model(spark):
    """More distinct words than the model once kept, the rare ones and one of more than 24 letters in a host."""
    letters = "abcdefghij"
    common = " ".join(w for k in range(31_000) for w in ["".join(letters[int(c)] for c in f"{k:05d}")] * 2)
    long_word = "donaudampfschifffahrtsgesellschaft"
    pages = spark.createDataFrame([(1, "http://www.example.org/", common), (2, "http://x.org/", f"zebrafish kettle {long_word}")], "page_id long, url string, html string")
    words = materialize(url_filter.unigrams(pages), "unigrams-test")
    assert words.count() == 31_003
    labels = spark.createDataFrame([("zebrafishkettle",), (long_word + "kettle",), ("kettlequvwxyz",), ("q" * 90,)], "label string")
    got = {r.label: r.words for r in url_filter.segments(labels, words).collect()}
    assert got == {"zebrafishkettle": ["zebrafish", "kettle"], long_word + "kettle": [long_word, "kettle"],
                   "kettlequvwxyz": ["kettle", "quvwxyz"], "q" * 90: ["q" * 90]}


def test_segments_equal_whole_model(spark, sf, rng):
    words = materialize(url_filter.unigrams(spark.read.parquet(f"{sf}/pages.parquet")), "unigrams-whole")
    n = {r.word: r.n for r in words.collect()}
    total = sum(n.values())
    some = rng.sample(sorted(n), 60)
    labels = sorted({"".join(rng.choices([*some, "xq"], k=k)) for k in (1, 2, 3, 4, 5) for _ in range(12)})
    got = {r.label: r.words for r in url_filter.segments(spark.createDataFrame([(x,) for x in labels], "label string"), words).collect()}
    cost = {w: math.log(total / k) for w, k in n.items()}
    assert got == {x: url_filter.segment(x, cost, math.log(total) + math.log(10)) for x in labels}


def test_hosts_of_any_script(spark):
    """Only the part of the host outside a-z tells blocked from allowed ones."""
    blocked, allowed = ["новости", "bücher24"], ["погода", "bäcker"]
    rows = [(f"http://{h}.net/x", "block") for h in blocked] * 6 + [(f"http://{h}.org/fr/x", "allow") for h in allowed] * 6
    rows += [(f"http://{h}.de/x", "block") for h in blocked] + [(f"http://{h}.de/x", "allow") for h in allowed]
    text = "<p>" + " ".join([*blocked, *allowed, "net", "org", "de"] * 3) + "</p>"
    pages = spark.createDataFrame([(i, u, text) for i, (u, _) in enumerate(rows)], "page_id long, url string, html string")
    assert {r.word for r in url_filter.unigrams(pages).collect()} == {"новости", "bücher0", "погода", "bäcker", "net", "org", "de"}
    got = {r.page_id: r.verdict for r in url_filter.judge(pages).collect()}
    assert got == {i: v for i, (_, v) in enumerate(rows)}


def test_verdicts_equal_plain_naive_bayes(spark, sf):
    """All verdicts again from the tokens, in plain Python."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = url_filter.judge(pages).collect()
    words = {r.word: r.n for r in url_filter.unigrams(pages).collect()}
    total = sum(words.values())
    cost, unknown = {w: math.log(total / n) for w, n in words.items()}, math.log(total) + math.log(10)
    import re

    def tokens(r):
        host = [f"host:{w}" for lab in re.split("[^a-z]+", r.host) if lab for w in url_filter.segment(lab, cost, unknown)]
        return host + [f"path:{t}" for t in re.split(r"[^a-zà-ÿ0]+", re.sub("[0-9]+", "0", r.path.lower())) if t]

    count = {"block": {}, "allow": {}}
    n = {"block": 0, "allow": 0}
    for r in rows:
        if r.rule:
            n[r.verdict] += 1
            for t in tokens(r):
                for c in count:
                    count[c].setdefault(t, 0)
                count[r.verdict][t] += 1
    kinds = len(count["block"])
    sums = {c: sum(v.values()) for c, v in count.items()}
    for r in rows:
        if not r.rule:
            s = math.log((n["block"] + 1) / (n["allow"] + 1))
            for t in tokens(r):
                s += math.log((count["block"].get(t, 0) + 1) / (sums["block"] + kinds + 1)) - math.log((count["allow"].get(t, 0) + 1) / (sums["allow"] + kinds + 1))
            assert r.verdict == ("block" if s > 1e-9 else "allow")
