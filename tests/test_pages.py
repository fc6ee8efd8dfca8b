"""Pages are parsed once, and the parser's output travels in bounded batches."""

import re

import pandas as pd
import pytest

from offerlens.sources import html


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parser_hands_on_bounded_batches():
    page = "<body>" + "<div><p>a</p></div>" * 40 + "</body>"
    batch = pd.DataFrame({"page_id": list(range(500)), "html": [page] * 499 + [None]})
    out = list(html._blocks_fn(None)(iter([batch])))
    assert sum(len(b) for b in out) == 499 * 81
    assert max(len(b) for b in out) <= html.OUT_ROWS + 81


@pytest.mark.parametrize("name", ["page_cards", "page_sections", "page_description_collected", "category_match", "fill_defaults"])
def test_pages_are_parsed_once(spark, sf, name):
    from offerlens.plans.catalog import QUERIES
    assert "MapInPandas" not in _plan(QUERIES[name](spark, sf))      # reads the table of blocks


def test_page_text_rules_parse_once(spark, sf):
    from offerlens.plans.catalog import QUERIES
    for name in ("page_main_text", "page_text_fallback", "page_fields"):
        assert len(re.findall("MapInPandas", _plan(QUERIES[name](spark, sf)))) == 1, name


PLAIN = ["<html><head><title>T &amp; t</title></head><body><nav><a href='/x?a=1&amp;b' title=\"q'r\">un</a></nav><p class=\"a  b\">deux<br>trois"
         " <b>quatre</b></p><hr><main><h2>Cinq</h2><input disabled></main></body></html>",
         "<!DOCTYPE html><DIV ID='cookie-x'>a<div/>b</div><!-- c -->d<template><p>e</p>f</template></i>g<style>p {}</style>", "", "texte &lt; seul"]
ODD = ["<p>a < b</p>", "<a href=x>y</a>", "<script>if (a<b) c()</script><p>d", "<!-- a <b> --><p>c</p>", "<p a=\"x>y\">z</p>", "<noscript><p>a</p></noscript>"]


def _rows(page, columns=tuple(html._COLS)):
    frames = html._blocks_fn(None, columns)(iter([pd.DataFrame({"page_id": [1], "html": [page]})]))
    return [tuple(r) for f in frames for r in f.itertuples(index=False, name=None)]


def test_plain_pages_give_the_rows_of_the_full_parser(monkeypatch):
    got = [_rows(p) for p in PLAIN]
    monkeypatch.setattr(html, "_plain", lambda page, to: False)
    assert got == [_rows(p) for p in PLAIN]


def test_plain_pages_do_not_pass_the_full_parser(monkeypatch):
    asked = []
    monkeypatch.setattr(html._Parser, "feed", lambda self, page: asked.append(page))
    for p in PLAIN + ODD:
        _rows(p)
    assert asked == ODD


def test_only_named_columns_are_made():
    page = PLAIN[0]
    whole = [dict(zip(html._COLS, r)) for r in _rows(page)]
    assert _rows(page, ("page_id", "tag", "href")) == [(r["page_id"], r["tag"], r["href"]) for r in whole]
    assert [p for p, h in _rows(page, ("pos", "holds_heading")) if h] == [r["parent"] for r in whole if r["tag"] == "h2"]


@pytest.mark.parametrize("rule,keep,columns", [
    ("sections", "section_blocks", ["page_id", "pos", "parent", "tag", "sibling", "rendered", "holds_heading"]),
    ("collected_description", "collected_blocks",
     ["page_id", "pos", "parent", "tag", "cls", "data_testid", "sibling", "rendered", "holds_heading"]),
    ("page_cards", "card_blocks", ["page_id", "pos", "tag", "cls", "data_testid", "href", "ancestors"])])
def test_rules_read_few_blocks(spark, rule, keep, columns):
    """The blocks that a rule can read give the rows of all blocks, and are fewer."""
    from offerlens.operators import pages as P
    cards = "<div class='job-card'>c</div>" * 6
    filler = "<ul><li>x</li><li>y</li></ul>" * 5
    side = f"<p>{'long texte ' * 8}</p>"
    bodies = [cards + filler, f"<div class='tw-group'><div><a href='/fr-fr/emplois/1.html'>o</a></div></div>{filler}", "<a href='/fr-fr/emplois/2.html'>o</a>",
              f"<div><div><h2>Profil</h2></div>{side}<p>court</p>{side}</div>{filler}", f"<h3>Mission</h3>{side}", f"<main>{filler}{'z ' * 150}</main>",
              f"<div class='content'>{'mot ' * 40}</div>{filler}", filler]
    pages = spark.createDataFrame([(i, f"<body>{b}</body>") for i, b in enumerate(bodies)], "page_id BIGINT, html STRING")
    blocks = html.page_blocks(pages)
    few = html.page_blocks(pages, columns=columns).where(getattr(P, keep)())
    f = getattr(P, rule)
    assert sorted(map(repr, f(few).collect())) == sorted(map(repr, f(blocks).collect())) and f(few).count() > 0
    assert few.count() < blocks.count() / 2


def test_short_elements_that_no_rule_reads_are_not_handed_on():
    page = f"<body><ul><li>a</li><li>b</li></ul><div><h2>c</h2></div><p>{'d ' * 40}</p><p>court</p></body>"
    whole = [dict(zip(html._COLS, r)) for r in _rows(page)]
    frames = html._blocks_fn(frozenset({"h2"}), ("page_id", "pos", "rendered"), 50)(iter([pd.DataFrame({"page_id": [1], "html": [page]})]))
    got = [tuple(r) for f in frames for r in f.itertuples(index=False, name=None)]
    need = [r for r in whole if r["pos"] == 1 or r["tag"] in ("h2", "div") or len(r["rendered"]) > 50]
    assert got == [(1, r["pos"], r["rendered"]) for r in need] and len(got) == 4


def test_columns_of_the_tag_alone_build_no_tree(monkeypatch):
    columns = ("page_id", "pos", "tag", "cls", "elem_id", "data_cy", "data_testid", "href", "title_attr")
    pages = PLAIN + ODD + ["<a data-cy='offerTitle' href='/x'>y</a><a>z</a>"]
    want = [[r[:2] + r[4:11] for r in _rows(p)] for p in pages]
    monkeypatch.setattr(html, "_Elements", None)
    assert [_rows(p, columns) for p in pages] == want
    batch = pd.DataFrame({"page_id": [1], "html": [pages[-1]]})
    marked = list(html._blocks_fn(frozenset({"a"}), ("page_id", "href"), attrs=("data-cy",))(iter([batch])))
    assert [list(f["href"]) for f in marked] == [["/x"]]


def test_texts_of_unread_tags_are_not_made():
    batch = pd.DataFrame({"page_id": [1], "html": ["<div>a<span>b</span></div>"]})
    shown = {"text": {"div"}, "rendered": {"span"}}
    f = pd.concat(html._blocks_fn(None, ("page_id", "tag", "text", "rendered"), shown_of=shown)(iter([batch])))
    assert f[["tag", "text", "rendered"]].values.tolist() == [["div", "a\nb", None], ["span", None, "b"]]


TOGETHER = ["page_cards", "page_offers", "page_sections", "page_text_fallback", "page_description_collected", "category_match", "fill_defaults",
            "page_detail_offers"]


@pytest.mark.parametrize("name", TOGETHER)
def test_a_page_stays_in_its_row(spark, sf, name):
    """Pages are dealt out before they are made; no rule joins or sorts them, or writes them as a table, afterwards."""
    from offerlens.plans.catalog import QUERIES
    plan = str(_plan(QUERIES[name](spark, sf)))
    pages = plan[:re.search("MapInArrow|MapInPandas", plan).start()]
    assert "Join" not in pages and "Window" not in pages
    assert len(re.findall("Exchange", pages)) == (1 if name in ("page_offers", "category_match") else 0)


def test_elements_of_pages_equal_blocks(spark, monkeypatch):
    monkeypatch.setattr(html, "OUT_ROWS", 7)
    pages = [(1, PLAIN[0]), (1, PLAIN[1]), (2, None), (3, ""), (4, ODD[3]), (4, ODD[3]), (4, None), (None, None), (None, PLAIN[0])]
    df = spark.createDataFrame([(k, f"u{i}", p) for i, (k, p) in enumerate(pages)], "page_id long, url string, html string").coalesce(1)
    columns = ["pos", "parent", "tag", "cls", "href", "noise", "text", "ancestors", "sibling", "rendered"]
    for frames in (False, True):
        got = html.page_elements(df, columns, carry="url", frames=frames).collect()
        assert [r.page_id for r in got] == [1, 2, 3, 4, None]
        assert [r.copies for r in got] == [["u0", "u1"], ["u2"], ["u3"], ["u4", "u5", "u6"], ["u7", "u8"]]
        for r in got:
            want = [row for k, p in pages if k == r.page_id for row in _rows(p, tuple(columns))]
            assert [tuple(e) for e in r.els] == want


def test_cards_with_equal_page_ids_are_one_page(spark):
    from offerlens.operators import pages as P
    card = '<div class="{c}"><a href="/fr-fr/emplois/{n}.html"><h3><p>T{n}</p><p>C</p></h3></a><div class="tw-typo-s-bold">1 €</div></div>'
    page = "<body>" + "".join(card.format(c="job-card", n=n) for n in range(3)) + '<div class="tw-group">' + card.format(c="x", n=9) + "</div></body>"
    df = spark.createDataFrame([(1, page), (1, page), (2, page)], "page_id long, html string").coalesce(1)
    blocks = html.page_blocks(df)
    rows = html.page_elements(df, [c for c in html._COLS if c != "page_id"])
    cards, in_row = P.page_cards(blocks), P.page_cards(rows)
    got = sorted(tuple(r) for r in cards.collect())
    assert got == sorted((r.page_id, *c) for r in in_row.collect() for c in r._cards)
    assert {c for c in got if c[0] == 1} == {(1, 3, p) for p in (2, 8, 14)} and len([c for c in got if c[0] == 1]) == 6
    assert [c[:2] for c in got if c[0] == 2] == [(2, 0)] * 4
    fields = sorted(P.card_fields(blocks, cards).drop("tags").collect(), key=str)
    assert fields == sorted(P.card_fields(rows, in_row).drop("tags").collect(), key=str)
    # a link that is no group's own card holds the heading alone
    want = [("T0", "C", None), ("T1", "C", None), ("T2", "C", None), ("T9", "C", "1 €")]
    assert sorted((r.title_p, r.company_p, r.salary) for r in fields if r.page_id == 2) == want
