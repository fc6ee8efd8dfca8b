"""Page rules over element blocks (``offerlens.sources.html.page_blocks``).

All selection happens with DataFrame operations: selector predicates are
column expressions, "first match" is ``min_by`` per page, "all matches in
order" is an ordered ``collect_list`` per page (a page's own elements only).

Rules that look at a page's elements together take them as one row per page
(``page_elements``): they are array expressions inside the row.  Handed blocks,
they gather a page's into such a row first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.operators.lines import BOILERPLATE, NO_DESCRIPTION, dedup_lines, remove_boilerplate
from offerlens.functions.text import ustrip
from offerlens.sources.html import HEADINGS, class_has, class_is

# Tags each rule reads (pass to ``page_blocks(pages, tags=...)``).
MAIN_TEXT_TAGS = {"div", "article", "section", "body"}
FIELD_TAGS = {"title", "h1", "a"}
FALLBACK_TAGS = {"main", "body"}

MIN_PART = 100
MIN_MAIN = 200
MIN_LINE = 30
MIN_SECTION = 50
MAX_SIBLINGS = 5
# Section heading keywords of the reference.
SECTION_WORDS = ["description", "mission", "profil", "compétence", "qualification", "responsabilité", "poste",
                 "offre"]


#: An element's columns by name: ``F.col`` for blocks, ``of(x)`` for an element of an array.
Element = Callable[[str], Column]


def of(x: Column) -> Element:
    return lambda name: x[name]


def paged(blocks: DataFrame) -> DataFrame:
    """(page_id, els, ...): blocks as one row per page, unless they are that already."""
    if "els" in blocks.columns:
        return blocks
    columns = [c for c in blocks.columns if c != "page_id"]
    return blocks.groupBy("page_id").agg(F.collect_list(F.struct(*columns)).alias("els"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once: a column of its own that is read inside a lambda alone is put into
    that lambda by Catalyst, and evaluated for every element."""
    return F.transform(F.array(value), use)[0]


def positions(cond: Callable[[Element], Column], els: str = "els") -> Column:
    """Positions of a page's elements for which ``cond`` holds."""
    return F.transform(F.filter(els, lambda x: cond(of(x))), lambda x: x["pos"])


def first_of(cond: Callable[[Element], Column], value: str, els: str = "els") -> Column:
    """``value`` of a page's first element (by position) for which ``cond`` holds."""
    return F.array_min(F.transform(F.filter(els, lambda x: cond(of(x))), lambda x: F.struct(x["pos"], x[value])))[value]


def _rows(page: DataFrame, array: Column) -> DataFrame:
    """(page_id, fields of ``array``'s structs): a row per struct."""
    # explode_outer: a plain explode makes Catalyst evaluate the array once more to test its size
    return page.select("page_id", F.explode_outer(array).alias("_r")).where(F.col("_r").isNotNull()).select("page_id", "_r.*")


def _tag(t: str, e: Element = F.col) -> Column:
    return e("tag") == F.lit(t)


def first_match_rules(e: Element = F.col) -> list[Column]:
    """Ordered selectors of the detail-page extractor (first match wins)."""
    return [
        _tag("div", e) & (e("data_cy") == F.lit("jobDescription")),
        _tag("article", e) & class_has(e("cls"), "job"),
        _tag("section", e) & class_has(e("cls"), "description"),
        _tag("div", e) & class_has(e("cls"), "job-description"),
        _tag("section", e) & e("in_main"),
    ]


def all_match_rules(e: Element = F.col) -> list[Column]:
    """Ordered selectors of the card collector (every match > 100 chars)."""
    return [
        _tag("div", e) & class_has(e("cls"), "description"),
        _tag("div", e) & class_has(e("cls"), "job-description"),
        _tag("section", e) & class_has(e("cls"), "description"),
        _tag("div", e) & class_has(e("data_testid"), "description"),
        _tag("article", e) & class_has(e("cls"), "description"),
        _tag("div", e) & class_is(e("cls"), "tw-prose"),
        _tag("div", e) & class_has(e("cls"), "content"),
    ]


def _priority(rules: list[Column]) -> Column:
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r, F.lit(i)) if out is None else out.when(r, F.lit(i))
    return out


def body_lines_text(text: Column, phrases: list[str] = BOILERPLATE) -> Column:
    """Whole-page fallback: stripped lines longer than 30 chars, without
    boilerplate phrases; kept when the result exceeds 100 chars."""
    low = lambda x: F.lower(x)
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda ln: ustrip(ln)),
                     lambda ln: (F.length(ln) > MIN_LINE) &
                     ~F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(low(ln), p)))
    res = F.array_join(lines, "\n")
    return F.when(F.length(res) > MIN_PART, res)


def _page_ids(blocks: DataFrame, pages: DataFrame | None) -> DataFrame:
    """Every page once: from the pages table when given (pages without any
    emitted element still get a row), else from the blocks."""
    return pages.select("page_id") if pages is not None else blocks.select("page_id").distinct()


def _first(cond: Column, value: str, name: str) -> Column:
    """Aggregate: ``value`` of a page's first element (by position) for which ``cond`` holds."""
    return F.min_by(value, F.when(cond, F.col("pos"))).alias(name)


def main_text(blocks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Detail-page description: first selector whose first element survives
    the boilerplate rules; else the body-lines fallback; else 'Non renseignée'.
    Noise elements (header/footer/nav, cookie/banner classes) are removed."""
    b = blocks.where(~F.col("noise")).withColumn("prio", _priority(first_match_rules()))
    rules = range(1, len(first_match_rules()) + 1)
    found = b.where(F.col("prio").isNotNull() | _tag("body")).groupBy("page_id").agg(*[_first(F.col("prio") == i, "text", f"rule_{i}") for i in rules],
                                     _first(_tag("body"), "text", "body_text"))
    return (_page_ids(blocks, pages).join(found, "page_id", "left")
            .select("page_id", F.coalesce(*[remove_boilerplate(F.col(f"rule_{i}")) for i in rules],
                                          body_lines_text(F.col("body_text")), F.lit(NO_DESCRIPTION)).alias("description")))


def _shown(text: str | Column = "rendered") -> Column:
    """``ustrip`` of a column, whose regular expression reads a whole text, where an end is white space at all."""
    t = F.col(text) if isinstance(text, str) else text
    ends = F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1)))
    return F.when(ustrip(ends) != ends, ustrip(t)).otherwise(t)


def _longer(text: Column, than: int) -> Column:
    """Whether a text as ``_shown`` exceeds so many characters."""
    return (F.length(text) > than) & (F.length(_shown(text)) > than)


def section_blocks() -> Column:
    """Blocks that ``sections`` can read: headings, their parents (``holds_heading``) and texts long enough to be a part."""
    return F.col("tag").isin(*HEADINGS) | F.col("holds_heading") | (F.length(_shown()) > MIN_SECTION)


def sections(blocks: DataFrame, words: list[str] = SECTION_WORDS) -> DataFrame:
    """h2/h3 headings holding a keyword: the first 5 following siblings of the
    heading's parent whose text exceeds 50 chars, as 'heading:\\ntext'.

    Texts are rendered ones.  The parser gives every element its place among
    its parent's elements: a heading's parts are the page's elements in the
    places right after its parent's."""
    return _rows(paged(blocks).withColumn("_heads", _section_heads(words)), _section_parts())


def _section_heads(words: list[str]) -> Column:
    """A page's headings that hold one of the words."""
    def holds(x: Column) -> Column:
        low = F.lower(_shown(x["rendered"]))
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))

    return F.filter("els", lambda x: x["tag"].isin(*HEADINGS) & holds(x))


def _section_parts() -> Column:
    """Structs (hpos, spos, part) of the headings in ``_heads``."""
    def follows(s: Column, p: Column) -> Column:
        near = (s["parent"] == p["parent"]) & (s["sibling"] > p["sibling"]) & (s["sibling"] <= p["sibling"] + MAX_SIBLINGS)
        return near & _longer(s["rendered"], MIN_SECTION)

    def part(h: Column, s: Column) -> Column:
        return F.struct(h["pos"].alias("hpos"), s["pos"].alias("spos"), F.concat(h["rendered"], F.lit(":\n"), _shown(s["rendered"])).alias("part"))

    def parts(h: Column) -> Column:
        parents = F.filter("els", lambda p: p["pos"] == h["parent"])
        return F.flatten(F.transform(parents, lambda p: F.transform(F.filter("els", lambda s: follows(s, p)), lambda s: part(h, s))))

    return F.flatten(F.transform("_heads", parts))


def text_fallback(blocks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Whole-page fallbacks: rendered ``main`` text over 200 chars, and body
    lines (of the text without noise); a row for every page of ``pages``, or every copy of a page's row."""
    found = paged(blocks).withColumns({
        "main_text": _main_shown(first_of(lambda e: _tag("main", e), "rendered")),
        "body_text": body_lines_text(first_of(lambda e: _tag("body", e) & ~e("noise"), "text"))})
    if pages is None and "copies" in found.columns:
        rows = found.select("page_id", F.explode("copies"), "main_text", "body_text")
    else:
        rows = _page_ids(blocks, pages).join(found, "page_id", "left")
    return rows.select("page_id", "main_text", "body_text")


def _main_shown(rendered: Column) -> Column:
    return F.when(F.length(rendered) > MIN_MAIN, rendered)


def collected_blocks() -> Column:
    """Blocks that ``collected_description`` can read, and each page's first one (a page without a description has a row)."""
    return section_blocks() | _tag("main") | (F.col("pos") == 1)


def collected_description(blocks: DataFrame) -> DataFrame:
    """Card-collector description: every selector match over 100 chars (in
    selector, then document order); else heading sections; else main text
    over 200 chars; parts joined by a blank line, then duplicate lines
    removed (first occurrence kept)."""
    prio = lambda x: _priority(all_match_rules(of(x)))
    match = F.filter("els", lambda x: prio(x).isNotNull() & _longer(x["rendered"], MIN_PART))
    x = paged(blocks).where(F.size("els") > 0).select(
        "page_id", "els", _section_heads(SECTION_WORDS).alias("_heads"),
        F.array_sort(F.transform(match, lambda x: F.struct(prio(x).alias("prio"), x["pos"].alias("pos"), _shown(x["rendered"]).alias("t")))).alias("ps"))
    x = x.select("page_id", "ps", F.array_sort(_section_parts()).alias("ss"), first_of(lambda e: _tag("main", e), "rendered").alias("main"))
    joined = F.coalesce(
        F.when(F.size("ps") > 0, F.array_join(F.transform("ps", lambda p: p["t"]), "\n\n")),
        F.when(F.size("ss") > 0, F.array_join(F.transform("ss", lambda p: p["part"]), "\n\n")),
        _main_shown(F.col("main")))
    x = x.select("page_id", joined.alias("raw"))
    return dedup_lines(x, "raw", "description").select("page_id", "description")


# Card selectors of the collector, in order (tag, class words, part of data-testid).
CARD_RULES = [("div", ["tw-group", "tw-h-full", "tw-overflow-hidden", "tw-bg-white", "tw-rounded-sm"], None),
              ("article", ["job-card"], None), ("div", ["job-card"], None), ("article", [], "job")]
CARD_MIN = 5
GROUP_CLASS = "tw-group"
LINK_MARKER = "/fr-fr/emplois/"


def _card_rules(rules: list[tuple[str, list[str], str | None]], link_marker: str, e: Element = F.col) -> list[Column]:
    """Predicates of the card selectors, the offer link last."""
    preds = []
    for tag, words, testid in rules:
        c = _tag(tag, e)
        for w in words:
            c = c & class_is(e("cls"), w)
        if testid:
            c = c & class_has(e("data_testid"), testid)
        preds.append(c)
    return [*preds, _is_link(e, link_marker)]


def _is_link(e: Element, link_marker: str) -> Column:
    return _tag("a", e) & F.coalesce(F.contains(e("href"), F.lit(link_marker)), F.lit(False))


def _is_group(e: Element) -> Column:
    return _tag("div", e) & class_has(e("cls"), GROUP_CLASS)


def card_blocks() -> Column:
    """Blocks that ``page_cards`` can read with its own rules."""
    return reduce(lambda a, b: a | b, _card_rules(CARD_RULES, LINK_MARKER), _is_group(F.col))


def _with_cards(page: DataFrame, rules: list[tuple[str, list[str], str | None]], link_marker: str) -> DataFrame:
    """``page`` with ``_cards``: structs (rule, pos) of each page's cards."""
    n = len(rules) + 1
    ruled = F.filter(F.transform("els", lambda x: F.struct(_priority(_card_rules(rules, link_marker, of(x))).alias("rule"),
                                                           x["pos"].alias("pos"), x["ancestors"].alias("ancestors"))),
                     lambda m: m["rule"].isNotNull())
    by_rule = lambda i: F.filter("_ruled", lambda m: m["rule"] == i)
    best = F.coalesce(*[F.when(F.size(by_rule(i)) > CARD_MIN, F.lit(i)) for i in range(1, n + 1)])
    page = page.withColumn("_ruled", ruled).withColumn("_best", best)
    won = F.transform(by_rule(F.col("_best")), lambda m: F.struct(m["rule"].alias("rule"), m["pos"].alias("pos")))
    # pages without a winning rule: the outermost group around each link, the first of its ancestors in document order, else the link
    outer = once(positions(_is_group), lambda groups: F.array_distinct(F.transform(by_rule(n), lambda m: F.struct(
        F.lit(0).alias("rule"), F.coalesce(F.array_min(F.array_intersect(m["ancestors"], groups)), m["pos"]).alias("pos")))))
    return page.withColumn("_cards", F.when(F.col("_best").isNotNull(), won).otherwise(outer)).drop("_ruled", "_best")


def page_cards(blocks: DataFrame, rules: list[tuple[str, list[str], str | None]] = CARD_RULES,
               link_marker: str = LINK_MARKER) -> DataFrame:
    """Card segmentation per page: the first rule with more than 5 matches
    gives the cards; otherwise each distinct outermost ``tw-group`` div around an
    offer link (or the link itself).  Output (page_id, rule, pos); of blocks in
    one row per page also such rows, with the cards as ``_cards``."""
    page = _with_cards(paged(blocks), rules, link_marker)
    return page if "els" in blocks.columns else _rows(page, F.col("_cards"))


CARD_TAGS = {"p", "div", "a", "article"}
# Classes of a card's fields.
TAG_CLASSES = ["tw-readonly", "tw-tag-secondary-s"]
SALARY_CLASS, DATE_CLASS = "tw-typo-s-bold", "tw-text-grey-500"


def _is_tag(e: Element) -> Column:
    return _tag("div", e) & class_is(e("cls"), TAG_CLASSES[0]) & class_is(e("cls"), TAG_CLASSES[1])


def card_field_blocks() -> Column:
    """Blocks, besides the cards, that ``card_fields`` can read: headings and paragraphs, and the elements of the fields."""
    return F.col("tag").isin("h3", "p") | _is_tag(F.col) | (_tag("div") & (class_is("cls", SALARY_CLASS) | class_is("cls", DATE_CLASS)))


def card_fields(blocks: DataFrame, cards: DataFrame, link_marker: str = LINK_MARKER) -> DataFrame:
    """A row per card: url, title and company (first two ``h3`` paragraphs), tags, salary, date, whole text.

    ``cards``: ``page_cards`` of the blocks.  A card's elements are itself and those that have it among their ancestors."""
    if "_cards" in cards.columns:
        page = cards.withColumn("_own", F.array_distinct(F.transform("_cards", lambda c: c["pos"])))
    else:
        page = paged(blocks).join(cards.groupBy("page_id").agg(F.collect_set("pos").alias("_own")), "page_id")
    para = once(positions(lambda e: _tag("h3", e)), lambda h3: positions(lambda e: _tag("p", e) & F.arrays_overlap(e("ancestors"), h3)))

    def read(x: Column, para: Column) -> Column:
        e = of(x)
        div = lambda c: _tag("div", e) & class_is(e("cls"), c)
        return F.struct(x["pos"].alias("pos"), x["ancestors"].alias("ancestors"), x["href"].alias("href"), x["rendered"].alias("rendered"),
                        F.array_contains(para, x["pos"]).alias("para"), _is_tag(e).alias("tag"), _is_link(e, link_marker).alias("link"),
                        div(SALARY_CLASS).alias("salary"), div(DATE_CLASS).alias("date"), F.array_contains("_own", x["pos"]).alias("card"))

    read_of = once(para, lambda p: F.filter(F.transform(F.filter("els", lambda x: x["tag"].isin(*CARD_TAGS)), lambda x: read(x, p)),
                                            lambda x: x["para"] | x["tag"] | x["link"] | x["salary"] | x["date"] | x["card"]))
    below = lambda kept, c: F.filter(kept, lambda x: (x["pos"] == c) | F.array_contains(x["ancestors"], c))
    inside = once(read_of, lambda kept: F.transform("_own", lambda c: F.struct(c.alias("card"), below(kept, c).alias("of"))))
    page = _rows(page, F.when(F.size("_own") > 0, inside))
    shown = lambda cond, v="rendered": F.transform(F.filter("of", cond), lambda x: F.struct(x["pos"], x[v]))
    g = page.where(F.size("of") > 0).select(
        "page_id", F.col("card").alias("pos"), F.array_min(shown(lambda x: x["link"], "href"))["href"].alias("url"),
        F.slice(F.array_sort(shown(lambda x: x["para"])), 1, 2).alias("ps"), F.array_sort(shown(lambda x: x["tag"])).alias("ts"),
        F.array_min(shown(lambda x: x["salary"]))["rendered"].alias("salary"), F.array_min(shown(lambda x: x["date"]))["rendered"].alias("published"),
        F.array_min(shown(lambda x: x["pos"] == F.col("card")))["rendered"].alias("card_text"))
    return g.select("page_id", "pos", "url", F.get("ps", F.lit(0))["rendered"].alias("title_p"),
                    F.get("ps", F.lit(1))["rendered"].alias("company_p"), F.transform("ts", lambda t: t["rendered"]).alias("tags"),
                    "salary", "published", "card_text")


def category_links(blocks: DataFrame, heading: str = "On a classé tous nos jobs") -> DataFrame:
    """(page_id, pos, href, text): links in the section that holds the heading (its outermost ``section`` or
    classed ``div``); on pages without it all links.  ``category_match`` tests the address.  Of blocks in one row per
    page also such rows, with the links as ``links``."""
    box = positions(lambda e: _tag("section", e) | (_tag("div", e) & e("cls").isNotNull()))
    head = F.filter("els", lambda x: F.contains(x["rendered"], F.lit(heading)) & ~x["tag"].isin("html", "body"))
    above = F.array_max(F.transform(head, lambda x: F.struct(x["pos"], x["ancestors"])))["ancestors"]
    page = paged(blocks).withColumns({"_box": F.array_min(F.array_intersect(above, box))})
    a = F.filter("els", lambda x: _tag("a", of(x)) & (F.col("_box").isNull() | F.array_contains(x["ancestors"], F.col("_box"))))
    links = F.transform(a, lambda x: F.struct(x["pos"].alias("pos"), x["href"].alias("href"), x["rendered"].alias("text")))
    if "els" in blocks.columns:
        return page.withColumn("links", links).drop("els", "_box")
    return _rows(page, links)


def offer_links(blocks: DataFrame) -> DataFrame:
    """Distinct (page_id, href) of the offer titles of result pages."""
    return blocks.where(_tag("a") & (F.col("data_cy") == "offerTitle") & F.col("href").isNotNull()).select("page_id", "href").distinct()


def page_fields(blocks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Per page: the ``title`` text, the first ``h1`` text, the first link's
    title attribute; null when absent."""
    found = blocks.where(_tag("title") | _tag("h1") | (_tag("a") & F.col("title_attr").isNotNull())).groupBy("page_id").agg(
        _first(_tag("title"), "text", "page_title"), _first(_tag("h1"), "text", "h1"),
        _first(_tag("a") & F.col("title_attr").isNotNull(), "title_attr", "link_title"))
    return _page_ids(blocks, pages).join(found, "page_id", "left")
