"""Listing-card rules of the collector, as expressions over card fields.

A card is one row: its link URL, its ``title`` attribute, the texts of its
title paragraphs, its tag texts (array), its bold texts (array) and its whole
text.  Every rule is a Catalyst expression; first-seen dedup is a hash
aggregate, so a hot id is pre-aggregated on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT
from offerlens.functions.text import col_, ustrip

# URL id pattern, contract whitelist, fallbacks of the reference.
JOB_ID_PATTERN = f"/emplois/([{DIGIT}]+)\\.html"
CONTRACTS = ["CDI", "CDD", "Intérim", "Stage", "Alternance", "Freelance", "Temps partiel", "Temps plein"]
UNKNOWN_PREFIX = "unknown_"
NA = "N/A"
SHORT_DESCRIPTION_CHARS = 300


def job_id_from_url(url: str | Column) -> Column:
    """Numeric id of '/emplois/<id>.html'; otherwise a deterministic
    'unknown_' + md5(url) (the reference drew a random number)."""
    u = col_(url)
    found = F.nullif(F.regexp_extract(u, JOB_ID_PATTERN, 1), F.lit(""))
    return F.coalesce(found, F.concat(F.lit(UNKNOWN_PREFIX), F.md5(u)))


def title_company(title_p: str | Column, company_p: str | Column, title_attr: str | Column) -> Column:
    """struct(title, company): paragraph texts first; when the title is
    missing, split the link's 'title - company' attribute on ' - '."""
    t, c, a = col_(title_p), col_(company_p), col_(title_attr)
    has_title = t.isNotNull() & (t != F.lit(""))
    parts = F.split(a, " - ", -1)
    split_title = ustrip(F.get(parts, 0))
    has_company = c.isNotNull() & (c != F.lit(""))
    split_company = F.when(~has_company & (F.size(parts) >= 2), ustrip(F.get(parts, 1))).otherwise(c)
    attr_set = a.isNotNull() & (a != F.lit(""))
    dash = attr_set & F.contains(a, F.lit(" - "))
    title = (F.when(has_title, t).when(dash, split_title).when(attr_set, a).otherwise(t))
    company = F.when(has_title, c).when(dash, split_company).otherwise(c)
    return F.struct(title.alias("title"), company.alias("company"))


def route_tags(tags: str | Column, bold: str | Column) -> Column:
    """struct(location, contract_type, salary, tag0, tag1).

    location: last tag holding ' - ' and a digit; contract: last tag in the
    whitelist; salary: first bold text holding '€' or 'k'; tag0/tag1: the
    positional reading of the older collector, 'N/A' when absent.
    """
    tg, bd = col_(tags), col_(bold)
    stripped = F.transform(tg, lambda x: ustrip(x))
    loc = F.filter(stripped, lambda x: F.contains(x, F.lit(" - ")) & x.rlike(f"[{DIGIT}]"))
    con = F.filter(stripped, lambda x: x.isin(CONTRACTS))
    sal = F.filter(bd, lambda x: F.contains(x, F.lit("€")) | F.contains(F.lower(x), F.lit("k")))
    return F.struct(
        F.try_element_at(loc, F.lit(-1)).alias("location"),
        F.try_element_at(con, F.lit(-1)).alias("contract_type"),
        ustrip(F.get(sal, 0)).alias("salary"),
        F.coalesce(F.get(tg, 0), F.lit(NA)).alias("tag0"),
        F.coalesce(F.get(tg, 1), F.lit(NA)).alias("tag1"),
    )


def short_description(card_text: str | Column) -> Column:
    """The first 300 characters of the card text (the reference's feature)."""
    return F.substring(col_(card_text), 1, SHORT_DESCRIPTION_CHARS)


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple.

    ``min_by`` over a struct is a declarative aggregate with a map-side
    partial step, so a key holding a third of all rows is reduced on each
    map task before the shuffle (no single-task sort of a hot group, as a
    ``row_number`` window would need).
    """
    others = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(best.alias("__row")).select(key, *[F.col(f"__row.{c}").alias(c) for c in others])


def offer_dedup(cards: DataFrame, id_col: str = "job_id", title: str = "title",
                order: tuple[str, ...] = ("scraped_at", "offer_id")) -> DataFrame:
    """Drop cards without a title, then keep the first seen card per id."""
    kept = cards.where(F.col(title).isNotNull() & (F.col(title) != F.lit("")))
    return first_seen(kept, id_col, list(order))


def category_match(links: DataFrame, wanted: list[str], text: str = "text", href: str = "href",
                   href_marker: str | None = None, order: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """Links whose (stripped) text contains any wanted category, ignoring case;
    one href per text, the last one seen (dict overwrite).  ``wanted`` is a
    short user list, tested in-row with ``exists`` (no join)."""
    if "links" in links.columns:
        found = F.filter("links", lambda x: _wanted(x["text"], x["href"], wanted, href_marker))
        links = links.select("page_id", F.explode_outer(found).alias("_l")).where(F.col("_l").isNotNull()).select("page_id", "_l.*")
    m = _wanted_links(links, wanted, text, href, href_marker)
    return m.groupBy(text).agg(F.max_by(href, F.struct(*[F.col(c) for c in order])).alias(href))


def category_links_found(links: DataFrame, wanted: list[str], href_marker: str | None = None) -> DataFrame:
    """(page_id, name, url): every page's matching categories, per name the last link (dict overwrite).
    Of links in one row per page such rows, with the categories as structs (name, url) in ``found``."""
    if "links" in links.columns:
        named = F.transform(F.filter("links", lambda x: _wanted(x["text"], x["href"], wanted, href_marker)),
                            lambda x: F.struct(ustrip(x["text"]).alias("name"), x["pos"].alias("pos"), x["href"].alias("url")))
        page = links.withColumn("_named", named)
        last = lambda n: F.array_max(F.transform(F.filter("_named", lambda x: x["name"] == n), lambda x: F.struct(x["pos"], x["url"])))
        names = F.array_distinct(F.transform("_named", lambda x: x["name"]))
        return page.withColumn("found", F.transform(names, lambda n: F.struct(n.alias("name"), last(n)["url"].alias("url")))).drop("_named", "links")
    m = _wanted_links(links, wanted, "text", "href", href_marker)
    return m.groupBy("page_id", F.col("text").alias("name")).agg(F.max_by("href", "pos").alias("url"))


def _wanted_links(links: DataFrame, wanted: list[str], text: str, href: str, href_marker: str | None) -> DataFrame:
    return links.where(_wanted(F.col(text), F.col(href), wanted, href_marker)).withColumn(text, ustrip(F.col(text)))


def _wanted(text: Column, href: Column, wanted: list[str], href_marker: str | None) -> Column:
    t = ustrip(text)
    low = F.lower(t)
    cond = (t != F.lit("")) & href.isNotNull() & F.exists(
        F.array(*[F.lit(w.lower()) for w in wanted]), lambda w: F.contains(low, w))
    # the address is tested first: it is the cheaper test
    return F.contains(href, F.lit(href_marker)) & cond if href_marker else cond


def fill_defaults(found: DataFrame, defaults: DataFrame | Column, name: str = "name", minimum: int = 4,
                  by: str | None = None) -> DataFrame:
    """Add default entries whose name is absent, only when fewer than
    ``minimum`` were found: anti join + union, gated by a count.

    Without ``by`` the gate is one global row (broadcast).  With ``by`` each
    group (e.g. a page) is completed on its own: the gate is a per-group count
    joined on the group key; groups with nothing found always get defaults.

    ``found`` may be one row per group instead, with the entries as an array of
    structs ``found`` and an array ``copies``, and ``defaults`` an array of such
    structs: a group is then completed inside its row, each missing default once
    for every copy.
    """
    if isinstance(defaults, Column):
        from offerlens.operators.pages import once
        absent = once(F.transform("found", lambda x: x[name]), lambda names: F.filter(defaults, lambda d: ~F.array_contains(names, d[name])))
        missing = once(absent, lambda ds: F.flatten(F.transform("copies", lambda c: ds)))
        rows = F.when(F.size("found") < minimum, F.concat("found", missing)).otherwise(F.col("found"))
        return found.select(by, F.explode_outer(rows).alias("_r")).where(F.col("_r").isNotNull()).select(by, "_r.*")
    if by is None:
        need = found.agg((F.count(F.lit(1)) < minimum).alias("__need"))
        missing = (defaults.join(found.select(name), name, "left_anti")
                   .crossJoin(F.broadcast(need)).where("__need").drop("__need"))
        return found.unionByName(missing)
    need = found.groupBy(by).agg((F.count(F.lit(1)) < minimum).alias("__need"))
    missing = (defaults.join(found.select(by, name), [by, name], "left_anti")
               .join(need, by, "left").where(F.coalesce(F.col("__need"), F.lit(True))).drop("__need"))
    return found.unionByName(missing)
