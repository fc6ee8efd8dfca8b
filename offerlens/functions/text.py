"""Text cleaning and flag expressions (Column -> Column).

All functions build Catalyst expressions; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT, WORD, WS, S, strip_pattern


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: str | Column) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    return F.regexp_replace(col_(c), strip_pattern(), "")


def collapse_ws(c: str | Column) -> Column:
    """``re.sub(r'\\s+', ' ', text)``."""
    return F.regexp_replace(col_(c), f"{S}+", " ")


# Characters kept by the three cleaning variants (besides word chars and
# whitespace): v1 keeps '-', v2 and v3 keep '-' and "'".
_KEEP = {"v1": r"\-", "v2": r"\-'", "v3": r"\-'"}


def clean_text(c: str | Column, variant: str = "v2") -> Column:
    """The reference's three ``clean_text`` variants; null gives ``''``.

    v1/v2: lower, collapse whitespace, replace other chars by a space, strip
    (double spaces made by the replacement survive).  v3: replace first, then
    collapse, then strip.
    """
    if variant not in _KEEP:
        raise ValueError(f"unknown clean_text variant {variant!r}")
    other = f"[^{WORD}{WS}{_KEEP[variant]}]"
    x = F.lower(F.coalesce(col_(c), F.lit("")))
    if variant == "v3":
        x = collapse_ws(F.regexp_replace(x, other, " "))
    else:
        x = F.regexp_replace(collapse_ws(x), other, " ")
    return ustrip(x)


def clean_cluster_text(c: str | Column) -> Column:
    """Clustering clean: lower, digits -> space, collapse whitespace, strip."""
    x = F.regexp_replace(F.lower(col_(c)), r"\p{Nd}+", " ")
    return ustrip(collapse_ws(x))


def text_all(title: str | Column, description: str | Column) -> Column:
    """``(title.fillna('') + ' ' + description.fillna('')).str.strip()``."""
    return ustrip(F.concat_ws(" ", F.coalesce(col_(title), F.lit("")),
                              F.coalesce(col_(description), F.lit(""))))


def contains_any(c: str | Column, words: list[str]) -> Column:
    """True when the text contains any of ``words`` (plain substrings)."""
    x = col_(c)
    out = None
    for w in words:
        t = F.contains(x, F.lit(w))
        out = t if out is None else (out | t)
    return out


# Flag vocabularies of the reference.
REMOTE_WORDS_V2 = ["télétravail", "remote", "distanciel"]
REMOTE_WORDS_V1 = ["télétravail", "remote", "distanciel", "hybride"]
REMOTE_WORDS_CARD = ["télétravail", "remote", "home office", "hybride"]
URGENT_TITLE_WORDS = ["urgent", "immédiat", "rapidement"]
URGENT_DESC_WORDS = ["urgent", "immédiat", "rapidement", "dès que possible"]
TRACKER_PHRASE = "ces traceurs sont nécessaires"


def flag(cond: Column) -> Column:
    """Boolean (null = false) -> INT 0/1, as ``str.contains(..., na=False).astype(int)``."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def remote_flag_v2(title_clean: str | Column, desc_clean: str | Column) -> Column:
    return flag(contains_any(title_clean, REMOTE_WORDS_V2) | contains_any(desc_clean, REMOTE_WORDS_V2))


def remote_flag_v1(title_clean: str | Column, desc_clean: str | Column) -> Column:
    """v1 joins both texts (``' ' + str(x)``) and searches; nulls become 'nan'."""
    t = F.concat(F.lit(" "), F.coalesce(col_(title_clean).cast("string"), F.lit("nan")),
                 F.lit(" "), F.coalesce(col_(desc_clean).cast("string"), F.lit("nan")))
    return flag(contains_any(t, REMOTE_WORDS_V1))


def remote_flag_card(card_text: str | Column) -> Column:
    """Card-level remote flag (boolean) on the lower-cased card text."""
    return F.coalesce(contains_any(F.lower(col_(card_text)), REMOTE_WORDS_CARD), F.lit(False))


def urgent_flag(title_clean: str | Column, desc_clean: str | Column) -> Column:
    return flag(contains_any(title_clean, URGENT_TITLE_WORDS) | contains_any(desc_clean, URGENT_DESC_WORDS))


def has_tracker_text(desc_clean: str | Column) -> Column:
    """Description is the cookie/tracker message (to be collected again)."""
    return F.coalesce(F.contains(col_(desc_clean), F.lit(TRACKER_PHRASE)), F.lit(False))


def experience_phrase(card_text: str | Column) -> Column:
    """Whole match of the card's experience phrase, ignoring case; null if none."""
    p = (f"(?iu)[{DIGIT}]+[{WS}]*(?:ans?|années?)[{WS}]*(?:d'expérience|expérience|exp)")
    return F.nullif(F.regexp_extract(col_(card_text), p, 0), F.lit(""))
