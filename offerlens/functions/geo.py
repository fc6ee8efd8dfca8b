"""Location parsing (Column -> struct Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT, WS
from offerlens.functions.text import col_, ustrip

# Markers and defaults of the reference.
NOT_GIVEN = "Non précisé"
NA = "N/A"
SALARY_MARKERS = r"€|k|/mois|/heure|brut|net"
CITY = f"[a-zÀ-ÿ{WS}\\-]"
DASH = "[-–]"


def title_case(c: str | Column) -> Column:
    """Python ``str.title()``: a letter after a non-letter is upper-cased,
    other letters are lower-cased (``initcap`` only splits on spaces)."""
    runs = F.regexp_extract_all(col_(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                             F.lower(F.substring(w, 2, 1 << 30)))), "")


def location_v2(c: str | Column) -> Column:
    """struct(ville, departement): split on ' - ', else (whole, 'N/A')."""
    s = ustrip(col_(c))
    parts = F.split(s, " - ", -1)
    has_dash = F.contains(s, F.lit(" - "))
    return (F.when(col_(c).isNull(), F.struct(F.lit(NOT_GIVEN).alias("ville"), F.lit(NA).alias("departement")))
            .when(has_dash, F.struct(ustrip(F.get(parts, 0)).alias("ville"),
                                     ustrip(F.get(parts, 1)).alias("departement")))
            .otherwise(F.struct(s.alias("ville"), F.lit(NA).alias("departement"))))


def location_v3(c: str | Column) -> Column:
    """struct(city, department) by the reference's ordered rules on lower/strip text.

    (0) salary markers -> unknown; (A) 'NN - city'; (B) 'city - NN';
    (C) 'city (NN)'; (D) letters only -> city; else unknown.  City is
    title-cased then stripped, department left-padded to two digits.
    """
    s = F.lower(ustrip(col_(c)))
    pa = f"([{DIGIT}]{{1,2}})[{WS}]*{DASH}[{WS}]*({CITY}+)"
    pb = f"({CITY}+)[{WS}]*{DASH}[{WS}]*([{DIGIT}]{{1,2}})"
    pc = f"({CITY}+)[{WS}]*\\(([{DIGIT}]{{1,2}})\\)"
    pd = f"^{CITY}+$"

    def city(x: Column) -> Column:
        return ustrip(title_case(x))

    def dept(x: Column) -> Column:
        return F.lpad(x, 2, "0")

    def mk(ci: Column, de: Column) -> Column:
        return F.struct(ci.alias("city"), de.alias("department"))

    unknown = mk(F.lit(NOT_GIVEN), F.lit(NOT_GIVEN))
    return (F.when(col_(c).isNull(), unknown)
            .when(s.rlike(SALARY_MARKERS), unknown)
            .when(s.rlike(pa), mk(city(F.regexp_extract(s, pa, 2)), dept(F.regexp_extract(s, pa, 1))))
            .when(s.rlike(pb), mk(city(F.regexp_extract(s, pb, 1)), dept(F.regexp_extract(s, pb, 2))))
            .when(s.rlike(pc), mk(city(F.regexp_extract(s, pc, 1)), dept(F.regexp_extract(s, pc, 2))))
            .when(s.rlike(pd), mk(city(s), F.lit(NOT_GIVEN)))
            .otherwise(unknown))


def department_num(c: str | Column) -> Column:
    """'non précisé' (any case) -> -1; numeric text -> int; otherwise -1."""
    s = ustrip(col_(c).cast("string"))
    num = s.try_cast("double").try_cast("int")  # truncates like astype(int)
    return (F.when(F.lower(s) == F.lit(NOT_GIVEN.lower()), F.lit(-1))
            .otherwise(F.coalesce(num, F.lit(-1))))
