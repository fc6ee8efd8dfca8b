"""Experience parsing (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT, WS
from offerlens.functions.text import col_, contains_any, ustrip

# Level codes and labels of the reference.
LEVELS = [(0, "Débutant"), (1, "Junior"), (2, "Confirmé"), (3, "Senior"), (4, "Expert")]
KEYWORDS = [("débutant", 0, "Débutant"), ("junior", 1, "Junior"), ("confirmé", 2, "Confirmé"),
            ("senior", 3, "Senior"), ("expert", 4, "Expert")]
STUDY_WORDS = ["bac", "bep", "cap", "master", "licence"]
NOT_GIVEN = "Non précisé"
SECTOR = "Secteur mentionné"
STUDIES = "Niveau études"

N = f"([{DIGIT}]+)"
SP = f"[{WS}]*"
RANGE_EXP = f"exp[.érience]*{SP}{N}{SP}à{SP}{N}{SP}an"
RANGE = f"{N}{SP}à{SP}{N}{SP}an"
SINGLE_V2 = f"{N}{SP}(?:an|année)"
SINGLE = f"{N}{SP}an"


def _int(x: Column) -> Column:
    return x.try_cast("bigint")


def _level(value: Column, bounds: list[tuple[str, float]]) -> tuple[Column, Column]:
    """(code, label) from ordered (op, bound) tests, last level otherwise."""
    code = None
    label = None
    for (op, bound), (lv, lab) in zip(bounds, LEVELS):
        cond = (value == bound) if op == "==" else (value <= bound)
        code = F.when(cond, F.lit(lv)) if code is None else code.when(cond, F.lit(lv))
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    return code.otherwise(F.lit(LEVELS[-1][0])), label.otherwise(F.lit(LEVELS[-1][1]))


def experience_v2(c: str | Column) -> Column:
    """struct(experience_encoded INT, experience_label, experience_raw) by ordered rules."""
    raw = col_(c)
    s = F.lower(ustrip(raw))

    a, b = _int(F.regexp_extract(s, RANGE_EXP, 1)), _int(F.regexp_extract(s, RANGE_EXP, 2))
    avg = (a + b) / F.lit(2.0)
    r_code, r_label = _level(avg, [("<=", 1), ("<=", 3), ("<=", 6), ("<=", 10)])
    r_raw = F.concat(a.cast("string"), F.lit("-"), b.cast("string"), F.lit(" ans"))

    y = _int(F.regexp_extract(s, SINGLE_V2, 1))
    y_code, y_label = _level(y, [("==", 0), ("<=", 2), ("<=", 5), ("<=", 10)])
    y_raw = F.concat(y.cast("string"), F.lit(" ans"))

    def mk(code, label, rawtxt):
        return F.struct(code.cast("int").alias("experience_encoded"), label.alias("experience_label"),
                        rawtxt.alias("experience_raw"))

    out = F.when(raw.isNull(), mk(F.lit(-1), F.lit(NOT_GIVEN), F.lit(NOT_GIVEN)))
    out = out.when(s.rlike(RANGE_EXP), mk(r_code, r_label, r_raw))
    out = out.when(s.rlike(SINGLE_V2), mk(y_code, y_label, y_raw))
    for kw, lv, lab in KEYWORDS:
        out = out.when(F.contains(s, F.lit(kw)), mk(F.lit(lv), F.lit(lab), F.lit(kw)))
    out = out.when(F.contains(raw, F.lit("•")) | F.contains(s, F.lit("secteur")),
                   mk(F.lit(-1), F.lit(SECTOR), raw))
    out = out.when(contains_any(s, STUDY_WORDS), mk(F.lit(-1), F.lit(STUDIES), raw))
    return out.otherwise(mk(F.lit(-1), F.lit(NOT_GIVEN), raw))


def experience_years(c: str | Column, variant: str = "v3") -> Column:
    """Years as DOUBLE: range mean, else single number, else null.

    v1 first maps any text containing 'débutant' to 0.
    """
    s = F.lower(col_(c))
    a, b = _int(F.regexp_extract(s, RANGE, 1)), _int(F.regexp_extract(s, RANGE, 2))
    single = _int(F.regexp_extract(s, SINGLE, 1)).cast("double")
    out = F.when(col_(c).isNull(), F.lit(None).cast("double"))
    if variant == "v1":
        out = out.when(F.contains(s, F.lit("débutant")), F.lit(0.0))
    elif variant != "v3":
        raise ValueError(f"unknown experience variant {variant!r}")
    return (out.when(s.rlike(RANGE), (a + b) / F.lit(2.0))
            .when(s.rlike(SINGLE), single)
            .otherwise(F.lit(None).cast("double")))
