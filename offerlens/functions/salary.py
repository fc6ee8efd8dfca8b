"""Salary parsing: three variants of the reference, each a Catalyst expression.

``parse_salary(col, variant)`` returns a struct column with fields
``salary_min``, ``salary_max`` (BIGINT, rounded half-to-even like Python's
``round``), ``salary_avg`` (DOUBLE), plus ``salary_unit`` (v2, v3) and
``salary_estimated`` (v2).  The variants differ on purpose (see SURVEY 2.5):

* v1: no whitespace removal, no decimal comma; first two numbers; "heure" or
  "/h" is hourly, "mois" monthly.
* v2: null / "pas de salaire" / "" give nulls; estimated on "estimation" or
  the arrow; decimal comma fixed only when hourly; whitespace removed; first
  two numbers; hourly wins over monthly.
* v3: decimal comma always fixed; whitespace removed; min/max over all numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT, WS
from offerlens.functions.text import col_, contains_any, ustrip

# Annualisation factors of the reference.
HOURS_PER_YEAR = 35 * 47
MONTHS_PER_YEAR = 12

NUMBER = f"([{DIGIT}]+\\.?[{DIGIT}]*)"


def _numbers(s: Column) -> Column:
    """``re.findall(r'\\d+\\.?\\d*', s)`` as ARRAY<DOUBLE>."""
    return F.transform(F.regexp_extract_all(s, F.lit(NUMBER), 1), lambda x: x.cast("double"))


def _first_two_min_max(nums: Column) -> tuple[Column, Column]:
    a = F.get(nums, 0)
    b = F.coalesce(F.get(nums, 1), a)
    return F.least(a, b), F.greatest(a, b)


def _round_long(x: Column) -> Column:
    return F.bround(x, 0).cast("bigint")


def _result(lo: Column, hi: Column, factor: Column, **extra: Column) -> Column:
    smin = _round_long(lo * factor)
    smax = _round_long(hi * factor)
    fields = [smin.alias("salary_min"), smax.alias("salary_max"),
              ((smin + smax) / F.lit(2.0)).alias("salary_avg")]
    fields += [v.alias(k) for k, v in extra.items()]
    return F.struct(*fields)


def parse_salary(c: str | Column, variant: str = "v3") -> Column:
    raw = col_(c)
    if variant == "v1":
        s = F.lower(raw)
        nums = _numbers(s)
        lo, hi = _first_two_min_max(nums)
        hourly = contains_any(s, ["heure", "/h"])
        monthly = F.contains(s, F.lit("mois"))
        factor = (F.when(hourly, F.lit(float(HOURS_PER_YEAR)))
                  .when(monthly, F.lit(float(MONTHS_PER_YEAR))).otherwise(F.lit(1.0)))
        ok = F.size(nums) > 0
        return F.when(ok, _result(lo, hi, factor)).otherwise(_result(F.lit(None), F.lit(None), factor))

    if variant == "v2":
        s = F.lower(ustrip(raw))
        absent = raw.isNull() | F.contains(s, F.lit("pas de salaire")) | (s == F.lit(""))
        estimated = contains_any(s, ["estimation", "→"])
        monthly = F.contains(s, F.lit("mois"))
        hourly = F.contains(s, F.lit("heure"))
        fixed = F.when(hourly, F.regexp_replace(
            s, f"([{DIGIT}]+),([{DIGIT}]{{1,2}})(?=[^{DIGIT}]|$)", "$1.$2")).otherwise(s)
        squeezed = F.regexp_replace(fixed, f"[{WS}]+", "")
        nums = _numbers(squeezed)
        lo, hi = _first_two_min_max(nums)
        factor = (F.when(hourly, F.lit(float(HOURS_PER_YEAR)))
                  .when(monthly, F.lit(float(MONTHS_PER_YEAR))).otherwise(F.lit(1.0)))
        unit = (F.when(hourly, F.lit("hourly")).when(monthly, F.lit("monthly"))
                .otherwise(F.lit("annual")))
        null_unit = F.lit(None).cast("string")
        some = _result(lo, hi, factor, salary_estimated=estimated, salary_unit=unit)
        none_est = _result(F.lit(None), F.lit(None), factor, salary_estimated=estimated,
                           salary_unit=null_unit)
        none_all = _result(F.lit(None), F.lit(None), factor, salary_estimated=F.lit(False),
                           salary_unit=null_unit)
        return F.when(absent, none_all).when(F.size(nums) == 0, none_est).otherwise(some)

    if variant == "v3":
        s = F.lower(raw)
        hourly = F.contains(s, F.lit("heure"))
        monthly = F.contains(s, F.lit("mois"))
        fixed = F.regexp_replace(s, f"([{DIGIT}]+),([{DIGIT}]+)", "$1.$2")
        squeezed = F.regexp_replace(fixed, f"[{WS}]", "")
        nums = _numbers(squeezed)
        factor = (F.when(hourly, F.lit(float(HOURS_PER_YEAR)))
                  .when(monthly, F.lit(float(MONTHS_PER_YEAR))).otherwise(F.lit(1.0)))
        unit = (F.when(hourly, F.lit("hourly")).when(monthly, F.lit("monthly"))
                .otherwise(F.lit("annual")))
        null_unit = F.lit(None).cast("string")
        some = _result(F.array_min(nums), F.array_max(nums), factor, salary_unit=unit)
        none = _result(F.lit(None), F.lit(None), factor, salary_unit=null_unit)
        return F.when(raw.isNull() | (F.size(nums) == 0), none).otherwise(some)

    raise ValueError(f"unknown salary variant {variant!r}")


def with_salary(df, source: str = "salary", variant: str = "v3"):
    """Add the parsed salary columns to ``df`` (one projection, no shuffle)."""
    parsed = parse_salary(source, variant)
    names = ["salary_min", "salary_max", "salary_avg"]
    if variant in ("v2",):
        names += ["salary_estimated", "salary_unit"]
    if variant == "v3":
        names += ["salary_unit"]
    tmp = "__salary"
    return df.withColumn(tmp, parsed).select("*", *[F.col(f"{tmp}.{n}").alias(n) for n in names]).drop(tmp)


# Salary bins of the reference (upper bounds, exclusive).
FIXED_BINS = [(25000, "< 25k"), (35000, "25-35k"), (50000, "35-50k"), (70000, "50-70k")]
FIXED_TOP = "> 70k"
FIXED_NULL = "Non renseigné"


def fixed_bins(avg: str | Column) -> Column:
    x = col_(avg)
    out = F.when(x.isNull(), F.lit(FIXED_NULL))
    for bound, label in FIXED_BINS:
        out = out.when(x < bound, F.lit(label))
    return out.otherwise(F.lit(FIXED_TOP))


def quantile_class(avg: str | Column, q33: Column, q66: Column) -> Column:
    """null stays null; <= Q33 'Bas', <= Q66 'Moyen', else 'Haut'."""
    x = col_(avg)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x <= q33, F.lit("Bas")).when(x <= q66, F.lit("Moyen"))
            .otherwise(F.lit("Haut")))
