"""Date parsing and ages (Column -> Column).  ``as_of`` is always an argument:
results never depend on the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.regex import DIGIT
from offerlens.functions.text import col_

# Fixed value: the listing's date format (day/month/year).
DATE_FORMAT = "d/M/yyyy"


def parse_date(c: str | Column) -> Column:
    """``pd.to_datetime(s, format='%d/%m/%Y', errors='coerce')`` -> DATE, bad -> null."""
    s = col_(c)
    ok = s.rlike(f"^[{DIGIT}]{{1,2}}/[{DIGIT}]{{1,2}}/[{DIGIT}]{{4}}$")
    return F.when(ok, F.try_to_date(s, DATE_FORMAT))


def days_since(date: str | Column, as_of: str | dt.date) -> Column:
    """Whole days from ``date`` to ``as_of`` (floor of the elapsed time)."""
    return F.datediff(F.lit(str(as_of)).cast("date"), col_(date))


def published_date_extract(c: str | Column) -> Column:
    """``Publiée le (dd/MM/yyyy)`` from a text; 'N/A' when absent."""
    p = f"Publiée le ([{DIGIT}]{{2}}/[{DIGIT}]{{2}}/[{DIGIT}]{{4}})"
    return F.when(col_(c).rlike(p), F.regexp_extract(col_(c), p, 1)).otherwise(F.lit("N/A"))
