"""Fiscal calendar Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CALENDAR_MONTHS, FISCAL_MONTHS, MONTH_FULL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_abbr(d) -> Column:
    """3-letter English month of a date/timestamp (locale independent)."""
    return F.element_at(F.array(*[F.lit(m) for m in CALENDAR_MONTHS]), F.month(_c(d)))


def month_full(m) -> Column:
    """B19: 'Oct' -> 'October' (unknown text passes through)."""
    mp = F.create_map(*[x for k, v in MONTH_FULL.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(mp, _c(m)), _c(m))


def fiscal_year_of(d) -> Column:
    """October-December belong to the next fiscal year."""
    return F.year(_c(d)) + F.when(F.month(_c(d)) >= 10, 1).otherwise(0)


def fiscal_month_ord(m) -> Column:
    """Oct=1 ... Sep=12; unknown -> 0."""
    return F.array_position(F.array(*[F.lit(x) for x in FISCAL_MONTHS]), _c(m)).cast("int")


def fiscal_quarter(m) -> Column:
    """Q1 = Oct-Dec ... Q4 = Jul-Sep (as 1..4)."""
    return F.ceil(fiscal_month_ord(m) / F.lit(3)).cast("int")


def is_current_year(fiscal_year, as_of_year: int) -> Column:
    """Fiscal year at or after the calendar year of the run (an argument)."""
    return _c(fiscal_year) >= F.lit(as_of_year)
