"""Quarters: a quarter is named by its last month and dated on that month's last day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month that names each quarter.
QUARTER_MONTHS = ("Mar", "Jun", "Sep", "Dec")
PERIOD_PATTERN = "^(Mar|Jun|Sep|Dec)-[0-9]{2}$"


def ordinal(date: Column) -> Column:
    """Consecutive quarter number: year * 4 + quarter."""
    return (F.year(date) * 4 + F.quarter(date)).cast("int")


def ordinal_of(year: int, quarter: int) -> int:
    return year * 4 + quarter


def ordinal_end(o: Column) -> Column:
    """Last day of the quarter with this ordinal."""
    year = F.floor((o - 1) / 4).cast("int")
    return F.last_day(F.make_date(year, (o - year * 4) * 3, F.lit(1)))


def period_label(date: Column) -> Column:
    """'Mar-26'; for display only, never for sorting."""
    return F.date_format(date, "MMM-yy")


def axis_label(date: Column) -> Column:
    """'Mar 2026'"""
    return F.date_format(date, "MMM yyyy")


def quarter_name(date: Column) -> Column:
    return F.date_format(date, "MMM")


def parse_period(c: Column) -> Column:
    """'Mar-25' -> 2025-03-31; anything that is not a quarter label -> NULL."""
    text = F.trim(c)
    return F.when(text.rlike(PERIOD_PATTERN), F.last_day(F.try_to_date(text, "MMM-yy")))


def period_end(year: Column, month: Column) -> Column:
    """Last day of the quarter named by its year and last month."""
    number = F.array_position(F.array(*[F.lit(m) for m in QUARTER_MONTHS]), month) * 3
    valid = (number > 0) & year.between(1, 9999)
    return F.when(valid, F.last_day(F.make_date(year, number.cast("int"), F.lit(1))))


def period_key(year: Column, month: Column) -> Column:
    """Carried year and month name -> 'Mar-26'."""
    return F.concat(month, F.lit("-"), F.substring(year.cast("string"), 3, 4))
