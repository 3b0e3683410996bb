"""Rounding, cleaning, ratios and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell text that means "not available", and white space float() ignores.
NOT_AVAILABLE = ".."
BLANKS = " \t\n\r\x0b\x0c"

NUMBER_PATTERN = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"


def round_half_up(c: Column, digits: int = 0) -> Column:
    """Half away from zero, by the decimal digits a DOUBLE is printed with; NaN and infinities stay, never -0.0."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def exact(c: Column, digits: int = 6) -> Column:
    """DECIMAL whose sum doesn't depend on the order of additions; NULL for NaN, infinities and values beyond 10^31."""
    d = c.cast("double")
    return F.when(F.abs(d) < 1e31, round_half_up(d, digits).try_cast(f"decimal(38,{digits})"))


def minor_units(c: Column) -> Column:
    """A two-decimal DOUBLE as BIGINT hundredths: exact, order-independent and cheap to sum.

    NULL for NaN, infinities and amounts from 9e16, which quality.unusable_amounts counts.
    """
    return F.when(F.abs(c) < 9e16, F.rint(c * 100).cast("bigint"))


def from_minor_units(c: Column) -> Column:
    return (c.cast("decimal(20,0)") * F.expr("0.01BD")).cast("decimal(24,2)")


def clean_number(c: Column, na: str = NOT_AVAILABLE) -> Column:
    """Text cell to DOUBLE; the NA mark, blanks, 'nan' and unparsable text become NULL."""
    cell = F.btrim(c, F.lit(BLANKS))
    digits = F.regexp_replace(cell, "(?<=[0-9])_(?=[0-9])", "")
    return F.when((cell != na) & digits.rlike(NUMBER_PATTERN), digits.try_cast("double"))


def pct_change(now: Column, before: Column) -> Column:
    """(now - before) / before * 100; NULL on a zero or missing base."""
    return F.try_divide(now - before, before) * 100


def signed_points(c: Column, digits: int = 2) -> Column:
    """+0.74pp"""
    return F.format_string(f"%+.{digits}fpp", round_half_up(c, digits))


def percent_text(c: Column, digits: int = 1) -> Column:
    """3.1%"""
    return F.format_string(f"%.{digits}f%%", round_half_up(c, digits))
