"""Keyword predicates, name rules, classification and bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Naming rule of a top-level group, name of the total, labels.
TOTAL_NAME = "All groups"
GROUP_SUFFIX = " group"
CHARACTER_LABELS = ("Domestic-led", "Import-led", "Balanced")
LABEL_LENGTH = 35


def any_like(c: Column, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    return reduce(or_, [c.ilike(p) if ignore_case else c.like(p) for p in patterns])


def any_regex(c: Column, pattern: str) -> Column:
    """Case-insensitive 'contains'."""
    return c.rlike(f"(?i){pattern}")


def is_group_name(name: Column) -> Column:
    return F.lower(F.trim(name)).endswith(GROUP_SUFFIX)


def is_total(name: Column, total: str = TOTAL_NAME) -> Column:
    return F.lower(F.trim(name)) == total.lower()


def group_level(name: Column) -> Column:
    return F.when(is_group_name(name) | is_total(name), "group").otherwise("subgroup")


def classify_sign(
    a: Column, b: Column, labels: Sequence[str] = CHARACTER_LABELS, unknown: str | None = None
) -> Column:
    """a > b, b > a, or neither. A missing side is 'neither' unless `unknown` is given."""
    result = F.when(a > b, labels[0]).when(b > a, labels[1])
    if unknown is not None:
        result = result.when(a.isNull() | b.isNull(), unknown)
    return result.otherwise(labels[2])


def band(value: Column, steps: Sequence[tuple[Column | float, str]], otherwise: str) -> Column:
    """Label of the first step the value exceeds, e.g. [(3.4, 'high'), (0, 'rising')]."""
    result = None
    for threshold, label in steps:
        hit = value > threshold
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(otherwise)


def compare_band(
    value: Column, level: Column | float, labels: Sequence[str] = ("above", "below", "equal")
) -> Column:
    return F.when(value > level, labels[0]).when(value < level, labels[1]).otherwise(labels[2])


def short_label(label: Column, name: Column, length: int = LABEL_LENGTH) -> Column:
    """A looked-up label, else the start of the full name."""
    return F.coalesce(label, F.substring(name, 1, length))


def is_year(c: Column) -> Column:
    return F.trim(c).rlike("^[0-9]{4}$")
