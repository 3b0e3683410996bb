"""Keyword drill-down and slicing of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexpanel.functions.text import any_like, any_regex, is_group_name
from indexpanel.operators.compare import member_value


def keyword_like(df: DataFrame, name: str, patterns: Sequence[str], ignore_case: bool = False) -> DataFrame:
    return df.filter(any_like(F.col(name), patterns, ignore_case))


def keyword_regex(df: DataFrame, name: str, pattern: str, subgroups_only: bool = True) -> DataFrame:
    hit = any_regex(F.col(name), pattern)
    return df.filter(hit & ~is_group_name(F.col(name)) if subgroups_only else hit)


def under_prefix(df: DataFrame, ref: str, parent: str) -> DataFrame:
    """Members below one parent, by reference code."""
    return df.filter(F.col(ref).startswith(parent) & (F.col(ref) != parent))


def slicer(
    df: DataFrame, member: str, chosen: str, total: str, value: str, by: Sequence[str],
    name: str = "total_value",
) -> DataFrame:
    """One member's rows beside the total of the same period."""
    both = df.filter(F.col(member).isin(chosen, total))
    return both.withColumn(name, member_value(value, member, total, by)).filter(
        F.col(member) == chosen
    )

