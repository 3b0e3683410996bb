"""Staged CSV lines of the three tidy files to the verified star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from indexpanel.operators.star import build_star, verify_star
from indexpanel.sources.files import lookup_df
from indexpanel.sources.schema import GROUPS, REGIONAL, SERIES
from indexpanel.sources.staged import Pick, load_with_rejects, staged_load


def _picks(schema) -> list[Pick]:
    """File order is schema order; dates are lenient, numbers strict."""
    return [
        Pick(f.name, i, f.dataType.simpleString(), strict=f.dataType.simpleString() != "date")
        for i, f in enumerate(schema, start=1)
    ]


PICKS = {"series": _picks(SERIES), "groups": _picks(GROUPS), "regional": _picks(REGIONAL)}


def load_star(lines: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Lines (without header) of the files 'series', 'groups', 'regional' to six tables."""
    return build_star(*[staged_load(lines[f], PICKS[f]) for f in ("series", "groups", "regional")])


def load_report(lines: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every line with its status, per file."""
    return {f: load_with_rejects(lines[f], picks) for f, picks in PICKS.items()}


def verify(spark: SparkSession, tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    counts = lookup_df(spark, expected, "table_name", "expected", ("string", "bigint"))
    return verify_star(tables, counts)
