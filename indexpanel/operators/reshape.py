"""Spreadsheet-like grids to tidy tables, and long <-> wide.

A grid is a DataFrame (sheet STRING, row_idx INT, cells ARRAY<STRING>); an empty cell is NULL
or '', and is read as NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.numbers import clean_number
from indexpanel.functions.periods import QUARTER_MONTHS, parse_period, period_end, period_key
from indexpanel.functions.text import is_year
from indexpanel.operators import ordered

# Header cells that count as empty.
EMPTY_HEADERS = ("", "NaN")


def cell(i: int) -> Column:
    """Cell i of a grid row; NULL where it is empty or beyond the end of a short row."""
    return F.nullif(F.get("cells", F.lit(i)), F.lit(""))


def _cells() -> Column:
    """Explodes the cells. The outer form spares a filter that would compute them twice; the
    one NULL row it adds for an empty array has no header and is dropped with the others."""
    return F.posexplode_outer("cells").alias("col_idx", "cell")


def skip_rows(grid: DataFrame, n: int) -> DataFrame:
    """Drop the preamble and renumber from zero."""
    return grid.filter(F.col("row_idx") >= n).withColumn("row_idx", F.col("row_idx") - n)


def pick_columns(grid: DataFrame, keep: Sequence[str], picks: Mapping[str, int]) -> DataFrame:
    return grid.select(*keep, *[cell(i).alias(name) for name, i in picks.items()])


def unpivot_by_header(grid: DataFrame, row: int, keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Cells below the header row, one per row, named by the header cell above them.

    The grid is read once: every cell meets the header of its own column in one window by (sheet, column).
    """
    keep = dict(keep or {})
    cells = grid.filter(F.col("row_idx") >= row).select(
        "sheet", "row_idx", *[c.alias(k) for k, c in keep.items()], _cells(),
    )
    header = F.max(F.when(F.col("row_idx") == row, F.trim("cell"))).over(W.partitionBy("sheet", "col_idx"))
    return (
        cells.withColumn("name", header)
        .filter((F.col("row_idx") > row) & F.col("name").isNotNull() & ~F.col("name").isin(*EMPTY_HEADERS))
        .withColumn("cell", F.nullif("cell", F.lit("")))
    )


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def columns_present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def merge_measures(
    base: DataFrame, others: Mapping[str, DataFrame], keys: Sequence[str], measure: str
) -> DataFrame:
    """Left-merge one-measure tables onto `base`, with the number of rows that each side has for the keys.

    One union and one aggregation by the keys instead of a chain of joins: a single shuffle,
    pre-aggregated, and keys that `base` lacks are dropped, as a left join would. The keys must be unique in each table:
    `n_<measure>` counts their rows, and a count over 1 marks keys whose values can't be told apart (see `repeated`).
    """
    names = [measure, *others]
    extra = [c for c in base.columns if c not in keys and c != measure]
    parts = base.withColumn("__base", F.lit(True))
    for name, other in others.items():
        parts = parts.unionByName(other.select(*keys, name, F.lit(True).alias(f"__in_{name}")), allowMissingColumns=True)
    return (
        parts.groupBy(*keys)
        .agg(
            F.count("__base").alias(f"n_{measure}"),
            *[F.count(f"__in_{n}").alias(f"n_{n}") for n in others],
            *[F.max(c).alias(c) for c in [*extra, *names]],
        )
        .filter(F.col(f"n_{measure}") > 0)
    )


def repeated(merged: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The merged keys that some table has more than once: the rejects of a merge."""
    return merged.filter(reduce(or_, [F.col(f"n_{m}") > 1 for m in measures]))


def pivot_first(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str],
    order: Sequence[str] | None = None, other: str | None = None,
) -> DataFrame:
    """Names become columns; each cell is its first non-NULL value along `order`.

    Values of names that aren't listed have no column; `other` names one that counts them.
    """
    v = F.col(value)
    by = v if not order else F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(v, F.when((F.col(name) == n) & v.isNotNull(), by)).alias(n) for n in names],
        *([F.count_if(v.isNotNull() & ~F.coalesce(F.col(name).isin(*names), F.lit(False))).alias(other)] if other else []),
    )


def pivot_mean(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]
) -> DataFrame:
    return df.groupBy(*keys).pivot(name, list(names)).agg(F.avg(value))


def tidy_series(grid: DataFrame, measures: Mapping[str, int], first_row: int = 9, **skew) -> DataFrame:
    """Sheets with one row per quarter, the year written on the first quarter only."""
    rows = skip_rows(grid, first_row).select(
        "sheet", "row_idx",
        F.when(F.trim(cell(0)).rlike("^[0-9]+$"), F.trim(cell(0)).try_cast("int")).alias("year"),
        F.trim(cell(1)).alias("quarter"),
        *[cell(i).alias(m) for m, i in measures.items()],
    )
    filled = ordered.forward_fill(rows, ["year"], ["row_idx"], ["sheet"], **skew)
    period = period_key(F.col("year"), F.col("quarter"))
    end = period_end(F.col("year"), F.col("quarter"))
    return ordered.valid_rows(filled, "quarter", QUARTER_MONTHS, "year").select(
        "sheet", period.alias("period"), end.alias("period_date"),
        "year", "quarter", *[clean_number(F.col(m)).alias(m) for m in measures],
    )


def tidy_panel(
    grid: DataFrame, sheets: Mapping[str, str], header_row: int = 6, **skew
) -> DataFrame:
    """One-measure-per-sheet panels (sheet -> measure) merged on (group_name, period).

    The first sheet is the base: its members and quarters are kept. `n_rows` is the most rows that one sheet has for the
    member and quarter: over 1, the name repeats, the values come from its first row, and `repeated_names` has them all.
    """
    names = list(sheets)
    used = grid.filter(F.col("sheet").isin(*names))
    body = ordered.cut_at_sentinel(
        used,
        (F.col("row_idx") > header_row) & F.lower(F.trim(cell(0))).startswith("source"),
        ["row_idx"], ["sheet"], **skew,
    ).filter((F.col("row_idx") <= header_row) | (F.length(F.trim(cell(0))) > 0))
    long = unpivot_by_header(
        body, header_row,
        {"group_name": F.trim(cell(0)), "series_ref": F.coalesce(F.trim(cell(1)), F.lit(""))},
    )
    value = clean_number(F.col("cell"))
    is_base = F.col("sheet") == names[0]
    return (
        long.groupBy("group_name", F.col("name").alias("period"))
        .agg(
            F.min_by("series_ref", F.when(is_base, F.col("row_idx"))).alias("series_ref"),
            *[
                F.min_by(value, F.when(F.col("sheet") == s, F.col("row_idx"))).alias(m)
                for s, m in sheets.items()
            ],
            F.greatest(*[F.count_if(F.col("sheet") == s) for s in names], F.lit(0)).alias("n_rows"),
            F.max(is_base).alias("__base"),
        )
        .filter("__base")
        .select(
            "period", parse_period(F.col("period")).alias("period_date"),
            "group_name", "series_ref", *sheets.values(), "n_rows",
        )
    )


def repeated_names(grid: DataFrame, sheets: Sequence[str], header_row: int = 6) -> DataFrame:
    """Rows of a panel sheet whose name another row of the sheet has: what a merge by name can't tell apart."""
    rows = grid.filter(F.col("sheet").isin(*sheets) & (F.col("row_idx") > header_row)).select(
        "sheet", "row_idx", F.trim(cell(0)).alias("group_name"), F.trim(cell(1)).alias("series_ref"), "cells",
    ).filter(F.length("group_name") > 0)
    many = F.count("*").over(W.partitionBy("sheet", "group_name"))
    return rows.withColumn("n_rows", many).filter("n_rows > 1")


def tidy_sections(
    grid: DataFrame, section: Column, end: Column, sections: Mapping[str, str],
    header_row: int = 5, member: str = "region", **skew,
) -> DataFrame:
    """Sheets of stacked sections: a marker row sets the measure for the rows below.

    `section` gives the marker's name or NULL, `end` is true on the closing row, and
    `sections` maps marker names to output columns.
    """
    header = (
        grid.filter(F.col("row_idx") == header_row).select("sheet", _cells())
        .select("sheet", "col_idx", F.trim("cell").alias(member))
        .filter(F.col(member).isNotNull() & ~F.col(member).isin(*EMPTY_HEADERS))
    )
    kept = ordered.cut_at_sentinel(grid, end, ["row_idx"], ["sheet"], **skew)
    body = ordered.section_carry(kept, section, "metric", ["row_idx"], ["sheet"], **skew)
    dated = body.withColumns({
        "year": F.when(is_year(cell(0)), F.trim(cell(0)).try_cast("int")),
        "quarter": F.trim(cell(1)),
    })
    filled = ordered.forward_fill(dated, ["year"], ["row_idx"], ["sheet"], **skew)
    valid = ordered.valid_rows(filled, "quarter", QUARTER_MONTHS, "year")
    long = (
        valid.select("sheet", "row_idx", "year", "quarter", "metric", _cells())
        .join(header, ["sheet", "col_idx"])
        .withColumn("value", clean_number(F.col("cell")))
    )
    period = period_key(F.col("year"), F.col("quarter"))
    end = period_end(F.col("year"), F.col("quarter"))
    wide = pivot_first(
        long, ["sheet", "year", "quarter", member], "metric", "value", list(sections), ["row_idx"]
    ).filter(F.coalesce(*sections).isNotNull())
    return rename(
        wide.select(
            "sheet", period.alias("period"), end.alias("period_date"),
            "year", "quarter", member, *sections,
        ),
        sections,
    )
