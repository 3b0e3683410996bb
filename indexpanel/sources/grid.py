"""Cell grids: (sheet STRING, row_idx INT, cells ARRAY<STRING>), row order explicit.

An empty cell is NULL or ''; reshape.cell and the unpivots read both as NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexpanel.sources.records import read_records

FIELD = r'(?s)\G("(?:[^"]|"")*+"|[^,]*),'


def grid_from_lines(
    df: DataFrame, sheet: str, text: str, cell_separator: str | None = None
) -> DataFrame:
    """Line-oriented text to a grid: one row per line, cells split on a separator (regex)."""
    lines = df.select(
        F.col(sheet).cast("string").alias("sheet"),
        F.posexplode(F.split(text, "\r?\n")).alias("row_idx", "line"),
    )
    cells = F.array("line") if cell_separator is None else F.split("line", cell_separator)
    return lines.select("sheet", "row_idx", cells.alias("cells"))


def grid_from_columns(df: DataFrame, sheet: Column, row_idx: str, columns: Sequence[str]) -> DataFrame:
    """A stored wide grid (c0, c1, ...) to a grid."""
    return df.select(
        sheet.cast("string").alias("sheet"), F.col(row_idx).cast("int").alias("row_idx"),
        F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"),
    )


def read_grid(spark: SparkSession, path: str | list[str], n_columns: int | None = None) -> DataFrame:
    """Sheets exported as CSV without header, one file per sheet named <sheet>.csv.

    Rows keep all their cells; quoted cells may hold commas, doubled quotes and line breaks. Rows shorter than
    `n_columns` are filled with NULL, an empty line is a row of one empty cell. Files of any size are read in splits (see
    `records`, also for quotes that are never closed).
    """
    name = F.url_decode(F.replace(F.col("file.file_name"), F.lit("+"), F.lit("%2B")))  # Spark gives it as in a URL
    sheet = F.regexp_replace(name, r"\.csv$", "")
    rows = read_records(spark, path).select(sheet.alias("sheet"), F.col("record").cast("int").alias("row_idx"), "line")
    # A cell is everything up to a comma outside quotes.
    bare = F.regexp_extract_all(F.concat("line", F.lit(",")), F.lit(FIELD), F.lit(1))
    cells = F.transform(bare, lambda c: F.when(c == "", F.lit(None)).when(
        c.startswith('"'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c))
    if n_columns:
        cells = F.concat(cells, F.array_repeat(F.lit(None).cast("string"), F.greatest(F.lit(n_columns) - F.size(cells), F.lit(0))))
    return rows.select("sheet", "row_idx", cells.alias("cells"))


def list_sheets(grid: DataFrame) -> DataFrame:
    """Sheet names with their shape."""
    return grid.groupBy("sheet").agg(
        F.count("*").alias("n_rows"),
        F.max("row_idx").cast("bigint").alias("last_row"),
        F.max(F.size("cells")).cast("bigint").alias("n_columns"),
    )


def head_rows(grid: DataFrame, sheet: str, n: int = 12) -> DataFrame:
    return grid.filter((F.col("sheet") == sheet) & (F.col("row_idx") < n)).orderBy("row_idx")
