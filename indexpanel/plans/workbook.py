"""Layout of the quarterly consumer-price workbook, and its extraction to three tidy panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexpanel.operators.reshape import cell, tidy_panel, tidy_sections, tidy_series
from indexpanel.sources.schema import SERIES_MEASURES

# Sheet names, first rows, and cell texts of the workbook.
SERIES_SHEET = "1"
SERIES_FIRST_ROW = 9
SERIES_COLUMNS = dict(zip(SERIES_MEASURES, range(2, 20, 2)))
GROUP_SHEETS = {"2.01": "index_value", "2.02": "qoq_pct_change", "2.03": "yoy_pct_change"}
GROUP_HEADER_ROW = 6
REGION_SHEET = "17"
REGION_HEADER_ROW = 5
REGION_SECTIONS = {"index": "cpi_index", "qoq_pct": "qoq_pct_change", "yoy_pct": "yoy_pct_change"}


def region_section(c0: Column) -> Column:
    """Marker rows: the total's name without digits, or the two percentage headings."""
    return (
        F.when(c0.contains("All groups") & ~c0.rlike("[0-9]"), "index")
        .when(c0.contains("Percentage change from previous quarter"), "qoq_pct")
        .when(c0.contains("Percentage change from same quarter"), "yoy_pct")
    )


def extract_series(grid: DataFrame, **skew) -> DataFrame:
    sheet = grid.filter(F.col("sheet") == SERIES_SHEET)
    return tidy_series(sheet, SERIES_COLUMNS, SERIES_FIRST_ROW, **skew).drop("sheet")


def extract_groups(grid: DataFrame, **skew) -> DataFrame:
    return tidy_panel(grid, GROUP_SHEETS, GROUP_HEADER_ROW, **skew)


def extract_regions(grid: DataFrame, **skew) -> DataFrame:
    sheet = grid.filter(F.col("sheet") == REGION_SHEET)
    section = region_section(cell(0))
    end = cell(0).contains("Source") & section.isNull()
    return tidy_sections(
        sheet, section, end, REGION_SECTIONS, REGION_HEADER_ROW, **skew
    ).drop("sheet")
