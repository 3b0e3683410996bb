"""Lay a panel out as the untidy sheets people publish: the inverse of the tidy operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.periods import ordinal_end, period_label, quarter_name
from indexpanel.sources.files import literal_df

SECTION_ROWS = 100_000


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(".."))


def _row(idx: Column, cells: Sequence[Column]) -> Column:
    return F.struct(
        idx.cast("int").alias("row_idx"), F.array(*[c.cast("string") for c in cells]).alias("cells")
    )


def _when_rows(condition: Column, rows: list[Column]) -> Column:
    empty = F.slice(F.array(*rows), 1, 0)
    return F.when(condition, F.array(*rows)).otherwise(empty)


def _spread(df: DataFrame, sheet: Column, parts: list[Column]) -> DataFrame:
    return df.select(sheet.alias("sheet"), F.explode(F.concat(*parts)).alias("r")).select("sheet", "r.*")


def _year_cell(first: Column) -> Column:
    """The year, on the first quarter of a year and on the first row only."""
    end = ordinal_end(F.col("ordinal"))
    return F.when(first | (F.quarter(end) == 1), F.year(end).cast("string"))


def series_grid(wide: DataFrame, sheet: str, measures: Sequence[str], first_row: int = 9) -> DataFrame:
    """Preamble, one row per quarter with a footnote column after each measure, closing note."""
    w = W.partitionBy(sheet)
    o = F.col("ordinal")
    rows = wide.withColumns({"__first": o == F.min(o).over(w), "__last": o == F.max(o).over(w)})
    body = [_year_cell(F.col("__first")), F.concat(quarter_name(ordinal_end(o)), F.lit(" "))]
    for m in measures:
        body += [_text(F.col(m)), F.lit(None).cast("string")]
    preamble = [_row(F.lit(i), [F.lit("Mar" if i else "1990"), F.lit("Mar")]) for i in range(first_row)]
    closing = [_row(o + first_row + 1, [F.lit("Note"), F.lit("Quarterly")])]
    return _spread(rows, F.col(sheet), [
        F.array(_row(o + first_row, body)),
        _when_rows(F.col("__first"), preamble), _when_rows(F.col("__last"), closing),
    ])


def panel_grid(
    panel: DataFrame, axis: Column, measures: dict[str, str], header_row: int = 6
) -> DataFrame:
    """One sheet per measure, members as rows, quarters (the axis array) as columns."""
    entries = F.collect_list(F.struct("ordinal", *measures.values()))
    members = panel.groupBy("group_name", "series_ref").agg(
        F.map_from_entries(F.transform(entries, _by_ordinal)).alias("by_quarter")
    )

    def values(measure: str) -> Column:
        return F.transform("axis", lambda o: _text(F.col("by_quarter")[o][measure]))

    # Any row number below the header will do: order among members carries no meaning.
    position = F.pmod(F.hash("group_name"), F.lit(900_000)) + header_row + 1
    body = members.withColumn("axis", axis).select("group_name", "series_ref", F.explode(F.array(*[
        F.struct(F.lit(s).alias("sheet"), values(m).alias("texts")) for s, m in measures.items()
    ])).alias("s")).select(
        "s.sheet", position.cast("int").alias("row_idx"),
        F.concat(F.array("group_name", "series_ref"), F.col("s.texts")).alias("cells"),
    )
    null = F.lit(None).cast("string")
    labels = F.transform("axis", lambda o: period_label(ordinal_end(o)))
    top = F.array(*[
        F.struct(F.lit(i).alias("row_idx"), cells.alias("cells")) for i, cells in (
            (0, F.array(F.lit("Source: sales"), null)),
            (header_row, F.concat(F.array(null, F.lit("")), labels)),
            (10**6 - 1, F.array(F.lit(" "), F.lit("X"), F.lit("1"))),
            (10**6, F.array(F.lit("Source: sales"), null)),
            (10**6 + 1, F.array(F.lit("After the end"), F.lit("X"), F.lit("1"))),
        )
    ])
    sheets = literal_df(panel.sparkSession, [(s,) for s in measures], "sheet string")
    frame = sheets.withColumn("axis", axis).select("sheet", F.explode(top).alias("r")).select("sheet", "r.*")
    return body.unionByName(frame)


def _by_ordinal(entry: Column) -> Column:
    return F.struct(entry["ordinal"], entry)


def sections_grid(
    wide: DataFrame, sheet: str, members: Sequence[str], sections: dict[str, str], header_row: int = 5
) -> DataFrame:
    """Stacked sections; `wide` has one column <section>__<member> per cell, `sections` the
    marker text of each section."""
    w = W.partitionBy(sheet)
    o = F.col("ordinal")
    rows = wide.withColumns({"__first": o == F.min(o).over(w)})
    null = F.lit(None).cast("string")
    parts = []
    top = [
        _row(F.lit(0), [F.lit("1990"), F.lit("Mar")]),
        _row(F.lit(header_row), [null, F.lit("NaN"), *[F.lit(f" {m}") for m in members]]),
        _row(F.lit(header_row + 1 + len(sections) * SECTION_ROWS), [F.lit("Source: sales"), null]),
        _row(F.lit(header_row + 2 + len(sections) * SECTION_ROWS), [F.lit("1991"), F.lit("Mar"), F.lit("1")]),
    ]
    for i, (name, marker) in enumerate(sections.items()):
        start = header_row + 1 + i * SECTION_ROWS
        top.append(_row(F.lit(start), [F.lit(marker), null]))
        parts.append(F.array(_row(o + start, [
            _year_cell(F.col("__first")), quarter_name(ordinal_end(o)),
            *[_text(F.col(f"{name}__{m}")) for m in members],
        ])))
    return _spread(rows, F.col(sheet), [*parts, _when_rows(F.col("__first"), top)])
