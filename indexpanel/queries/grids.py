"""Untidy grids: text lines, event streams per user, and sheets laid out from the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.operators import ordered, reshape, star
from indexpanel.operators.reshape import cell
from indexpanel.operators.series import index_panel
from indexpanel.plans import grids as layout
from indexpanel.plans import sales_panel as sp
from indexpanel.queries.base import GROUPED_ALL, LABEL, SALES, panel, query, wide
from indexpanel.queries.facts import MEASURES
from indexpanel.queries.trends import region_names
from indexpanel.sources import grid as source

LINES_SQL = r"""lines AS (SELECT CAST(doc_id AS VARCHAR) AS sheet, u.i - 1 AS row_idx, u.line AS line FROM (
  SELECT doc_id, unnest(list_transform(string_split_regex(text, '\r?\n'), lambda x, i: {'i': i, 'line': x})) AS u FROM documents))"""
WORDS_SQL = LINES_SQL + r""",
words AS (SELECT sheet, row_idx, u.i - 1 AS col_idx, u.w AS w FROM (
  SELECT sheet, row_idx, unnest(list_transform(string_split(line, ' '), lambda x, i: {'i': i, 'w': x})) AS u FROM lines))"""


def _line_grid(spark, sf):
    return source.grid_from_lines(sp.table(spark, sf, "documents"), "doc_id", "text")


def _word_grid(spark, sf):
    return source.grid_from_lines(sp.table(spark, sf, "documents"), "doc_id", "text", " ")


@query(f"WITH {LINES_SQL} SELECT sheet, CAST(row_idx AS INTEGER) AS row_idx, NULLIF(line, '') AS line FROM lines")
def grid_from_lines(spark, sf):
    return _line_grid(spark, sf).select("sheet", "row_idx", cell(0).alias("line"))


@query(f"""WITH {WORDS_SQL}
SELECT sheet, CAST(count(DISTINCT row_idx) AS BIGINT) AS n_rows, CAST(max(row_idx) AS BIGINT) AS last_row,
  CAST(max(col_idx) + 1 AS BIGINT) AS n_columns FROM words GROUP BY sheet""")
def grid_sheets(spark, sf):
    return source.list_sheets(_word_grid(spark, sf))


@query(f"""WITH {LINES_SQL} SELECT sheet, CAST(row_idx - 2 AS INTEGER) AS row_idx, NULLIF(line, '') AS line
FROM lines WHERE row_idx >= 2""")
def grid_body(spark, sf):
    body = reshape.skip_rows(_line_grid(spark, sf), 2)
    return body.select("sheet", "row_idx", cell(0).alias("line"))


@query(f"""WITH {WORDS_SQL}, h AS (SELECT sheet, col_idx, trim(w) AS name FROM words
  WHERE row_idx = 0 AND trim(w) NOT IN ('', 'NaN'))
SELECT w.sheet, CAST(w.row_idx AS INTEGER) AS row_idx, CAST(w.col_idx AS INTEGER) AS col_idx, h.name, NULLIF(w.w, '') AS cell
FROM words w JOIN h ON h.sheet = w.sheet AND h.col_idx = w.col_idx WHERE w.row_idx > 0""")
def grid_header_join(spark, sf):
    return reshape.unpivot_by_header(_word_grid(spark, sf), 0).select(
        "sheet", "row_idx", "col_idx", "name", "cell"
    )


ORDER = ["ts", "event_id"]


def _hours():
    """Hour of the event, never decreasing in ts: splits a hot user's events."""
    return F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour("ts")


def _events(spark, sf):
    return sp.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")


FILLED_SQL = """SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events"""


def _carried(spark, sf):
    rows = _events(spark, sf).withColumn(
        "carried", F.when(F.col("event_type") == "purchase", F.col("value"))
    )
    return ordered.forward_fill(rows, ["carried"], ORDER, ["user_id"], chunk=_hours())


@query(f"SELECT event_id, user_id, event_type, carried FROM ({FILLED_SQL})")
def forward_fill(spark, sf):
    return _carried(spark, sf).select("event_id", "user_id", "event_type", "carried")


@query(f"SELECT event_id, user_id, event_type, carried FROM ({FILLED_SQL}) WHERE carried IS NOT NULL AND event_type IN ('click', 'view')")
def valid_rows(spark, sf):
    return ordered.valid_rows(
        _carried(spark, sf), "event_type", ["click", "view"], "carried"
    ).select("event_id", "user_id", "event_type", "carried")


@query("""WITH m AS (SELECT *, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM events)
SELECT event_id, user_id, event_type, section FROM m WHERE section IS NOT NULL AND event_type <> 'signup'""")
def section_carry(spark, sf):
    opens = F.when(F.col("event_type") == "signup", F.col("event_id"))
    out = ordered.section_carry(
        _events(spark, sf), opens, "section", ORDER, ["user_id"], chunk=_hours()
    )
    return out.select("event_id", "user_id", "event_type", "section")


@query("""WITH cut AS (SELECT user_id, min(struct_pack(ts := ts, id := event_id)) AS first_error FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT event_id, e.user_id, event_type FROM events e LEFT JOIN cut ON cut.user_id = e.user_id
WHERE first_error IS NULL OR struct_pack(ts := e.ts, id := e.event_id) < first_error""")
def cut_at_sentinel(spark, sf):
    out = ordered.cut_at_sentinel(
        _events(spark, sf), F.col("event_type") == "error", ORDER, ["user_id"], chunk=_hours()
    )
    return out.select("event_id", "user_id", "event_type")


@query(f"""WITH {wide(["r_name"])} SELECT r_name AS sheet, {LABEL} AS period, {", ".join(MEASURES)} FROM wide""")
def tidy_series(spark, sf):
    grid = layout.series_grid(sp.wide_series(spark, sf, ["r_name"]), "r_name", MEASURES)
    columns = dict(zip(MEASURES, range(2, 20, 2)))
    return reshape.tidy_series(grid, columns).select("sheet", "period", *MEASURES)


@query(f"""WITH {SALES}, {GROUPED_ALL}, {panel(["group_name", "series_ref"], "grouped")},
members AS (SELECT DISTINCT group_name, series_ref FROM panel), axis AS (SELECT DISTINCT ordinal FROM panel)
SELECT m.group_name, m.series_ref, {LABEL.replace("ordinal", "a.ordinal")} AS period, index_value, qoq, yoy
FROM members m CROSS JOIN axis a LEFT JOIN panel p ON p.group_name = m.group_name AND p.ordinal = a.ordinal""")
def tidy_panel(spark, sf):
    # The column axis is the period dimension: one column of orders, not the panel again.
    dim = star.period_dim(sp.table(spark, sf, "orders"), "o_orderdate")
    axis = dim.agg(F.sort_array(F.collect_set("ordinal"))).scalar()
    measures = {"index": "index_value", "qoq": "qoq", "yoy": "yoy"}
    grid = layout.panel_grid(sp.group_panel(spark, sf), axis, measures)
    return reshape.tidy_panel(grid, measures).select(
        "group_name", "series_ref", "period", "index_value", "qoq", "yoy"
    )


SECTIONS = {
    "index": "All groups", "qoq_pct": "Percentage change from previous quarter",
    "yoy_pct": "Percentage change from same quarter of previous year",
}


@query(f"""WITH {SALES}, {panel(["p_type", "r_name"])}
SELECT p_type AS sheet, {LABEL} AS period, r_name AS region, index_value AS cpi_index, qoq AS qoq_pct_change, yoy AS yoy_pct_change FROM panel""")
def tidy_sections(spark, sf):
    from indexpanel.plans.workbook import REGION_SECTIONS, region_section

    keys = ["p_type", "r_name"]
    rows = index_panel(sp.sales_cells(spark, sf, keys), keys)
    source_of = {"index": "index_value", "qoq_pct": "qoq", "yoy_pct": "yoy"}
    names = region_names(spark, sf)
    table = rows.groupBy("p_type", "ordinal").agg(*[
        F.max(F.when(F.col("r_name") == n, F.col(c))).alias(f"{s}__{n}")
        for s, c in source_of.items() for n in names
    ])
    grid = layout.sections_grid(table, "p_type", names, SECTIONS)
    section = region_section(cell(0))
    tidy = reshape.tidy_sections(
        grid, section, cell(0).contains("Source") & section.isNull(), REGION_SECTIONS
    )
    return tidy.select("sheet", "period", "region", *REGION_SECTIONS.values())
