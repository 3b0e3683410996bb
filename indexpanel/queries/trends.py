"""Series over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.functions.numbers import round_half_up
from indexpanel.functions.text import TOTAL_NAME
from indexpanel.operators import compare, reshape, series
from indexpanel.plans import sales_panel as sp
from indexpanel.queries.base import (
    GROUPED, LABEL, SALES, TARGET, panel, query, r, wide,
)

TYPE_SQL = f"{SALES}, {panel(['p_type'])}"
CHARACTER_SQL = """CASE WHEN nontradeables_yoy_pct > tradeables_yoy_pct THEN 'Domestic-led'
  WHEN tradeables_yoy_pct > nontradeables_yoy_pct THEN 'Import-led' ELSE 'Balanced' END"""
SUM6 = "SUM(CAST({0} AS DECIMAL(18,6)))"


@query(f"""WITH {wide()}
SELECT {LABEL} AS period, allgroups_yoy_pct AS all_groups_yoy, tradeables_yoy_pct AS tradeables_yoy,
  nontradeables_yoy_pct AS nontradeables_yoy, {CHARACTER_SQL} AS character
FROM wide ORDER BY ordinal DESC LIMIT 8""")
def component_character(spark, sf):
    rows = sp.with_period(sp.national_series(spark, sf))
    named = series.character(rows, "nontradeables_yoy_pct", "tradeables_yoy_pct")
    return series.latest_n(named, 8, F.desc("ordinal")).select(
        "period", F.col("allgroups_yoy_pct").alias("all_groups_yoy"),
        F.col("tradeables_yoy_pct").alias("tradeables_yoy"),
        F.col("nontradeables_yoy_pct").alias("nontradeables_yoy"), "character",
    )


@query(f"""WITH {wide()}, g AS (SELECT *, nontradeables_yoy_pct - tradeables_yoy_pct AS gap FROM wide)
SELECT {LABEL} AS period, tradeables_yoy_pct AS tradeables_yoy, nontradeables_yoy_pct AS nontradeables_yoy,
  {r("gap", 1)} AS gap, {r("(gap - lag(gap) OVER (ORDER BY ordinal))", 2)} AS gap_change FROM g""")
def component_gap(spark, sf):
    rows = sp.with_period(sp.national_series(spark, sf))
    out = series.component_gap(rows, "nontradeables_yoy_pct", "tradeables_yoy_pct", ["series"])
    return out.select(
        "period", F.col("tradeables_yoy_pct").alias("tradeables_yoy"),
        F.col("nontradeables_yoy_pct").alias("nontradeables_yoy"), "gap", "gap_change",
    )


@query(f"""WITH {TYPE_SQL},
l AS (SELECT *, lag(index_value) OVER (PARTITION BY p_type ORDER BY ordinal) AS index_prev FROM panel)
SELECT p_type, {LABEL} AS period, index_value, index_prev,
  {r("((index_value - index_prev) / NULLIF(index_prev, 0) * 100)", 2)} AS qoq_pct FROM l""")
def pct_change(spark, sf):
    rows = sp.type_panel(spark, sf).withColumn("index_prev", series.previous("index_value", ["p_type"]))
    change = F.try_divide(F.col("index_value") - F.col("index_prev"), F.col("index_prev")) * 100
    return sp.with_period(rows).select(
        "p_type", "period", "index_value", "index_prev", round_half_up(change, 2).alias("qoq_pct")
    )


@query(f"""WITH {SALES}, {panel(["p_type", "p_brand"])}
SELECT p_type, p_brand, {LABEL} AS period, index_value, yoy FROM panel""")
def yoy_by_ordinal(spark, sf):
    keys = ["p_type", "p_brand"]
    rows = series.index_panel(sp.sales_cells(spark, sf, keys), keys)
    return sp.with_period(rows).select(*keys, "period", "index_value", "yoy")


@query(f"""WITH {TYPE_SQL},
l AS (SELECT *, lag(index_value) OVER (PARTITION BY p_type ORDER BY ordinal) AS index_prev FROM panel),
c AS (SELECT *, (index_value - index_prev) / NULLIF(index_prev, 0) * 100 AS calc FROM l)
SELECT p_type, {LABEL} AS period, index_value AS index_now, index_prev, {r("calc", 2)} AS calculated, qoq AS stored,
  {r("calc", 1)} = qoq AS matches, abs(calc - qoq) <= 0.05::DOUBLE + 0.01::DOUBLE AS within_tol FROM c""")
def recompute_check(spark, sf):
    rows = series.recompute_check(sp.type_panel(spark, sf), "index_value", "qoq", ["p_type"])
    return sp.with_period(rows).select(
        "p_type", "period", F.col("index_value").alias("index_now"), "index_prev", "calculated",
        F.col("qoq").alias("stored"), "matches", "within_tol",
    )


ROLLING_SQL = f"""m AS (SELECT *, CAST({SUM6.format("yoy")} OVER w AS DOUBLE) / NULLIF(count(yoy) OVER w, 0) AS mean4 FROM {{0}}
  WINDOW w AS (PARTITION BY {{1}} ORDER BY ordinal ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {TYPE_SQL}, {ROLLING_SQL.format("panel", "p_type")}
SELECT p_type, {LABEL} AS period, yoy AS yoy_pct, {r("mean4", 2)} AS rolling_mean,
  {r("(yoy - mean4)", 2)} AS deviation FROM m""")
def rolling_mean(spark, sf):
    rows = series.rolling_mean(sp.type_panel(spark, sf), "yoy", ["p_type"], 4, deviation="deviation")
    return sp.with_period(rows).select(
        "p_type", "period", F.col("yoy").alias("yoy_pct"), "rolling_mean", "deviation"
    )


GAP_SQL = f"""{wide(["r_name"])},
gaps AS (SELECT r_name, ordinal, {LABEL} AS period, {r("(nontradeables_yoy_pct - tradeables_yoy_pct)", 2)} AS gap FROM wide)"""
SIGNED_SQL = f"""{GAP_SQL},
nz AS (SELECT r_name, ordinal, CAST(sign(gap) AS INTEGER) AS s FROM gaps WHERE gap <> 0),
signed AS (SELECT g.*, (SELECT arg_max(s, nz.ordinal) FROM nz WHERE nz.r_name = g.r_name AND nz.ordinal <= g.ordinal) AS sgn,
  (SELECT arg_max(s, nz.ordinal) FROM nz WHERE nz.r_name = g.r_name AND nz.ordinal < g.ordinal) AS sgn_before FROM gaps g)"""


def _gaps(spark, sf):
    rows = sp.with_period(sp.wide_series(spark, sf, ["r_name"]))
    gap = F.col("nontradeables_yoy_pct") - F.col("tradeables_yoy_pct")
    return rows.withColumn("gap", round_half_up(gap, 2))


@query(f"""WITH {GAP_SQL} SELECT r_name, arg_min(period, ordinal) AS period, arg_min(gap, ordinal) AS gap
FROM gaps WHERE gap > 0 GROUP BY r_name""")
def first_match(spark, sf):
    return series.first_match(_gaps(spark, sf), F.col("gap") > 0, ["r_name"], ["period", "gap"])


@query(f"""WITH {SIGNED_SQL},
v AS (SELECT *, lag(gap) OVER (PARTITION BY r_name ORDER BY ordinal) AS value_before FROM signed)
SELECT r_name, period, value_before, gap FROM v WHERE sgn <> sgn_before""")
def sign_change(spark, sf):
    out = series.sign_change(_gaps(spark, sf), "gap", ["r_name"])
    return out.select("r_name", "period", "value_before", "gap")


@query(f"""WITH {SIGNED_SQL},
k AS (SELECT *, count(*) FILTER (sgn IS DISTINCT FROM sgn_before) OVER (PARTITION BY r_name ORDER BY ordinal) AS run
  FROM signed WHERE sgn IS NOT NULL)
SELECT r_name, CAST(run AS BIGINT) AS run, CASE WHEN min(sgn) > 0 THEN 'Domestic-led' ELSE 'Import-led' END AS regime,
  arg_min(period, ordinal) AS first_label, arg_max(period, ordinal) AS last_label, CAST(count(*) AS BIGINT) AS length,
  {r(f"(CAST({SUM6.format('gap')} AS DOUBLE) / NULLIF(count(gap), 0))", 2)} AS mean_value
FROM k GROUP BY r_name, run""")
def regime_runs(spark, sf):
    return series.regime_runs(
        _gaps(spark, sf), "gap", ["r_name"], "period", labels=("Domestic-led", "Import-led")
    )


BRAND_SQL = f"{SALES}, {panel(['p_brand'])}"


def _brands(spark, sf):
    return sp.with_period(
        series.index_panel(sp.sales_cells(spark, sf, ["p_brand"]), ["p_brand"])
    )


@query(f"""WITH {BRAND_SQL}
SELECT p_brand, arg_max({LABEL}, ordinal) AS period, arg_max(index_value, ordinal) AS index_value FROM panel GROUP BY p_brand""")
def latest_per_series(spark, sf):
    return series.latest(_brands(spark, sf), ["p_brand"], ["period", "index_value"])


@query(f"""WITH {BRAND_SQL}, k AS (SELECT *, {LABEL} AS period FROM panel),
top AS (SELECT p_brand, max(yoy) AS peak FROM k GROUP BY p_brand)
SELECT k.p_brand, CAST(count(*) AS BIGINT) AS n_rows, arg_min(period, ordinal) AS first_label,
  arg_max(period, ordinal) AS last_label, max(yoy) AS peak,
  arg_min(period, ordinal) FILTER (yoy = peak) AS peak_label FROM k JOIN top USING (p_brand) GROUP BY k.p_brand""")
def series_range(spark, sf):
    return series.series_range(_brands(spark, sf), ["p_brand"], "period", "yoy")


@query(f"""WITH {wide()}, n AS (SELECT *, 'All groups' AS series, allgroups_yoy_pct AS yoy FROM wide),
{ROLLING_SQL.format("n", "series")}
SELECT {LABEL} AS period, yoy AS annual, allgroups_qoq_pct AS quarterly, {CHARACTER_SQL} AS character,
  {r("mean4", 2)} AS mean_4q FROM m ORDER BY ordinal DESC LIMIT 1""")
def kpi_row(spark, sf):
    rows = sp.with_period(sp.national_series(spark, sf))
    rolled = series.rolling_mean(rows, "allgroups_yoy_pct", ["series"], 4, "mean_4q")
    named = series.character(rolled, "nontradeables_yoy_pct", "tradeables_yoy_pct")
    cols = ["period", "allgroups_yoy_pct", "allgroups_qoq_pct", "character", "mean_4q"]
    return series.latest(named, ["series"], cols).drop("series").withColumnsRenamed(
        {"allgroups_yoy_pct": "annual", "allgroups_qoq_pct": "quarterly"}
    )


@query(f"""WITH {SALES}, {GROUPED}, {panel(["group_name"], "grouped")}
SELECT {LABEL} AS period, yoy AS yoy_pct, {r(f"(yoy - {TARGET}::DOUBLE)", 2)} AS distance,
  CASE WHEN yoy > {TARGET} THEN 'above' WHEN yoy < {TARGET} THEN 'below' ELSE 'on target' END AS band
FROM panel WHERE group_name = 'All groups'""")
def vs_target(spark, sf):
    # The total needs no group key: line items are aggregated by quarter alone.
    cells = sp.sales_cells(spark, sf, []).withColumn("series", F.lit(TOTAL_NAME))
    rows = sp.with_period(series.index_panel(cells, ["series"]))
    return compare.vs_level(rows, "yoy", TARGET).select(
        "period", F.col("yoy").alias("yoy_pct"), "distance", "band"
    )


# The pivot's columns in the checking SQL; the query takes them from the region table.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def region_names(spark, sf):
    """The members of the region dimension, which pivots into columns."""
    return [row.r_name for row in sp.table(spark, sf, "region").select("r_name").distinct().orderBy("r_name").collect()]


@query(f"""WITH {SALES}, {panel(["r_name"])}
SELECT {LABEL} AS period, {", ".join(f"avg(yoy) FILTER (r_name = '{n}') AS \"{n}\"" for n in REGIONS)}
FROM panel GROUP BY ordinal""")
def pivot_region(spark, sf):
    rows = sp.with_period(series.index_panel(sp.sales_cells(spark, sf, ["r_name"]), ["r_name"]))
    out = reshape.pivot_mean(rows, ["ordinal", "period"], "r_name", "yoy", region_names(spark, sf))
    return out.orderBy("ordinal").drop("ordinal")
