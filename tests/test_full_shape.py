"""Questions whose answers need panels of the full shape: 33 quarters, 56 members x 5, 8 regions x 5, with numbers of our own."""

from __future__ import annotations

import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from indexpanel.operators import compare, series
from indexpanel.operators.star import build_star
from indexpanel.plans.star_load import verify
from indexpanel.sources import schema

MONTHS = {3: "Mar", 6: "Jun", 9: "Sep", 12: "Dec"}
GAPS = [1.5] * 12 + [-0.5] * 9 + [2.0] * 12


def quarter(k: int) -> tuple:
    year, month = 2010 + k // 4, (k % 4 + 1) * 3
    day = calendar.monthrange(year, month)[1]
    return f"{MONTHS[month]}-{year % 100}", dt.date(year, month, day), year, MONTHS[month]


@pytest.fixture(scope="module")
def star(spark):
    wide = []
    for k, gap in enumerate(GAPS):
        tradeables = 3.0 + (5.0 if k == 15 else 0.0)
        measures = [1000.0 + k, 0.5, tradeables, 1100.0 + k, 0.7, tradeables + gap, 1050.0 + k, 0.6, tradeables + gap / 2]
        wide.append((*quarter(k), *measures))
    names = ["All groups", *[f"G{i} group" for i in range(11)], *[f"S{i}" for i in range(44)]]
    groups = []
    for k in range(28, 33):
        period, day, _, _ = quarter(k)
        for i, n in enumerate(names):
            above = i in (3, 20) or (i in (4, 5) and k != 30)
            groups.append((period, day, n, f"R{i:02}", 1000.0, 0.1, 3.0 if i == 0 else 4.0 if above else 2.0))
    places = [(*quarter(k), f"P{i}", 1000.0, 0.2, 2.5 + i / 10) for k in range(28, 33) for i in range(8)]
    head = "period string, period_date date, year int, quarter string"
    return build_star(
        spark.createDataFrame(wide, f"{head}, " + ", ".join(f"{m} double" for m in schema.SERIES_MEASURES)),
        spark.createDataFrame(groups, "period string, period_date date, group_name string, series_ref string, index_value double, "
                                      "qoq_pct_change double, yoy_pct_change double"),
        spark.createDataFrame(places, f"{head}, region string, cpi_index double, qoq_pct_change double, yoy_pct_change double"),
    )


def national(star):
    gap = F.col("nontradeables_yoy_pct") - F.col("tradeables_yoy_pct")
    return star["fact_allgroups"].select("period", (F.year("period_date") * 4 + F.quarter("period_date")).alias("ordinal"),
                                         gap.cast("double").alias("gap"), F.lit("all").alias("s"),
                                         F.col("tradeables_yoy_pct").cast("double").alias("t"))


def test_counts_keys_and_references(spark, star):
    counts = {"dim_period": 33, "dim_group": 56, "dim_region": 8, "fact_allgroups": 33, "fact_groups": 280, "fact_regional": 40}
    assert {r.status for r in verify(spark, star, counts).collect()} == {"OK"}
    wrong = {**counts, "fact_groups": 279, "fact_else": 1}
    bad = {r.check: r.status for r in verify(spark, star, wrong).collect() if r.check.startswith("rows") and r.status != "OK"}
    assert bad == {"rows fact_groups": "EXPECTED 279", "rows fact_else": "MISSING"}


def test_two_crossings_and_three_regimes(star):
    crossings = series.sign_change(national(star), "gap", ["s"]).orderBy("ordinal").collect()
    assert [r.period for r in crossings] == [quarter(12)[0], quarter(21)[0]]
    runs = series.regime_runs(national(star), "gap", ["s"], "period").orderBy("run").collect()
    assert [(r.regime, r.length, r.mean_value) for r in runs] == [("positive", 12, 1.5), ("negative", 9, -0.5), ("positive", 12, 2.0)]


def test_peak(star):
    peak = series.series_range(national(star), ["s"], "period", "t").first()
    assert (peak.n_rows, peak.first_label, peak.last_label, peak.peak, peak.peak_label) == (
        33, quarter(0)[0], quarter(32)[0], 8.0, quarter(15)[0])


def test_two_members_are_above_the_total_in_all_periods(star):
    rows = star["fact_groups"].select("group_name", "period", F.col("yoy_pct_change").cast("double").alias("yoy"))
    totals = compare.member_rows(rows, "yoy", "group_name", {"total": "All groups"}, ["period"])
    judged = rows.filter("group_name <> 'All groups'").join(totals, "period")
    assert {r.group_name for r in compare.persistent_above(judged, "group_name", "yoy", "total").collect()} == {"G2 group", "S8"}
    assert {r.group_name for r in compare.persistent_above(judged, "group_name", "yoy", "total", share=0.8).collect()} == {
        "G2 group", "G3 group", "G4 group", "S8"}
