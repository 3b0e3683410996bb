"""The report on hand-made star tables; on real CSV files too where PANEL_CSV_DIR names them."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import os

import pytest

from indexpanel.operators import series
from indexpanel.operators.star import build_star
from indexpanel.plans import price_report as report
from indexpanel.plans.star_load import verify
from indexpanel.sources import schema
from indexpanel.sources.files import lookup_df, read_csv

# Published rates of the March 2026 quarter (group, quarterly, annual) and weights.
RATES = [
    ("Alcoholic beverages and tobacco group", 2.0, 2.3), ("All groups", 0.9, 3.1),
    ("Clothing and footwear group", -0.2, 1.3), ("Communication group", 0.2, 4.6),
    ("Education group", 3.4, 4.0), ("Food group", 1.5, 4.0), ("Health group", 3.7, 4.1),
    ("Household contents and services group", 0.2, 0.0),
    ("Housing and household utilities group", 0.6, 3.4),
    ("Miscellaneous goods and services group", 0.9, 2.2),
    ("Recreation and culture group", -1.1, 2.2), ("Transport group", 1.5, 3.3),
]
WEIGHTS = {
    "Food group": 18.45, "Alcoholic beverages and tobacco group": 5.31,
    "Clothing and footwear group": 4.45, "Housing and household utilities group": 29.41,
    "Household contents and services group": 3.58, "Health group": 3.47, "Transport group": 14.34,
    "Communication group": 2.69, "Recreation and culture group": 9.73, "Education group": 1.43,
    "Miscellaneous goods and services group": 7.15,
}
REGIONS = [
    ("Auckland", 2.7), ("Canterbury", 3.1), ("New Zealand", 3.1), ("North Island", 3.0),
    ("Rest of North Island", 3.4), ("Rest of South Island", 3.9), ("South Island", 3.4),
    ("Wellington", 2.8),
]
# Index, quarterly and annual rate of the three components, newest nine quarters.
SERIES = [
    ("Mar-24", 2024, "Mar", 3, 31, 1190, -0.7, 1.6, 1329, 1.6, 5.8, 1267, 0.6, 4.0),
    ("Jun-24", 2024, "Jun", 6, 30, 1184, -0.5, 0.3, 1341, 0.9, 5.4, 1272, 0.4, 3.3),
    ("Sep-24", 2024, "Sep", 9, 30, 1182, -0.2, -1.6, 1358, 1.3, 4.9, 1280, 0.6, 2.2),
    ("Dec-24", 2024, "Dec", 12, 31, 1185, 0.3, -1.1, 1367, 0.7, 4.5, 1287, 0.5, 2.2),
    ("Mar-25", 2025, "Mar", 3, 31, 1194, 0.8, 0.3, 1382, 1.1, 4.0, 1299, 0.9, 2.5),
    ("Jun-25", 2025, "Jun", 6, 30, 1198, 0.3, 1.2, 1391, 0.7, 3.7, 1306, 0.5, 2.7),
    ("Sep-25", 2025, "Sep", 9, 30, 1208, 0.8, 2.2, 1406, 1.1, 3.5, 1319, 1.0, 3.0),
    ("Dec-25", 2025, "Dec", 12, 31, 1216, 0.7, 2.6, 1415, 0.6, 3.5, 1327, 0.6, 3.1),
    ("Mar-26", 2026, "Mar", 3, 31, 1224, 0.7, 2.5, 1430, 1.1, 3.5, 1339, 0.9, 3.1),
]
NOW, NOW_DATE = "Mar-26", dt.date(2026, 3, 31)


def hand_made(spark):
    measures = ", ".join(f"{m} double" for m in schema.SERIES_MEASURES)
    wide = spark.createDataFrame(
        [(p, dt.date(y, m, d), y, q, *map(float, v)) for p, y, q, m, d, *v in SERIES],
        f"period string, period_date date, year int, quarter string, {measures}",
    )
    rows = [(NOW, NOW_DATE, n, f"S{i:02}", 1000.0, q, y) for i, (n, q, y) in enumerate(RATES)]
    subs = [("Household energy", 12.3), ("Property rates and related services", 8.2),
            ("Actual rentals for housing", 1.2), ("Out-patient services", -0.5), ("Fruit", 9.0)]
    rows += [(NOW, NOW_DATE, n, f"S08{i}", 1000.0, 0.0, y) for i, (n, y) in enumerate(subs)]
    groups = spark.createDataFrame(
        rows, "period string, period_date date, group_name string, series_ref string, "
              "index_value double, qoq_pct_change double, yoy_pct_change double")
    regional = spark.createDataFrame(
        [(NOW, NOW_DATE, 2026, "Mar", r, 1000.0, 0.0, y) for r, y in REGIONS],
        "period string, period_date date, year int, quarter string, region string, "
        "cpi_index double, qoq_pct_change double, yoy_pct_change double")
    return wide, groups, regional


def from_files(spark):
    found = {}
    for path in glob.glob(os.path.join(os.environ["PANEL_CSV_DIR"], "*.csv")):
        with open(path, newline="") as f:
            found[tuple(next(csv.reader(f)))] = path
    return [
        read_csv(spark, found[tuple(s.names)], s)
        for s in (schema.SERIES, schema.GROUPS, schema.REGIONAL)
    ]


# Panels from the three published files are tested as well where a folder with them is named.
PANELS = ["hand-made", "files"] if os.environ.get("PANEL_CSV_DIR") else ["hand-made"]


@pytest.fixture(scope="module", params=PANELS)
def star(request, spark):
    panels = hand_made(spark) if request.param == "hand-made" else from_files(spark)
    built = {k: v.cache() for k, v in build_star(*panels).items()}
    built["complete"] = request.param == "files"
    return built


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_current_state(star):
    got = rows(report.current_state(star["fact_allgroups"]))
    assert len(got) == 8 and got[0] == ("Mar-26", 3.1, 2.5, 3.5, "Domestic-led")


def test_shift(star):
    got = rows(report.shift(star["fact_allgroups"]))
    assert got[0][4] is None
    assert got[-2:] == [("Dec-25", 2.6, 3.5, 0.9, -0.4), ("Mar-26", 2.5, 3.5, 1.0, 0.1)]


def test_group_ranking(star):
    got = rows(report.group_ranking(star["fact_groups"], star["dim_group"], NOW))
    assert [r[3] for r in got] == [1, 2, 3, 3, 5, 6, 7, 8, 9, 9, 11, 12]
    assert got[0] == ("Communication group", 4.6, 0.2, 1)
    eleven = report.group_ranking(star["fact_groups"], star["dim_group"], NOW, include_total=False)
    assert eleven.count() == 11


def test_qoq_validation(star):
    got = rows(report.qoq_validation(star["fact_allgroups"]))
    assert [r[3] for r in got] == [0.9, 0.61, 1.0, 0.54, 0.93, 0.55]
    assert [r[4] for r in got] == [0.9, 0.6, 1.0, 0.5, 0.9, 0.5]
    assert all(r[5] for r in got)


def test_rolling_trend(star):
    got = rows(report.rolling_trend(star["fact_allgroups"]))
    assert got[0] == ("Mar-26", 3.1, 2.98, 0.13) and got[1][2] == 2.83


def test_persistent_groups(star):
    args = star["fact_groups"], star["dim_group"], star["fact_allgroups"]
    got = sorted(rows(report.persistent_groups(*args)))
    if star["complete"]:
        assert got == [("Food group", 5, 3.9), ("Housing and household utilities group", 5, 3.7)]
        three = report.persistent_groups(*args, min_periods=3)
        assert three.count() == 6
    else:
        assert [r[0].split()[0] for r in got] == [
            "Communication", "Education", "Food", "Health", "Housing", "Transport"
        ]


def test_regions(star):
    got = rows(report.regions_vs_benchmark(star["fact_regional"], NOW, "Auckland"))
    assert [r[3] for r in got] == [1, 2, 2, 4, 4, 6, 7, 8]
    assert got[0] == ("Rest of South Island", 3.9, 1.2, 1) and got[-1] == ("Auckland", 2.7, 0.0, 8)
    both = {r[0]: r[1:] for r in rows(
        report.regions_vs_references(star["fact_regional"], NOW, "New Zealand", "Auckland"))}
    assert both["Wellington"] == (2.8, -0.3, 0.1, "below")
    assert both["Canterbury"] == (3.1, 0.0, 0.4, "equal")


def test_keyword_drill(star):
    patterns = ["%ousing%", "%ent%", "%lectricity%", "%nergy%", "%ates%", "%nsurance%"]
    got = rows(report.keyword_drill(star["fact_groups"], star["dim_group"], NOW, patterns))
    assert got[0] == ("Household energy", "subgroup", 12.3, *got[0][3:])
    assert ("Housing and household utilities group", "group", 3.4, 0.6) in got
    if star["complete"]:
        assert len(got) == 13


def test_subgroup_drill(spark, star):
    labels = lookup_df(
        spark, {"Household energy": "Energy", "Nothing": "x"}, "group_name", "label", ("string", "string"))
    pattern = "ousing|nergy|ates|ent |nsurance|ater|maintenance"
    got = rows(report.subgroup_drill(star["fact_groups"], NOW, pattern, 3.4, labels))
    by_name = {r[0]: r[1:] for r in got}
    assert by_name["Household energy"] == ("Energy", 12.3, "above headline")
    assert by_name["Actual rentals for housing"] == ("Actual rentals for housing", 1.2, "rising")
    assert "Housing and household utilities group" not in by_name
    assert len(got) == (8 if star["complete"] else 4)


def test_decomposition(spark, star):
    weights = lookup_df(spark, WEIGHTS, "group_name", "weight", ("string", "double"))
    labels = lookup_df(spark, {"Food group": "Food"}, "group_name", "label", ("string", "string"))
    got = report.decomposition(star["fact_groups"], star["fact_allgroups"], weights, labels, NOW).collect()
    points = {r.group_name.split()[0]: r.contribution_pp for r in got}
    assert points == {
        "Food": 0.74, "Alcoholic": 0.12, "Clothing": 0.06, "Housing": 1.0, "Household": 0.0,
        "Health": 0.14, "Transport": 0.47, "Communication": 0.12, "Recreation": 0.21,
        "Education": 0.06, "Miscellaneous": 0.16,
    }
    assert {(r.total_pp, r.residual) for r in got} == {(3.08, 0.02)}
    assert [r.bar for r in got] == list(range(1, 12)) and got[0].bar_start == 0.0
    assert got[-1].bar_end == 3.08
    assert all(a.bar_end == b.bar_start for a, b in zip(got, got[1:]))
    assert got[1].label == "Food" and got[0].label is None


def test_quarterly_share(spark, star):
    weights = lookup_df(spark, WEIGHTS, "group_name", "weight", ("string", "double"))
    labels = lookup_df(spark, {"Food group": "Food"}, "group_name", "label", ("string", "string"))
    got = report.decomposition(
        star["fact_groups"], star["fact_allgroups"], weights, labels, NOW, annual=False).collect()
    shares = {r.group_name: r.share_pct for r in got}
    assert shares["Transport group"] == 23.6 and len(got) == 11
    assert abs(sum(shares.values()) - 100) < 0.5


def test_category_page(star):
    group = "Housing and household utilities group"
    trend = rows(report.group_trend(star["fact_groups"], group))
    assert trend[-1] == ("Mar-26", group, 3.4, 3.1)
    parts = rows(report.group_breakdown(star["fact_groups"], star["dim_group"], group, NOW, 2))
    if star["complete"]:
        assert len(trend) == 5
        assert [r[0] for r in parts] == ["Household energy", "Property rates and related services"]
    else:
        assert parts[0] == ("Household energy", 12.3, 1, "above")


def test_divergence(star):
    parts = report.divergence(star["fact_allgroups"])
    latest = parts["latest"].first()
    assert (latest.period, latest.gap) == ("Mar-26", 1.0)
    first = parts["first_match"].first()
    crossings = [r.period for r in parts["crossings"].orderBy("period_date").collect()]
    runs = parts["regimes"].orderBy("run").collect()
    if star["complete"]:
        assert (first.period, first.gap) == ("Mar-18", 2.6)
        assert crossings == ["Jun-21", "Mar-23"]
        assert [(r.regime, r.first_label, r.last_label) for r in runs] == [
            ("Domestic-led", "Mar-18", "Mar-21"), ("Import-led", "Jun-21", "Dec-22"),
            ("Domestic-led", "Mar-23", "Mar-26"),
        ]
    else:
        assert first.period == "Mar-24" and crossings == [] and len(runs) == 1 and runs[0].length == 9
    assert sum(r.length for r in runs) == star["fact_allgroups"].count()


def test_kpi_row(star):
    got = report.kpi_row(star["fact_allgroups"]).first()
    assert (got.period, float(got.allgroups_yoy_pct), float(got.allgroups_qoq_pct)) == ("Mar-26", 3.1, 0.9)
    assert (got.character, got.mean_4q) == ("Domestic-led", 2.98)


if len(PANELS) > 1:
    def test_peak(star):
        if not star["complete"]:
            return
        from pyspark.sql import functions as F

        fact = star["fact_allgroups"].withColumn("ordinal", F.year("period_date") * 4 + F.quarter("period_date"))
        peak = series.series_range(fact.withColumn("s", F.lit(1)), ["s"], "period", "tradeables_yoy_pct").first()
        assert float(peak.peak) == 8.7 and (peak.first_label, peak.last_label) == ("Mar-18", "Mar-26")

    def test_files_verify(spark, star):
        if not star["complete"]:
            return
        counts = {"dim_period": 33, "dim_group": 56, "dim_region": 8,
                  "fact_allgroups": 33, "fact_groups": 280, "fact_regional": 40}
        tables = {k: v for k, v in star.items() if k != "complete"}
        assert {r.status for r in verify(spark, tables, counts).collect()} == {"OK"}
