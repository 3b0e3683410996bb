from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from indexpanel.functions import numbers, periods, text


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


@pytest.mark.parametrize(("cell", "number"), [
    ("12.5", 12.5), (" 7 ", 7.0), ("-0.3", -0.3), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
    ("1_000", 1000.0), ("inf", float("inf")), ("..", None), ("", None), ("n/a", None),
    ("nan", None), ("1d", None), ("1,000", None), ("_1", None), (None, None), ("\t3\n", 3.0),
])
def test_clean_number(spark, cell, number):
    assert column(spark, [cell], "string", numbers.clean_number) == [number]


def test_round_half_up(spark):
    xs = [0.25, -0.25, 0.35, 2.825, -0.04, 0.0, None]
    got = column(spark, xs, "double", lambda c: numbers.round_half_up(c, 1))
    assert got == [0.3, -0.3, 0.4, 2.8, 0.0, 0.0, None]
    assert str(got[4]) == "0.0"


def test_minor_units_are_exact(spark):
    xs = [0.01 * i for i in range(-300, 300)] + [123456789.99]
    got = column(spark, xs, "double", lambda c: numbers.from_minor_units(numbers.minor_units(c)))
    assert [float(g) for g in got] == [round(x, 2) for x in xs]


def test_pct_change_guards_the_base(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (90.0, -100.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(numbers.pct_change(F.col("a"), F.col("b"))).collect()]
    assert got == [10.0, None, -190.0, None]


def test_number_text(spark):
    assert column(spark, [0.735, -0.1], "double", numbers.signed_points) == ["+0.74pp", "-0.10pp"]
    assert column(spark, [3.14], "double", numbers.percent_text) == ["3.1%"]


@pytest.mark.parametrize(("label", "date"), [
    ("Mar-25", dt.date(2025, 3, 31)), (" Dec-99 ", dt.date(2099, 12, 31)), ("Jan-25", None),
    ("Mar-2025", None), ("Mar25", None), ("mar-25", None), ("Mar-2-5", None), ("", None), (None, None),
])
def test_parse_period(spark, label, date):
    assert column(spark, [label], "string", periods.parse_period) == [date]


def test_ordinal_round_trip(spark):
    dates = [dt.date(2024, m, 15) for m in range(1, 13)] + [dt.date(1969, 12, 31)]
    ends = column(spark, dates, "date", lambda c: periods.ordinal_end(periods.ordinal(c)))
    assert ends[0] == dt.date(2024, 3, 31) and ends[-2] == dt.date(2024, 12, 31)
    labels = column(spark, ends, "date", periods.period_label)
    assert labels[0] == "Mar-24" and labels[-1] == "Dec-69"


def test_group_level(spark):
    names = ["Food group", "ALL GROUPS ", "Group insurance", "Rent", " Food Group "]
    assert column(spark, names, "string", text.group_level) == [
        "group", "group", "subgroup", "subgroup", "group"
    ]


def test_classify_and_bands(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)], "a double, b double")
    rows = df.select(
        text.classify_sign(F.col("a"), F.col("b")),
        text.classify_sign(F.col("a"), F.col("b"), unknown="?"),
        text.band(F.col("a"), [(1.5, "high"), (0, "low")], "none"),
        text.compare_band(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("Domestic-led", "Domestic-led", "high", "above"), ("Import-led", "Import-led", "low", "below"),
        ("Balanced", "Balanced", "low", "equal"), ("Balanced", "?", "none", "equal"),
    ]


def test_keywords(spark):
    names = ["Housing", "HOUSING", "Rent", None]
    assert column(spark, names, "string", lambda c: text.any_like(c, ["%ous%", "%ent%"])) == [True, False, True, None]
    assert column(spark, names, "string", lambda c: text.any_like(c, ["%ous%"], True)) == [True, True, False, None]
    assert column(spark, names, "string", lambda c: text.any_regex(c, "ous|x")) == [True, True, False, None]


def test_short_label(spark):
    df = spark.createDataFrame([("x" * 40, None), ("y", "Y")], "n string, l string")
    got = [r[0] for r in df.select(text.short_label(F.col("l"), F.col("n"))).collect()]
    assert got == ["x" * 35, "Y"]


@pytest.mark.parametrize("x, digits, expected", [
    (1e18, 2, 1e18), (2e13, 6, 2e13), (0.49999999999999994, 0, 0.0), (0.5, 0, 1.0), (-0.5, 0, -1.0), (2.675, 2, 2.68), (-0.001, 2, 0.0),
    (float("inf"), 2, float("inf")), (float("-inf"), 2, float("-inf")), (1e300, 3, 1e300), (None, 2, None)])
def test_rounding_has_no_range(spark, x, digits, expected):
    got = spark.createDataFrame([(x,)], "x double").select(numbers.round_half_up(F.col("x"), digits)).first()[0]
    assert got == expected and str(got) != "-0.0"


def test_nan_stays_nan_and_amounts_that_are_none_are_null(spark):
    df = spark.createDataFrame([(v,) for v in (float("nan"), float("inf"), 1e18, 12.34, -0.01, None)], "x double")
    assert math.isnan(df.select(numbers.round_half_up(F.col("x"), 2)).first()[0])
    assert [r[0] for r in df.select(numbers.minor_units(F.col("x"))).collect()] == [None, None, None, 1234, -1, None]
    from indexpanel.operators.quality import unusable_amounts

    assert unusable_amounts(df, ["x"]).first().n_unusable == 3


def test_exact_means_beyond_a_long(spark):
    from indexpanel.operators.compare import persistence

    df = spark.createDataFrame([("m", 2e12, 1.0), ("m", 4e12, 1.0), ("m", float("nan"), 1.0)], "m string, v double, r double")
    assert persistence(df, "m", "v", "r").first().mean_value == 3e12
