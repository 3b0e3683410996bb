from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from indexpanel.operators import reshape
from indexpanel.plans import workbook
from indexpanel.sources import grid as source

GRID = "sheet string, row_idx int, cells array<string>"


def grid(spark, sheets):
    rows = [(s, i, cells) for s, lines in sheets.items() for i, cells in enumerate(lines)]
    return spark.createDataFrame(rows, GRID).repartition(3)


def flat(values):
    """Measures with an empty footnote column after each."""
    return [x for v in values for x in (v, None)]


def test_extract_series(spark):
    one = [str(x) for x in range(1, 10)]
    lines = [["Title"]] * 8 + [["2017", "Mar", *flat(one)]]
    lines += [
        [None, "Dec", *flat(one)],                      # no year yet: dropped
        ["2018", " Mar ", *flat(["999", "..", "", *one[3:]])],
        [None, "Jun", "1003"],                          # a short row
        ["Notes", "Quarterly", *flat(one)],
        ["2019", None, *flat(one)],                     # a year on a row without quarter
        ["", "Sep", *flat(one)],
    ]
    got = workbook.extract_series(grid(spark, {"1": lines, "other": lines})).orderBy("period_date").collect()
    assert [r.period for r in got] == ["Mar-18", "Jun-18", "Sep-19"]
    assert got[0].period_date == dt.date(2018, 3, 31) and got[0].year == 2018
    assert got[0].tradeables_index == 999.0 and got[0].tradeables_qoq_pct is None
    assert got[0].tradeables_yoy_pct is None and got[0].allgroups_yoy_pct == 9.0
    assert got[1].tradeables_index == 1003.0 and got[1].allgroups_index is None


def group_sheet(values, tail=()):
    lines = [["Source: in the preamble"]] + [["x"]] * 5
    lines.append([None, "", " Mar-25 ", "Jun-25", "NaN", ""])
    lines += [[n, ref, *v, "9", "9"] for n, ref, v in values]
    return lines + [["  ", "Z", "1", "1"], *tail, ["Source: agency"], ["Late", "L", "1", "1"]]


def test_extract_groups(spark):
    sheets = {
        "2.01": group_sheet([(" Food group ", "A1", ["10", ".."]), ("Bread, cereals", None, ["20", "21"])]),
        "2.02": group_sheet([("Food group", "A1", ["1", "2"]), ("Only here", "X", ["1", "1"])]),
        "2.03": group_sheet([("Bread, cereals", "A11", ["x", "4"])]),
    }
    got = workbook.extract_groups(grid(spark, sheets)).orderBy("group_name", "period_date").collect()
    assert [tuple(r) for r in got] == [
        ("Mar-25", dt.date(2025, 3, 31), "Bread, cereals", "", 20.0, None, None, 1),
        ("Jun-25", dt.date(2025, 6, 30), "Bread, cereals", "", 21.0, None, 4.0, 1),
        ("Mar-25", dt.date(2025, 3, 31), "Food group", "A1", 10.0, 1.0, None, 1),
        ("Jun-25", dt.date(2025, 6, 30), "Food group", "A1", None, 2.0, None, 1),
    ]


def region_sheet():
    return [
        ["2001", "Mar", "7", "7"], ["t"], ["t"], ["t"], ["t"],
        [None, "NaN", "North ", "South"],
        [None, "Mar", "1", "1"],                         # before any marker
        ["All groups"],
        [None, "Sep", "5", "5"],                         # no year after the marker
        ["2025", "Mar", "100", "200"], [None, "Jun", "101", ".."], ["All groups 2025", "Sep", "1", "1"],
        ["Percentage change from previous quarter"],
        ["2025", "Mar", "0.1", "0.2"], [None, "Jun", "..", ".."],
        ["Percentage change from same quarter of previous year"],
        [None, "Dec", "..", ".."],                       # every measure missing: no row
        ["2025", "Mar", "3.1", "3.2"],
        ["Source: agency"], ["2025", "Dec", "1", "1"],
    ]


@pytest.mark.parametrize("chunked", [False, True])
def test_extract_regions(spark, chunked):
    skew = {"chunk": F.floor(F.col("row_idx") / 3)} if chunked else {}
    got = workbook.extract_regions(grid(spark, {"17": region_sheet()}), **skew)
    assert [tuple(r) for r in got.orderBy("region", "period_date").collect()] == [
        ("Mar-25", dt.date(2025, 3, 31), 2025, "Mar", "North", 100.0, 0.1, 3.1),
        ("Jun-25", dt.date(2025, 6, 30), 2025, "Jun", "North", 101.0, None, None),
        ("Sep-25", dt.date(2025, 9, 30), 2025, "Sep", "North", 1.0, None, None),
        ("Mar-25", dt.date(2025, 3, 31), 2025, "Mar", "South", 200.0, 0.2, 3.2),
        ("Sep-25", dt.date(2025, 9, 30), 2025, "Sep", "South", 1.0, None, None),
    ]


def test_header_columns_and_skip(spark):
    g = grid(spark, {"s": [["a", " ", "NaN", " b "], ["1", "2", "3", "4"]]})
    assert [r.row_idx for r in reshape.skip_rows(g, 1).collect()] == [0]
    named = reshape.unpivot_by_header(g, 0).orderBy("col_idx").collect()
    assert [(r.row_idx, r.col_idx, r.name, r.cell) for r in named] == [(1, 0, "a", "1"), (1, 3, "b", "4")]


def test_pick_columns(spark):
    g = grid(spark, {"s": [["a", "", "c"], ["x"]]})
    got = reshape.pick_columns(g, ["row_idx"], {"last": 2, "second": 1}).orderBy("row_idx")
    assert [tuple(r) for r in got.collect()] == [(0, "c", None), (1, None, None)]


def test_pivot_of_unpivot_is_identity(spark):
    rnd = random.Random(3)
    data = [(i, *[rnd.choice([None, float(rnd.randint(0, 9))]) for _ in range(3)]) for i in range(50)]
    wide = spark.createDataFrame(data, "k int, a double, b double, c double")
    long = reshape.unpivot(wide, ["k"], ["a", "b", "c"])
    back = reshape.pivot_first(long, ["k"], "metric", "value", ["a", "b", "c"])
    assert sorted(map(tuple, back.collect())) == sorted(data)


def test_pivot_first_takes_the_first_non_null(spark):
    df = spark.createDataFrame(
        [("k", "a", 2, 5.0), ("k", "a", 1, None), ("k", "a", 3, 1.0), ("k", "b", 1, None)],
        "k string, m string, o int, v double",
    )
    assert tuple(reshape.pivot_first(df, ["k"], "m", "v", ["a", "b"], ["o"]).first()) == ("k", 5.0, None)


def test_merge_measures_is_a_left_merge(spark):
    base = spark.createDataFrame([("a", 1.0, "r1"), ("b", None, "r2")], "k string, x double, ref string")
    y = spark.createDataFrame([("a", 5.0), ("c", 6.0)], "k string, y double")
    got = reshape.merge_measures(base, {"y": y}, ["k"], "x").orderBy("k").select("k", "x", "ref", "y")
    assert [tuple(r) for r in got.collect()] == [("a", 1.0, "r1", 5.0), ("b", None, "r2", None)]


def test_merged_keys_that_repeat_are_rejects(spark):
    base = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 1.0)], "k string, x double")
    y = spark.createDataFrame([("b", 5.0), ("b", 6.0), ("c", 1.0)], "k string, y double")
    merged = reshape.merge_measures(base, {"y": y}, ["k"], "x")
    assert {(r.k, r.n_x, r.n_y) for r in merged.collect()} == {("a", 2, 0), ("b", 1, 2)}
    assert {r.k for r in reshape.repeated(merged, ["x", "y"]).collect()} == {"a", "b"}


def test_repeated_names_are_kept_apart_and_reported(spark):
    sheets = {s: group_sheet([("Fish", "S1", ["1", "2"]), ("Fish", "S2", ["3", "4"]), ("Meat", "M", ["5", "6"])])
              for s in ("2.01", "2.02", "2.03")}
    g = grid(spark, sheets)
    rows = {(r.group_name, r.period): r for r in workbook.extract_groups(g).collect()}
    fish = rows["Fish", "Mar-25"]
    assert (fish.series_ref, fish.index_value, fish.n_rows) == ("S1", 1.0, 2) and rows["Meat", "Mar-25"].n_rows == 1
    lost = reshape.repeated_names(g, ["2.01"], 6).collect()
    assert sorted((r.group_name, r.series_ref) for r in lost) == [("Fish", "S1"), ("Fish", "S2")]


def test_values_without_a_pivot_column_are_counted(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "z", 2.0), (1, None, 3.0), (1, "z", None)], "k int, n string, v double")
    assert tuple(reshape.pivot_first(df, ["k"], "n", "v", ["a"], other="n_other").first()) == (1, 1.0, 2)


def test_pivot_mean_and_columns(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (2, "y", 3.0)], "d int, r string, v double")
    wide = reshape.pivot_mean(df, ["d"], "r", "v", ["x", "y"]).orderBy("d")
    assert [tuple(r) for r in wide.collect()] == [(1, 1.5, None), (2, None, 3.0)]
    assert reshape.columns_present(wide, ["y", "z", "x"]) == ["y", "x"]
    assert reshape.rename(wide, {"x": "q", "zz": "n"}).columns == ["d", "q", "y"]


def test_read_grid(spark, tmp_path):
    (tmp_path / "2.01.csv").write_text('a,"b, c",\n,,3\nlast\n')
    (tmp_path / "1.csv").write_text("only\n")
    g = source.read_grid(spark, str(tmp_path), 3)
    rows = g.filter("sheet = '2.01'").orderBy("row_idx").select(
        "row_idx", *[reshape.cell(i).alias(f"c{i}") for i in range(3)]
    ).collect()
    assert [tuple(r) for r in rows] == [(0, "a", "b, c", None), (1, None, None, "3"), (2, "last", None, None)]
    (tmp_path / "q.csv").write_text('"say ""hi"", you",x\r\n"two\nlines",,y,z,more\r\n\r\n"",w\n')
    quoted = source.read_grid(spark, str(tmp_path / "q.csv"), 3).orderBy("row_idx").collect()
    assert [r.cells for r in quoted] == [
        ['say "hi", you', "x", None], ["two\nlines", None, "y", "z", "more"], [None, None, None], ["", "w", None]]
    (tmp_path / "q.csv").unlink()
    listed = source.list_sheets(g).orderBy("sheet").collect()
    assert [(r.sheet, r.n_rows, r.last_row) for r in listed] == [("1", 1, 0), ("2.01", 3, 2)]
    assert source.head_rows(g, "2.01", 2).count() == 2


def test_grid_from_columns(spark):
    df = spark.createDataFrame([("s", 4, 1, None)], "s string, i bigint, c0 int, c1 string")
    got = source.grid_from_columns(df, F.col("s"), "i", ["c0", "c1"])
    assert tuple(got.first()) == ("s", 4, ["1", None])
