from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from indexpanel.operators import quality, star
from indexpanel.plans import star_load
from indexpanel.sinks import tables
from indexpanel.sources import schema
from indexpanel.sources.files import lookup_df, read_csv
from indexpanel.sources.staged import Pick, load_metrics, load_with_rejects, read_staged, rejects, staged_load

PICKS = [
    Pick("name", 3), Pick("day", 2, "date", strict=False), Pick("year", 1, "int"),
    Pick("rate", 4, "decimal(10,2)"),
]
LINES = [
    '2025,2025-03-31,"Food, drink",2.649', "2.7,bad date,b,-1", "x,2025-03-31,c,1",
    "2025,,d,..", "2025,2025-06-30,e,", "2025,2025-06-30", '2025,2025-06-30,"say ""hi""",1e1',
]


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def test_staged_load(spark):
    got = staged_load(lines_df(spark, LINES), PICKS).orderBy("name").collect()
    assert [tuple(r) for r in got] == [
        ("Food, drink", dt.date(2025, 3, 31), 2025, Decimal("2.65")),
        ("b", None, 3, Decimal("-1.00")),
        ("e", dt.date(2025, 6, 30), 2025, None),
        ('say "hi"', dt.date(2025, 6, 30), 2025, Decimal("10.00")),
    ]


def test_rejects_are_kept_as_data(spark):
    loaded = load_with_rejects(lines_df(spark, LINES), PICKS)
    bad = rejects(loaded).orderBy("line").collect()
    assert [tuple(r) for r in bad] == [("2025,,d,..", "rate"), ("2025,2025-06-30", None), ("x,2025-03-31,c,1", "year")]
    assert tuple(load_metrics(loaded).first()) == (7, 4, 3, 1)


def test_open_quotes_and_missing_fields_are_malformed(spark):
    lines = ['"broken,2020-03-31,x,S,1', 'a,2020-03-31,"x, y",1', 'a,2020-03-31', 'a,b,c,d,e,"', "2020,2020-03-31,n,1,beyond"]
    got = {r.line: r.status for r in load_with_rejects(lines_df(spark, lines), PICKS).collect()}
    assert [got[x] for x in lines] == ["malformed", "rejected", "malformed", "malformed", "loaded"]


def test_staged_files_lose_their_header_only(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(f"h{i}\n{i}a\nh{i}\n")
    (tmp_path / "empty.csv").write_text("")
    assert sorted(r.line for r in read_staged(spark, str(tmp_path)).collect()) == ["0a", "1a", "2a", "h0", "h1", "h2"]
    assert read_staged(spark, str(tmp_path), header=False).count() == 9


def test_a_missing_table_fails_the_count_check(spark):
    counts = quality.row_counts({"a": spark.range(3), "b": spark.range(1)})
    expected = spark.createDataFrame([("a", 3), ("gone", 10)], "table_name string, expected long")
    checked = quality.expect_counts(counts, expected)
    assert {r.table_name: r.status for r in checked.collect()} == {"a": "OK", "b": "EXPECTED nothing", "gone": "MISSING"}
    assert not quality.all_ok(checked).first()[0]


def test_profiles_of_awkward_column_names(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "`a.b` int, `c d` string")
    assert {(r.column_name, r.n_nulls) for r in quality.null_profile(df).collect()} == {("a.b", 1), ("c d", 1)}
    assert {r.column_name for r in quality.not_null(df, ["a.b"]).collect()} == {"a.b"}


def test_declared_tables_carry_comments_and_nulls(spark):
    from indexpanel.sources.schema import STAR, create_tables

    create_tables(spark, "declared")
    try:
        columns = {r.name: r for r in spark.catalog.listColumns("declared.dim_group")}
        comment = STAR["dim_group"]["series_ref"].metadata["comment"]
        assert "'" in comment and columns["series_ref"].description == comment
        meanings = {r.column_name: r.meaning for r in quality.data_dictionary(spark.table("declared.dim_group"), "g").collect()}
        assert meanings["series_ref"] == comment
    finally:
        spark.sql("DROP DATABASE declared CASCADE")


def test_a_scale_zero_number_loses_decimals(spark):
    df = spark.createDataFrame([("2.7",), ("3.4",)], "x string")
    kept = df.select(F.col("x").cast("decimal(10,2)").alias("x"))
    lost = df.select(F.col("x").cast("decimal(38,0)").alias("x"))
    assert tuple(quality.check_scale(kept, "x").first()) == (2, 2, 3.4, 1)
    assert tuple(quality.check_scale(lost, "x").first()) == (2, 0, 3.0, 0)


SERIES = [
    "Dec-19,2019-12-31,2019,Dec,1009.0,0.4,0.1,1071.0,0.6,3.1,1044.0,0.5,1.9",
    "Mar-20,2020-03-31,2020,Mar,1010.0,0.1,1.5,1086.0,1.4,3.4,1052.0,0.8,2.5",
]
GROUPS = [
    "Dec-19,2019-12-31,All groups,S,1044,0.5,1.9", "Mar-20,2020-03-31,All groups,S,1052,0.8,2.5",
    'Mar-20,2020-03-31,"Bread, cereals",S1,1000,0.1,x', 'Mar-20,2020-03-31,"Bread, cereals",S1,1000,0.1,0.2',
]
REGIONAL = ["Mar-20,2020-03-31,2020,Mar,North,1052,0.8,2.5"]


def files(spark):
    return {
        "series": lines_df(spark, SERIES), "groups": lines_df(spark, GROUPS),
        "regional": lines_df(spark, REGIONAL),
    }


COUNTS = {
    "dim_period": 2, "dim_group": 2, "dim_region": 1,
    "fact_allgroups": 2, "fact_groups": 3, "fact_regional": 1,
}


def test_load_star_end_to_end(spark, tmp_path):
    built = star_load.load_star(files(spark))
    for name, df in built.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema.STAR[name]]
    path = str(tmp_path)
    for _ in range(2):  # a full refresh is idempotent
        tables.reload_tables(built, path)
    stored = tables.read_tables(spark, list(built), path)
    report = star_load.verify(spark, stored, COUNTS)
    assert {r.status for r in report.collect()} == {"OK"}
    assert quality.all_ok(report).first()[0] is True
    flags = stored["fact_groups"].groupBy().agg(F.count_if("is_post_covid")).first()[0]
    assert flags == 2
    levels = {r.group_name: r.level for r in stored["dim_group"].collect()}
    assert levels == {"All groups": "group", "Bread, cereals": "subgroup"}
    assert load_metrics(star_load.load_report(files(spark))["groups"]).first().errors_seen == 1


def test_verify_names_what_is_wrong(spark):
    built = star_load.load_star(files(spark))
    built["dim_region"] = built["dim_region"].limit(0)
    built["fact_allgroups"] = built["fact_allgroups"].union(built["fact_allgroups"])
    report = {r.check: (r.n, r.status) for r in star_load.verify(spark, built, COUNTS).collect()}
    assert report["rows dim_region"] == (0, "EXPECTED 1")
    assert report["orphans fact_regional region"] == (1, "BROKEN")
    assert report["duplicate keys fact_allgroups"] == (2, "BROKEN")
    assert report["rows fact_groups"] == (3, "OK")


def test_csv_round_trip(spark, tmp_path):
    lines = [",".join(schema.GROUPS.names), *GROUPS[:2], GROUPS[3]]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    df = read_csv(spark, str(path), schema.GROUPS)
    assert df.filter("group_name = 'Bread, cereals'").first().yoy_pct_change == Decimal("0.20")
    out = str(tmp_path / "out")
    tables.write_csv(df, out, ["group_name", "period_date"])
    again = read_csv(spark, out, schema.GROUPS)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    assert dict(df.dtypes)["period_date"] == "date"


def test_partitioned_overwrite_keeps_other_years(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, 2019), (2, 2020)], "v int, year int"), path, ["year"])
    tables.write_table(spark.createDataFrame([(9, 2020)], "v int, year int"), path, ["year"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 2019), (9, 2020)]


def test_create_tables(spark):
    schema.create_tables(spark, "panel_ddl")
    try:
        names = {r.tableName for r in spark.sql("SHOW TABLES IN panel_ddl").collect()}
        assert names == set(schema.STAR)
        comments = {f.name: f.metadata.get("comment") for f in spark.table("panel_ddl.dim_period").schema}
        assert comments["period_date"] == "last day of the quarter"
    finally:
        spark.sql("DROP DATABASE panel_ddl CASCADE")


def test_profiles_and_keys(spark):
    df = star.conform(
        spark.createDataFrame([("a", "r", None), ("b", None, "group"), ("a", "r", "group")],
                              "group_name string, series_ref string, level string"), "dim_group")
    profile = {r.column_name: (r.n_rows, r.n_nulls, r.status) for r in quality.null_profile(df).collect()}
    assert profile == {
        "group_name": (3, 0, "clean"), "series_ref": (3, 1, "missing values"),
        "level": (3, 1, "missing values"),
    }
    assert [tuple(r) for r in quality.not_null(df, ["group_name", "level"]).collect()] == [("level", 1)]
    assert [tuple(r) for r in quality.pk_duplicates(df, ["group_name"]).collect()] == [("a", 2)]
    words = {r.column_name: (r.data_type, r.meaning, r.example) for r in quality.data_dictionary(df, "t").collect()}
    assert words["level"] == ("string", "group or subgroup", "group")
    assert {tuple(r) for r in quality.distinct_counts(df, ["group_name", "level"]).collect()} == {
        ("group_name", 2), ("level", 1)
    }


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert [r.k for r in quality.orphans(child, parent, "k", "p").collect()] == [2]


def test_panel_gaps(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 2)], "e string, ordinal int")
    assert sorted(map(tuple, quality.panel_gaps(df, ["e"]).collect())) == [("b", 1), ("b", 4)]


def test_dedup_first(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y")], "k int, v string")
    got = quality.dedup_first(df, ["k"], [F.col("v")])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (None, "y")]


def test_expected_counts(spark):
    counts = quality.row_counts({"a": spark.range(3), "b": spark.range(0), "c": spark.range(1)})
    expected = lookup_df(spark, {"a": 3, "b": 2}, "table_name", "expected", ("string", "bigint"))
    got = {r.table_name: r.status for r in quality.expect_counts(counts, expected).collect()}
    assert got == {"a": "OK", "b": "EXPECTED 2", "c": "EXPECTED nothing"}


@pytest.mark.parametrize("name", schema.STAR)
def test_keys_are_columns(name):
    assert set(schema.KEYS[name]) <= set(schema.STAR[name].names)
