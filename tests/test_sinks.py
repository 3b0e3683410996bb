"""The snapshot swap: old rows go, failed loads change nothing, readers keep what they opened."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from indexpanel.sinks import tables


def load(spark, years, extra="x"):
    dim = spark.createDataFrame([(y, extra) for y in years], "year int, name string")
    fact = spark.createDataFrame([("a", y, f"p{y}", y * 10) for y in years], "member string, year int, period string, value long")
    return {"fact_a": fact, "dim_year": dim}


def rows(spark, path, name="fact_a"):
    return sorted(tuple(r) for r in tables.read_tables(spark, [name], path)[name].collect())


def test_years_that_new_data_lack_are_gone(spark, tmp_path):
    path = str(tmp_path)
    tables.reload_tables(load(spark, [2001, 2002, 2003]), path)
    assert len(rows(spark, path)) == 3
    tables.reload_tables(load(spark, [2002]), path)
    assert rows(spark, path) == [("a", 2002, "p2002", 20020)] and rows(spark, path, "dim_year") == [(2002, "x")]
    assert tables.read_tables(spark, ["fact_a"], path)["fact_a"].columns == ["member", "year", "period", "value"]


def test_failure_between_tables_leaves_the_old_star_whole(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="no complete load"):
        tables.read_tables(spark, ["fact_a"], path)
    first = tables.reload_tables(load(spark, [2001, 2002]), path)
    broken = load(spark, [2003], "new")
    broken["fact_a"] = broken["fact_a"].withColumn("value", F.raise_error(F.lit("broken input")).cast("long"))
    with pytest.raises(Exception, match="broken input"):
        tables.reload_tables(broken, path)
    assert tables.read_manifest(spark, path)["version"] == first
    assert len(rows(spark, path)) == 2 and rows(spark, path, "dim_year") == [(2001, "x"), (2002, "x")]
    tables.reload_tables(load(spark, [2003], "new"), path)
    assert rows(spark, path, "dim_year") == [(2003, "new")]
    assert len(os.listdir(f"{path}/versions")) == tables.KEPT_VERSIONS  # the failed load's folder is gone too


def test_a_reader_keeps_its_version_over_one_reload(spark, tmp_path):
    path = str(tmp_path)
    tables.reload_tables(load(spark, [2001]), path)
    held = tables.read_tables(spark, ["fact_a"], path)["fact_a"]
    tables.reload_tables(load(spark, [2002, 2003]), path)
    assert [r.year for r in held.collect()] == [2001] and len(rows(spark, path)) == 2


def test_a_star_can_be_rebuilt_from_itself_and_be_empty(spark, tmp_path):
    path = str(tmp_path)
    tables.reload_tables(load(spark, [2001, 2002]), path)
    stored = tables.read_tables(spark, ["fact_a", "dim_year"], path)
    tables.reload_tables({**stored, "fact_a": stored["fact_a"].where("year = 2001")}, path)
    assert len(rows(spark, path)) == 1 and len(rows(spark, path, "dim_year")) == 2
    tables.reload_tables({n: t.limit(0) for n, t in load(spark, [2001]).items()}, path)
    assert rows(spark, path) == [] and tables.read_tables(spark, ["fact_a"], path)["fact_a"].columns[1] == "year"
