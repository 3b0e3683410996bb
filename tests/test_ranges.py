"""Ranks and waterfalls over ranges equal those of one window per period."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from __spark_entry__ import queries
from indexpanel.functions.numbers import exact
from indexpanel.operators.compare import rank_within
from indexpanel.operators.decompose import waterfall
from indexpanel.operators.ranges import rank_of_values, running

SF = "/root/testdata/sf0.001"


def _rows(spark, n: int):
    """Periods of very different sizes, one of them NULL; many ties, a third of all values 0, NULLs, NaN and -0.0."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 10 == 0, None).when(i % 10 < 3, 1).otherwise(2).alias("period"),
        F.concat(F.lit("member "), F.lpad((i * 7919 % n).cast("string"), 8, "0")).alias("member"),
        F.when(i % 3 == 0, F.lit(0.0)).when(i % 31 == 0, None).when(i % 37 == 0, F.lit(float("nan"))).when(i % 41 == 0, F.lit(-0.0))
        .otherwise(F.round((F.pmod(F.xxhash64(i), F.lit(20000)) - 9000) / 100, 2)).alias("v"))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("cuts", [(1024, 16), (64, 1), (8, 3), (1, 1)])
def test_ranks_equal_one_window(spark, descending, cuts):
    rows = _rows(spark, 3000)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    expected = rows.withColumn("r", F.rank().over(W.partitionBy("period").orderBy(order)).cast("bigint"))
    got = rank_of_values(rows, "v", ["period"], "r", descending, *cuts)
    assert got.schema.names == expected.schema.names
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_running_sums_meet_at_the_edges_of_ranges(spark):
    rows = _rows(spark, 2000).filter("v IS NOT NULL")
    key = [F.col("v"), F.col("member")]
    w = W.partitionBy("period").orderBy(F.struct(*key)).rowsBetween(W.unboundedPreceding, 0)
    amount = exact(F.when(F.col("v") > 0, F.col("v")), 2)
    expected = rows.withColumns({"n": F.sum(F.lit(1)).over(w), "total": F.coalesce(F.sum(amount).over(w), F.lit(0).cast("decimal(38,2)"))})
    got = running(rows, ["period"], key, {"n": F.lit(1), "total": amount}, 128, 2)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_waterfall_of_ties_and_nulls(spark):
    rows = _rows(spark, 2500).withColumnRenamed("v", "contribution_pp")
    step = F.coalesce(exact(F.col("contribution_pp"), 2), F.lit(0).cast("decimal(38,2)"))
    w = W.partitionBy("period").orderBy(F.col("contribution_pp").desc_nulls_last(), "member").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(step).over(w)
    expected = rows.withColumns({"bar": F.row_number().over(w).cast("bigint"), "bar_end": end.cast("double"),
                                 "bar_start": (end - step).cast("double")})
    assert sorted(map(repr, waterfall(rows, ["period"], "member").collect())) == sorted(map(repr, expected.collect()))


def test_empty(spark):
    rows = _rows(spark, 10).limit(0)
    assert rank_within(rows, "v", ["period"]).count() == 0
    assert waterfall(rows.withColumnRenamed("v", "contribution_pp"), ["period"], "member").count() == 0


def test_no_window_by_period_alone(spark):
    rows = _rows(spark, 100).withColumnRenamed("v", "contribution_pp")
    for out in (rank_within(rows, "contribution_pp", ["period"]), waterfall(rows, ["period"], "member")):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Window \[.*\], \[period#\d+L?\]", text)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_huge_period_is_dealt_over_tasks(spark):
    """One period of 10^6 members, values all different: the largest range holds a small part of them."""
    rows = spark.range(1_000_000).select(F.pmod("id", F.lit(1)).alias("period"), (F.xxhash64("id") / 7).alias("v"))
    out = running(rows, ["period"], [F.col("v")], {"n": F.lit(1)})
    text = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Window \[.*\], \[period#\d+L?, __range#\d+L?\]", text)
    assert out.agg(F.max("n"), F.count_distinct("n")).first() == (1_000_000, 1_000_000)
    counts = rows.select("period", F.struct("v").alias("k"))
    cuts = counts.groupBy(F.pmod(F.xxhash64("k"), F.lit(1024)).alias("p")).agg(F.min(F.struct(F.xxhash64("k").alias("h"), "k")).alias("m"))
    ordered = [r[0] for r in cuts.select("m.k.v").sort("v").collect()][15::16]
    sizes = rows.select(sum((F.lit(c) <= F.col("v")).cast("int") for c in ordered).alias("r")).groupBy("r").count().collect()
    assert len(sizes) > 50 and max(r["count"] for r in sizes) < 60_000


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["snapshot_rank", "benchmark_join", "waterfall"])
def test_branches_share_one_read_of_the_facts(spark, name):
    out = queries()[name](spark, SF)
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet .*l_orderkey", text)) == 1
