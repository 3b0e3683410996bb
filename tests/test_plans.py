"""What the plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from indexpanel.operators import ordered
from indexpanel.plans import sales_panel as sp
from indexpanel.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def under(text, needle):
    """The operators below each line that contains the needle."""
    lines = [x for x in text.split("\n") if "- " in x or "FileScan" in x]
    depth = [re.match(r"^[ :+\-]*", x).end() for x in lines]
    for i, line in enumerate(lines):
        if needle in line:
            yield [x for j, x in enumerate(lines[i + 1:], i + 1)
                   if all(depth[k] > depth[i] for k in range(i + 1, j + 1))]


@pytest.mark.parametrize("key", QUERIES)
def test_plan_at_scale(no_broadcast, key):
    """With no table small enough to broadcast."""
    text = plan(QUERIES[key](no_broadcast, SF))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    for below in under(text, "SinglePartition"):
        scans = [i for i, x in enumerate(below) if "FileScan" in x]
        # What reaches one task has been aggregated where it was read.
        assert all(any("Aggregate" in x for x in below[:i]) for i in scans[:1]), below


def test_nothing_is_force_broadcast(no_broadcast):
    for key in QUERIES:
        assert "BroadcastHashJoin" not in plan(QUERIES[key](no_broadcast, SF)), key


def scans(text, table):
    return sum("FileScan" in x and f"{table}.parquet" in x for x in text.split("\n"))


@pytest.mark.parametrize("key, table, most", [
    ("forward_fill", "events", 2), ("valid_rows", "events", 2), ("section_carry", "events", 2), ("cut_at_sentinel", "events", 2),
    ("grid_header_join", "documents", 1), ("merge_measures", "orders", 1)])
def test_big_tables_are_read_once_or_twice(spark, key, table, most):
    assert scans(plan(QUERIES[key](spark, SF)), table) <= most


def test_one_numeric_order_pivots_by_hash_aggregation(spark):
    from indexpanel.operators.reshape import pivot_first

    rows = spark.range(10).select("id", F.lit("a").alias("n"), F.col("id").cast("double").alias("v"))
    assert "SortAggregate" not in plan(pivot_first(rows, ["id"], "n", "v", ["a"], ["id"]))


def test_reference_values_are_aggregated_before_they_are_joined(spark):
    from indexpanel.operators.compare import vs_members

    rows = spark.range(10).select(F.lit("m").alias("member"), F.lit(1.0).alias("v"), F.col("id").alias("ordinal"))
    assert "Window" not in plan(vs_members(rows, "v", "member", {"d": "m"}, ["ordinal"]))


def test_tables_are_read_as_they_are(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    assert sp.table(spark, str(tmp_path), "t").count() == 3
    spark.range(5).write.mode("append").parquet(path)
    assert sp.table(spark, str(tmp_path), "t").count() == 8


def test_scan_is_pruned_and_filtered(spark):
    text = plan(sp.sales_cells(spark, SF, ["p_type"], (8002, 8005, 8006)))
    line = re.search(r"ReadSchema: struct<(l_[^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", line)) == {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"}
    assert "GreaterThanOrEqual(o_orderdate" in text and "customer.parquet" not in text
    total = plan(sp.sales_cells(spark, SF, []))
    assert "part.parquet" not in total and "o_custkey" not in total


def test_a_chunk_not_a_user_is_the_unit_of_work(spark):
    events = sp.table(spark, SF, "events")
    chunk = F.hour("ts")
    text = plan(ordered.forward_fill(events, ["value"], ["ts"], ["user_id"], chunk=chunk))
    windows = [x for x in text.split("\n") if "Exchange hashpartitioning(user_id" in x]
    assert any("__chunk" in x for x in windows)


def test_hot_join_key_is_split(spark):
    """One order with most of the lines: AQE splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        line = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, F.col("id") % 1000).otherwise(F.lit(7)).alias("l_orderkey"),
            F.col("id").alias("v"),
        )
        orders = spark.range(1000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 27).alias("ordinal"))
        cells = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("ordinal").agg(F.sum("v"))
        assert cells.count() == 27
        cells.collect()
        assert "skew=true" in plan(cells)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
