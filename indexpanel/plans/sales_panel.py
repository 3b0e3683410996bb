"""The canonical panel on transactional tables: line items priced by quarter of order.

Line items are aggregated to the grain asked for in one pass; only the joins that grain
needs are made, and Catalyst chooses broadcast or sort-merge by the measured table sizes.
Everything else (indices, changes, weights) is computed on the small panel.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexpanel.functions.numbers import from_minor_units, minor_units
from indexpanel.functions.periods import ordinal, ordinal_end, period_label, quarter_name
from indexpanel.functions.text import TOTAL_NAME
from indexpanel.operators.series import index_panel

NATIONAL = "ALL REGIONS"
REF_WIDTH = 10
COMPONENT_SIZE = 25
COMPONENTS = ("tradeables", "nontradeables", "allgroups")

PART_KEYS = ("p_type", "p_brand", "p_name", "component")
REGION_KEYS = ("r_name",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its files are now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter_start(o: int) -> Column:
    year, quarter = divmod(o - 1, 4)
    return F.lit(date(year, quarter * 3 + 1, 1)).cast("timestamp_ntz")


def in_quarters(c: Column, ordinals: Sequence[int]) -> Column:
    """Date ranges of the quarters, as plain comparisons that reach the scan."""
    runs, result = [], None
    for o in sorted(ordinals):
        if runs and runs[-1][1] == o:
            runs[-1][1] = o + 1
        else:
            runs.append([o, o + 1])
    for start, end in runs:
        span = (c >= _quarter_start(start)) & (c < _quarter_start(end))
        result = span if result is None else result | span
    return result


def sales_cells(
    spark: SparkSession, sf_dir: str, keys: Sequence[str],
    ordinals: Sequence[int] | None = None, parts: Column | None = None,
) -> DataFrame:
    """value and quantity per (keys, ordinal), exact.

    Line items whose order isn't there have no cell. Those whose part or place isn't there have none at grains by part or
    by region, whose joins drop them, and count at all other grains, which make no such join; totals differ by them.
    """
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        minor_units(F.col("l_extendedprice")).alias("v"), minor_units(F.col("l_quantity")).alias("q"),
    )
    orders = table(spark, sf_dir, "orders")
    if ordinals is not None:
        orders = orders.filter(in_quarters(F.col("o_orderdate"), ordinals))
    dated = orders.select("o_orderkey", "o_custkey", ordinal(F.col("o_orderdate")).alias("ordinal"))
    places = [k for k in keys if k in REGION_KEYS]
    if places:
        # Orders find their region first: a quarter of the rows line items would shuffle.
        regional = (
            dated.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        dated = regional.select("o_orderkey", "ordinal", *places)
    rows = line.join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
    if parts is not None or any(k in PART_KEYS for k in keys):
        part = table(spark, sf_dir, "part")
        part = part if parts is None else part.filter(parts)
        component = F.when(F.col("p_size") <= COMPONENT_SIZE, COMPONENTS[0]).otherwise(COMPONENTS[1])
        part = part.withColumn("component", component)
        rows = rows.join(
            part.select("p_partkey", *[k for k in keys if k in PART_KEYS]),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    return rows.groupBy(*keys, "ordinal").agg(
        from_minor_units(F.sum("v")).alias("value"), from_minor_units(F.sum("q")).alias("quantity")
    )


def with_levels(cells: DataFrame, entries: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Each cell counted under several overlapping members (itself and its totals)."""
    many = cells.select(*keep, "ordinal", "value", "quantity", F.explode(F.array(*entries)).alias("m"))
    named = many.select(*keep, "ordinal", "value", "quantity", "m.*")
    members = [c for c in named.columns if c not in ("value", "quantity")]
    return named.groupBy(*members).agg(F.sum("value").alias("value"), F.sum("quantity").alias("quantity"))


def with_period(df: DataFrame) -> DataFrame:
    end = ordinal_end(F.col("ordinal"))
    return df.withColumns({
        "period": period_label(end), "period_date": end,
        "year": F.year(end), "quarter": quarter_name(end),
    })


def group_ref() -> Column:
    return F.rpad("p_type", REF_WIDTH, ".")


def _member(name: Column, ref: Column) -> Column:
    return F.struct(name.alias("group_name"), ref.alias("series_ref"))


def group_members(cells: DataFrame, subgroups: bool = True) -> DataFrame:
    """Cells by type and brand as the total, the groups and (optionally) the subgroups."""
    entries = [
        _member(F.lit(TOTAL_NAME), F.lit("TOTAL")),
        _member(F.concat("p_type", F.lit(" group")), group_ref()),
    ]
    if subgroups:
        entries.append(_member(
            F.concat("p_type", F.lit(" / "), "p_brand"), F.concat(group_ref(), F.col("p_brand"))
        ))
    return with_levels(cells, entries)


def group_cells(
    spark: SparkSession, sf_dir: str, subgroups: bool = True,
    ordinals: Sequence[int] | None = None, parts: Column | None = None,
) -> DataFrame:
    keys = ["p_type", "p_brand"] if subgroups else ["p_type"]
    return group_members(sales_cells(spark, sf_dir, keys, ordinals, parts), subgroups)


def group_panel(
    spark: SparkSession, sf_dir: str, subgroups: bool = True,
    ordinals: Sequence[int] | None = None, parts: Column | None = None,
) -> DataFrame:
    """Total, groups and (optionally) subgroups, each an indexed series."""
    return index_panel(group_cells(spark, sf_dir, subgroups, ordinals, parts), ["group_name"])


def region_members(cells: DataFrame) -> DataFrame:
    """Cells by region as the regions and the national total."""
    return with_levels(cells, [
        F.struct(F.col("r_name").alias("region")), F.struct(F.lit(NATIONAL).alias("region"))
    ])


def region_panel(spark: SparkSession, sf_dir: str, ordinals: Sequence[int] | None = None) -> DataFrame:
    return index_panel(region_members(sales_cells(spark, sf_dir, ["r_name"], ordinals)), ["region"])


def type_panel(spark: SparkSession, sf_dir: str, ordinals: Sequence[int] | None = None) -> DataFrame:
    return index_panel(sales_cells(spark, sf_dir, ["p_type"], ordinals), ["p_type"])


def wide_of(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells by component as one row per (by, quarter): index, qoq and yoy of both components
    and their total."""
    entries = [
        F.struct(F.col("component").alias("series")), F.struct(F.lit(COMPONENTS[2]).alias("series"))
    ]
    panel = index_panel(with_levels(cells, entries, by), [*by, "series"])
    names = {"index": "index_value", "qoq_pct": "qoq", "yoy_pct": "yoy"}
    return panel.groupBy(*by, "ordinal").agg(*[
        F.max(F.when(F.col("series") == c, F.col(source))).alias(f"{c}_{name}")
        for c in COMPONENTS for name, source in names.items()
    ])


def wide_series(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> DataFrame:
    return wide_of(sales_cells(spark, sf_dir, [*by, "component"]), by)


def national_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide series as a panel of one named series."""
    return wide_series(spark, sf_dir).withColumn("series", F.lit(TOTAL_NAME))
