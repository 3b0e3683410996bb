"""The report's questions on the star tables (dim_*, fact_*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexpanel.functions.numbers import round_half_up
from indexpanel.functions.text import TOTAL_NAME, band, compare_band, is_group_name, short_label
from indexpanel.operators import compare, decompose, drill, series

ALL = "__series"


def _one_series(fact: DataFrame) -> DataFrame:
    """The national series as a panel of one: its windows hold one row per quarter."""
    return fact.withColumn(ALL, F.lit(TOTAL_NAME))


def _double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _r1(c: str) -> Column:
    return round_half_up(F.col(c), 1)


def current_state(fact: DataFrame, n: int = 8) -> DataFrame:
    out = series.character(fact, "nontradeables_yoy_pct", "tradeables_yoy_pct", "inflation_character")
    return series.latest_n(out, n, F.desc("period_date")).select(
        "period", _r1("allgroups_yoy_pct").alias("all_groups_yoy"),
        _r1("tradeables_yoy_pct").alias("tradeables_yoy"),
        _r1("nontradeables_yoy_pct").alias("nontradeables_yoy"), "inflation_character",
    )


def shift(fact: DataFrame) -> DataFrame:
    out = series.component_gap(
        _one_series(fact), "nontradeables_yoy_pct", "tradeables_yoy_pct", [ALL], "period_date",
        "domestic_gap", "gap_change",
    )
    return out.orderBy("period_date").select(
        "period", _r1("tradeables_yoy_pct").alias("tradeables_yoy"),
        _r1("nontradeables_yoy_pct").alias("nontradeables_yoy"), "domestic_gap", "gap_change",
    )


def _snapshot(fact: DataFrame, dim: DataFrame, period: str) -> DataFrame:
    return fact.filter(F.col("period") == period).join(dim.select("group_name", "level"), "group_name")


def group_ranking(fact: DataFrame, dim: DataFrame, period: str, include_total: bool = True) -> DataFrame:
    rows = _snapshot(fact, dim, period).filter("level = 'group'")
    if not include_total:
        rows = rows.filter(F.col("group_name") != TOTAL_NAME)
    ranked = compare.rank_within(rows, "yoy_pct_change", ["period"], "yoy_rank")
    return ranked.orderBy("yoy_rank", "group_name").select(
        "group_name", _r1("yoy_pct_change").alias("yoy_pct"),
        _r1("qoq_pct_change").alias("qoq_pct"), "yoy_rank",
    )


def qoq_validation(fact: DataFrame, n: int = 6) -> DataFrame:
    rows = _double(_one_series(fact), "allgroups_index", "allgroups_qoq_pct")
    out = series.recompute_check(rows, "allgroups_index", "allgroups_qoq_pct", [ALL], "period_date")
    return series.latest_n(out, n, F.desc("period_date")).select(
        "period", _r1("allgroups_index").alias("index_now"), _r1("index_prev").alias("index_prev"),
        F.col("calculated").alias("calculated_qoq"),
        round_half_up(F.col("allgroups_qoq_pct"), 2).alias("stored_qoq"), "matches",
    )


def rolling_trend(fact: DataFrame, n: int = 8, width: int = 4) -> DataFrame:
    rows = _double(_one_series(fact), "allgroups_yoy_pct")
    out = series.rolling_mean(
        rows, "allgroups_yoy_pct", [ALL], width, "rolling_4q_avg", "above_below_trend", "period_date"
    )
    return series.latest_n(out, n, F.desc("period_date")).select(
        "period", _r1("allgroups_yoy_pct").alias("yoy_pct"), "rolling_4q_avg", "above_below_trend"
    )


def persistent_groups(fact: DataFrame, dim: DataFrame, national: DataFrame, min_periods: int | None = None) -> DataFrame:
    """Groups above the national rate in every quarter of the group panel."""
    rows = (
        fact.join(dim.filter("level = 'group'").select("group_name"), "group_name")
        .filter(F.col("group_name") != TOTAL_NAME)
        .join(national.select("period", "allgroups_yoy_pct"), "period")
    )
    return compare.persistent_above(
        rows, "group_name", "yoy_pct_change", "allgroups_yoy_pct", fact, min_periods=min_periods
    ).select(
        "group_name", F.col("periods_above").alias("quarters_above"),
        F.col("mean_value").alias("avg_yoy_pct"),
    )


def regions_vs_benchmark(fact: DataFrame, period: str, benchmark: str) -> DataFrame:
    rows = fact.filter(F.col("period") == period)
    out = compare.vs_members(
        rows, "yoy_pct_change", "region", {"ppts_above_benchmark": benchmark}, ["period"], required=True
    )
    ranked = compare.rank_within(out, "yoy_pct_change", ["period"], "inflation_rank")
    return ranked.orderBy("inflation_rank", "region").select(
        "region", _r1("yoy_pct_change").alias("yoy_pct"), "ppts_above_benchmark", "inflation_rank"
    )


def regions_vs_references(fact: DataFrame, period: str, national: str, benchmark: str) -> DataFrame:
    rows = fact.filter(F.col("period") == period)
    out = compare.vs_members(
        rows, "yoy_pct_change", "region", {"vs_national": national, "vs_benchmark": benchmark}, ["period"]
    )
    return out.withColumn("band", compare_band(F.col("vs_national"), 0.0)).select(
        "region", _r1("yoy_pct_change").alias("yoy_pct"), "vs_national", "vs_benchmark", "band"
    )


def keyword_drill(fact: DataFrame, dim: DataFrame, period: str, patterns: Sequence[str]) -> DataFrame:
    rows = drill.keyword_like(_snapshot(fact, dim, period), "group_name", patterns)
    return rows.orderBy(F.desc("yoy_pct_change"), "group_name").select(
        "group_name", "level", _r1("yoy_pct_change").alias("yoy_pct"),
        _r1("qoq_pct_change").alias("qoq_pct"),
    )


def subgroup_drill(
    fact: DataFrame, period: str, pattern: str, headline: float, labels: DataFrame
) -> DataFrame:
    """Matching subgroups with display label and band against the group's headline rate."""
    rows = drill.keyword_regex(fact.filter(F.col("period") == period), "group_name", pattern)
    named = decompose.with_lookup(rows, labels, "group_name", "label")
    return named.orderBy(F.desc("yoy_pct_change"), "group_name").select(
        "group_name", short_label(F.col("label"), F.col("group_name")).alias("label"),
        _r1("yoy_pct_change").alias("yoy_pct"),
        band(F.col("yoy_pct_change"), [(F.lit(headline), "above headline"), (F.lit(0), "rising")], "falling")
        .alias("band"),
    )


def group_trend(fact: DataFrame, group: str) -> DataFrame:
    """One group's annual rate beside the total's, by quarter."""
    out = drill.slicer(fact, "group_name", group, TOTAL_NAME, "yoy_pct_change", ["period"], "total_yoy")
    return out.orderBy("period_date").select(
        "period", "group_name", _r1("yoy_pct_change").alias("yoy_pct"), _r1("total_yoy").alias("total_yoy_pct")
    )


def group_breakdown(fact: DataFrame, dim: DataFrame, group: str, period: str, k: int | None = None) -> DataFrame:
    """Subgroups of one group (by reference prefix), fastest first, against the group's rate."""
    parent = dim.filter(F.col("group_name") == group).select("series_ref").scalar()
    rows = fact.filter(F.col("period") == period).join(dim, "group_name").filter(
        F.col("series_ref").startswith(parent)
    )
    headline = compare.member_value("yoy_pct_change", "group_name", group, ["period"])
    below = rows.withColumn("headline", headline).filter(F.col("group_name") != group)
    ranked = compare.rank_within(below, "yoy_pct_change", ["period"])
    top = ranked if k is None else ranked.filter(F.col("rank") <= k)
    return top.orderBy("rank", "group_name").select(
        "group_name", _r1("yoy_pct_change").alias("yoy_pct"), "rank",
        compare_band(F.col("yoy_pct_change"), F.col("headline")).alias("band"),
    )


def decomposition(
    fact: DataFrame, national: DataFrame, weights: DataFrame, labels: DataFrame, period: str,
    annual: bool = True,
) -> DataFrame:
    """Contribution of each group to the (annual or quarterly) headline, largest first."""
    change, headline = (
        ("yoy_pct_change", "allgroups_yoy_pct") if annual else ("qoq_pct_change", "allgroups_qoq_pct")
    )
    rows = fact.filter(F.col("period") == period).filter(is_group_name(F.col("group_name"))).join(
        national.select("period", F.col(headline).cast("double")), "period"
    )
    rows = _double(rows, change)
    weighted = decompose.with_lookup(
        decompose.with_lookup(rows, weights, "group_name", "weight"), labels, "group_name", "label"
    )
    out = decompose.contribution(weighted, change, "weight", ["period"], headline)
    shared = decompose.contribution_share(out, change, "weight", ["period"])
    return decompose.waterfall(shared, ["period"], "group_name").orderBy(
        "bar"
    ).select(
        "group_name", "label", "weight", change, "contribution_pp", "total_pp",
        "residual", "share_pct", "bar", "bar_start", "bar_end",
    )


def divergence(fact: DataFrame) -> Mapping[str, DataFrame]:
    """Gap series, its first positive quarter, its crossings, its regimes, the latest quarter."""
    rows = _double(_one_series(fact), "tradeables_yoy_pct", "nontradeables_yoy_pct").withColumn(
        "gap", round_half_up(F.col("nontradeables_yoy_pct") - F.col("tradeables_yoy_pct"), 2)
    )
    cols = ["period", "tradeables_yoy_pct", "nontradeables_yoy_pct", "gap"]
    return {
        "gap": rows.select("period_date", *cols),
        "first_match": series.first_match(rows, F.col("gap") > 0, [ALL], cols, "period_date").drop(ALL),
        "crossings": series.sign_change(rows, "gap", [ALL], "period_date").select(
            "period_date", "period", "value_before", "gap"
        ),
        "regimes": series.regime_runs(
            rows, "gap", [ALL], "period", "period_date", ("Domestic-led", "Import-led")
        ).drop(ALL),
        "latest": series.latest(rows, [ALL], cols, "period_date").drop(ALL),
    }


def kpi_row(fact: DataFrame) -> DataFrame:
    """Annual and quarterly rate, character, four-quarter mean of the newest quarter."""
    rows = _double(_one_series(fact), "allgroups_yoy_pct")
    rolled = series.rolling_mean(rows, "allgroups_yoy_pct", [ALL], 4, "mean_4q", order="period_date")
    named = series.character(rolled, "nontradeables_yoy_pct", "tradeables_yoy_pct")
    cols = ["period", "allgroups_yoy_pct", "allgroups_qoq_pct", "character", "mean_4q"]
    return series.latest(named, [ALL], cols, "period_date").drop(ALL)
