"""Cross-sections: ranks, benchmarks, persistence, spread.

Ranks are taken over ranges of values (see `ranges`), and reference values are aggregated per period and joined back, so no task
holds a whole period. `top_k_per_group` is a window by group, which Spark cuts to the k highest before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.numbers import exact, round_half_up
from indexpanel.functions.text import compare_band
from indexpanel.operators.ranges import rank_of_values


def rank_within(
    df: DataFrame, value: str, by: Sequence[str], name: str = "rank", descending: bool = True
) -> DataFrame:
    """Competition rank (1, 2, 2, 4) of a number, per period of any size; NULLs rank last."""
    return rank_of_values(df, value, by, name, descending)


def top_k_per_group(df: DataFrame, value: str, by: Sequence[str], k: int, name: str = "rank") -> DataFrame:
    """The k highest of each group, ties included; pruned before the shuffle."""
    rank = F.rank().over(W.partitionBy(*by).orderBy(F.col(value).desc_nulls_last()))
    return df.withColumn(name, rank.cast("bigint")).filter(F.col(name) <= k)


def member_value(value: str, member: str, which: str, by: Sequence[str]) -> Column:
    """The value one named member has in the same period: a self-join without the join."""
    return F.max(F.when(F.col(member) == which, F.col(value))).over(W.partitionBy(*by))


def member_rows(
    df: DataFrame, value: str, member: str, references: Mapping[str, str], by: Sequence[str], required: bool = False
) -> DataFrame:
    """One row per period: the values of named members, {output column: member}, aggregated before they are joined.

    `required` leaves out periods in which one of them is missing.
    """
    found = df.filter(F.col(member).isin(*references.values())).groupBy(*by).agg(
        *[F.max(F.when(F.col(member) == m, F.col(value))).alias(n) for n, m in references.items()],
        *[F.count_if(F.col(member) == m).alias(f"__has_{n}") for n, m in references.items()],
    )
    for n in references if required else ():
        found = found.filter(F.col(f"__has_{n}") > 0)
    return found.select(*by, *references)


def vs_members(
    df: DataFrame, value: str, member: str, references: Mapping[str, str], by: Sequence[str],
    digits: int = 2, required: bool = False, found_in: DataFrame | None = None,
) -> DataFrame:
    """Difference (points) from named members: {output column: member}.

    `required` drops periods in which a reference member is missing. Its values are one row per period, joined back, so
    no task holds a whole period. They are looked up in `found_in`, where `df` holds more than its plan needs for them.
    """
    refs = member_rows(df if found_in is None else found_in, value, member, {f"__{n}": m for n, m in references.items()}, by, required)
    out = df.join(refs, list(by), "inner" if required else "left").select(*df.columns, *[f"__{n}" for n in references])
    return out.withColumns({
        n: round_half_up(F.col(value) - F.col(f"__{n}"), digits) for n in references
    }).drop(*[f"__{n}" for n in references])


def vs_level(
    df: DataFrame, value: str, level: float, name: str = "distance", band: str = "band",
    labels: Sequence[str] = ("above", "below", "on target"), digits: int = 2,
) -> DataFrame:
    """Distance to a fixed reference level, with its band."""
    return df.withColumns({
        name: round_half_up(F.col(value) - F.lit(level), digits),
        band: compare_band(F.col(value), F.lit(level), labels),
    })


def persistence(df: DataFrame, member: str, value: str, reference: str) -> DataFrame:
    """Per member: periods seen, periods above the reference, mean value."""
    above = F.when(F.col(value) > F.col(reference), 1).otherwise(0)
    usable = exact(F.col(value))
    mean = F.try_divide(F.sum(usable).cast("double"), F.count(usable).cast("double"))
    return df.groupBy(member).agg(
        F.count("*").alias("periods"),
        F.sum(above).cast("bigint").alias("periods_above"),
        round_half_up(mean, 1).alias("mean_value"),
    )


def persistent_above(
    df: DataFrame, member: str, value: str, reference: str, periods: DataFrame | None = None,
    period: str = "period", min_periods: int | None = None, share: float = 1.0,
) -> DataFrame:
    """Members above the reference in all periods, in that `share` of them, or in at least `min_periods`.

    The number of periods is counted in `periods` (a period dimension), else in `df`.
    """
    per = persistence(df, member, value, reference)
    if min_periods is not None:
        return per.filter(F.col("periods_above") >= min_periods)
    total = (df if periods is None else periods).agg(F.count_distinct(period)).scalar()
    return per.filter(F.col("periods_above") >= F.lit(share) * total)


def spread(
    df: DataFrame, by: Sequence[str], member: str, value: str, digits: int = 2
) -> DataFrame:
    """Highest and lowest member of each period (ties: first by name) and their distance."""
    set_ = F.col(value).isNotNull()
    return df.groupBy(*by).agg(
        F.min_by(member, F.when(set_, F.struct(-F.col(value), F.col(member)))).alias("highest"),
        F.max(value).alias("highest_value"),
        F.min_by(member, F.when(set_, F.struct(F.col(value), F.col(member)))).alias("lowest"),
        F.min(value).alias("lowest_value"),
        round_half_up(F.max(value) - F.min(value), digits).alias("spread"),
    )
