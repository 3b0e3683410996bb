"""Weighted decomposition, lookups and hierarchy roll-up.

Bars of a waterfall are placed over ranges of contributions (see `ranges`). Totals of a period are windows over its members:
joined back, they would read the facts once more wherever Spark prunes other columns in the totals' branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.numbers import exact, round_half_up
from indexpanel.operators.ranges import descending, running


def with_lookup(
    df: DataFrame, table: DataFrame, key: str, name: str, fallback=None
) -> DataFrame:
    """Left lookup of `name` by `key` in a two-column table; missing keys get the fallback."""
    joined = df.join(table.select(key, name), key, "left")
    return joined if fallback is None else joined.withColumn(name, F.coalesce(F.col(name), fallback))


def unmatched_keys(table: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Lookup keys the data never uses."""
    return table.select(key).join(df.select(key).distinct(), key, "left_anti")


def share_of_total(df: DataFrame, value: str, by: Sequence[str], name: str, digits: int = 2) -> DataFrame:
    total = F.sum(value).over(W.partitionBy(*by))
    return df.withColumn(
        name,
        round_half_up(F.try_divide(F.col(value).cast("double"), total.cast("double")) * 100, digits),
    )


def weights_total(
    weights: DataFrame, weight: str, expected: float = 100.0, tolerance: float = 0.05,
    by: Sequence[str] = (),
) -> DataFrame:
    """Sum of the weights, distance from 100, and whether it is tolerable."""
    total = F.sum(exact(F.col(weight))).cast("double")
    return weights.groupBy(*by).agg(F.count("*").alias("members"), total.alias("__total")).select(
        *by, "members",
        round_half_up(F.col("__total"), 2).alias("total"),
        round_half_up(F.col("__total") - expected, 2).alias("deviation"),
        (F.abs(F.col("__total") - expected) <= tolerance).alias("ok"),
    )


def contribution(
    df: DataFrame, change: str, weight: str, by: Sequence[str], headline: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """Points each member adds to the total change: change % x weight % / 100, rounded.

    Adds the total of the rounded points per `by` and, given the headline change, the residual.
    """
    points = round_half_up(F.col(change) * F.col(weight) / 100, digits)
    out = df.withColumn("contribution_pp", points)
    total = F.sum(exact(F.col("contribution_pp"), digits)).over(W.partitionBy(*by))
    out = out.withColumn("total_pp", total.cast("double"))
    if headline:
        out = out.withColumn("residual", round_half_up(F.col(headline) - F.col("total_pp"), digits))
    return out


def contribution_share(
    df: DataFrame, change: str, weight: str, by: Sequence[str], digits: int = 1
) -> DataFrame:
    """Each member's part of the total change, in percent, from the unrounded points."""
    points = exact(F.col(change) * F.col(weight) / 100)
    total = F.sum(points).over(W.partitionBy(*by))
    share = F.try_divide(points.cast("double"), total.cast("double")) * 100
    return df.withColumn("share_pct", round_half_up(share, digits))


def waterfall(df: DataFrame, by: Sequence[str], member: str) -> DataFrame:
    """Start and end of each bar, largest contribution first (ties by name)."""
    step = F.coalesce(exact(F.col("contribution_pp"), 2), F.lit(0).cast("decimal(38,2)"))
    placed = running(df.withColumn("__step", step), by, [*descending(F.col("contribution_pp")), F.col(member)],
                     {"bar": F.lit(1), "__end": F.col("__step")})
    return placed.select(
        *df.columns, "bar", F.col("__end").cast("double").alias("bar_end"),
        (F.col("__end") - F.col("__step")).cast("double").alias("bar_start"))


def rollup_check(
    fact: DataFrame, ref: str, prefix_length: int, by: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Parents (ref no longer than the prefix) beside the sum of their children, in one pass.

    A child without a parent, or a parent without children, shows as a NULL.
    """
    is_parent = F.length(ref) <= prefix_length
    sums = [
        F.sum(F.when(is_parent == side, F.col(m))).alias(f"{m}{suffix}")
        for m in measures for side, suffix in ((True, ""), (False, "_rolled_up"))
    ]
    same = [F.col(m).eqNullSafe(F.col(f"{m}_rolled_up")) for m in measures]
    return (
        fact.groupBy(F.substring(ref, 1, prefix_length).alias(ref), *by)
        .agg(*sums)
        .withColumn("ok", reduce(and_, same))
    )


def code_prefixes(ref: Column, shortest: int = 1) -> Column:
    """All prefixes of a code from `shortest` characters on, itself included, shortest first: SE9, SE90, SE904."""
    n = F.char_length(ref)
    return F.when(n >= shortest, F.transform(F.sequence(F.lit(shortest), F.greatest(n, F.lit(shortest))),
                                             lambda i: F.substring(ref, F.lit(1), i)))


def path_prefixes(ref: Column, separator: str = " ") -> Column:
    """All leading parts of a path, itself included, shortest first."""
    parts = F.split(ref, rf"\Q{separator}\E")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), separator))


def closure(codes: DataFrame, ref: str, prefixes: Column) -> DataFrame:
    """(ancestor, descendant, steps): every pair of codes of which one leads to the other, each code with itself at 0 steps.

    `prefixes` are the array of all codes that could stand above `ref`, shortest first and itself last (see `code_prefixes`); those
    that no row has are left out, and `steps` counts the missing ones too. One expansion and one join by code, for any depth.
    NULL codes are in no pair, repeated ones count once.
    """
    members = codes.select(F.col(ref).alias("descendant"), prefixes.alias("__above")).where(
        F.col("descendant").isNotNull()).dropDuplicates(["descendant"])
    pairs = members.select("descendant", F.size("__above").alias("__depth"), F.posexplode("__above").alias("__at", "ancestor"))
    known = members.select(F.col("descendant").alias("ancestor"))
    return pairs.join(known, "ancestor", "left_semi").select(
        "ancestor", "descendant", (F.col("__depth") - 1 - F.col("__at")).alias("steps"))


def hierarchy(pairs: DataFrame, shortest_depth: Column | None = None) -> DataFrame:
    """(ref, parent, steps_up, n_children, is_leaf, is_orphan, is_gap) of every code of a closure.

    The parent is the nearest code above. An orphan has none although `shortest_depth` (a Column over `ref`, TRUE at the top level)
    says that it should; at a gap the level right above is missing.
    """
    up = pairs.where("steps > 0").groupBy(F.col("descendant").alias("ref")).agg(
        F.min(F.struct("steps", "ancestor")).alias("__up"))
    every = pairs.where("steps = 0").select(F.col("descendant").alias("ref"))
    linked = every.join(up, "ref", "left").select(
        "ref", F.col("__up.ancestor").alias("parent"), F.col("__up.steps").alias("steps_up"))
    children = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("ref")).agg(F.count("*").alias("n_children"))
    top = shortest_depth if shortest_depth is not None else F.lit(False)
    return linked.join(children, "ref", "left").select(
        "ref", "parent", "steps_up", F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        F.col("n_children").isNull().alias("is_leaf"), (F.col("parent").isNull() & ~top).alias("is_orphan"),
        F.coalesce(F.col("steps_up") > 1, F.lit(False)).alias("is_gap"))


def rollup_closure(fact: DataFrame, ref: str, pairs: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every code beside the sum of the leaves below it, per `by`, for a hierarchy of any depth.

    `pairs` is a closure of the members, which need not have facts. The facts are aggregated to (code, by), meet the codes above
    theirs in one join, and are summed there. A leaf has no sum from below (NULL) and is ok; a code whose leaves have no row
    of that period, or the other way round, is not. A code that the closure lacks is a leaf. Rows of a NULL code are left out.
    """
    cells = fact.where(F.col(ref).isNotNull()).groupBy(F.col(ref).alias("__ref"), *by).agg(*[F.sum(m).alias(m) for m in measures])
    inner = pairs.where("steps > 0").select(F.col("ancestor").alias("descendant")).distinct().withColumn("__inner", F.lit(True))
    above = pairs.join(inner, "descendant", "left").select(
        F.col("descendant").alias("__ref"), F.col("ancestor").alias("__above"), (F.col("steps") == 0).alias("__self"), "__inner")
    met = cells.join(above, "__ref", "left").withColumns({
        "__above": F.coalesce("__above", "__ref"), "__self": F.coalesce("__self", F.lit(True)),
        "__leaf": F.col("__inner").isNull()})
    sums = [F.sum(F.when(side, F.col(m))).alias(f"{m}{suffix}") for m in measures
            for side, suffix in ((F.col("__self"), ""), (~F.col("__self") & F.col("__leaf"), "_rolled_up"))]
    same = reduce(and_, [F.col(m).eqNullSafe(F.col(f"{m}_rolled_up")) for m in measures])
    return (
        met.groupBy(F.col("__above").alias(ref), *by)
        .agg(*sums, F.bool_or(F.col("__self") & F.col("__leaf")).alias("__leaf"))
        .withColumn("ok", F.col("__leaf") | same).drop("__leaf")
    )
