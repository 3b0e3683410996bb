"""Period-over-period metrics on a panel: one row per (series, period).

Windows are partitioned by series, so a task holds one series: at most one row per period.
Raw facts are aggregated to the panel grain before they come here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.numbers import exact, pct_change, round_half_up
from indexpanel.functions.text import classify_sign


def at_offset(c: str | Column, series: Sequence[str], k: int, ordinal: str = "ordinal") -> Column:
    """Value exactly k periods ago; NULL when that period is missing, unlike LAG."""
    w = W.partitionBy(*series).orderBy(ordinal).rangeBetween(-k, -k)
    return F.first(c).over(w)


def previous(c: str | Column, series: Sequence[str], order: str = "ordinal", k: int = 1) -> Column:
    """LAG: the value k rows ago, whatever period that is."""
    return F.lag(c, k).over(W.partitionBy(*series).orderBy(order))


def with_change(
    df: DataFrame, value: str, series: Sequence[str], name: str, k: int = 1,
    ordinal: str = "ordinal", digits: int | None = 1,
) -> DataFrame:
    """Percent change against k periods ago (1 = quarter on quarter, 4 = year on year)."""
    change = pct_change(F.col(value), at_offset(value, series, k, ordinal))
    return df.withColumn(name, change if digits is None else round_half_up(change, digits))


def index_panel(
    cells: DataFrame, series: Sequence[str], value: str = "value", quantity: str = "quantity",
    base: float = 1000.0, ordinal: str = "ordinal",
) -> DataFrame:
    """Unit-value index with its published changes, from additive value and quantity.

    The base is the first available period of each series.
    """
    first = W.partitionBy(*series).orderBy(ordinal).rowsBetween(W.unboundedPreceding, 0)
    unit = F.try_divide(F.col(value).cast("double"), F.col(quantity).cast("double"))
    priced = cells.withColumn("unit_value", unit)
    indexed = priced.withColumn(
        "index_value",
        round_half_up(
            F.try_divide(F.col("unit_value") * base, F.first("unit_value", True).over(first)), 2
        ),
    )
    qoq = with_change(indexed, "unit_value", series, "qoq", 1, ordinal)
    return with_change(qoq, "unit_value", series, "yoy", 4, ordinal)


def exact_mean(c: str | Column, w, digits: int = 6) -> tuple[Column, Column]:
    """Decimal (sum, count) over a window: independent of the order of additions."""
    usable = exact(F.col(c) if isinstance(c, str) else c, digits)
    return F.sum(usable).over(w).cast("double"), F.count(usable).over(w)


def rolling_mean(
    df: DataFrame, value: str, series: Sequence[str], n: int = 4, name: str = "rolling_mean",
    deviation: str | None = None, order: str = "ordinal", digits: int = 2,
) -> DataFrame:
    """Mean of this and the n-1 rows before; fewer at the start. Optionally value - mean."""
    w = W.partitionBy(*series).orderBy(order).rowsBetween(1 - n, 0)
    total, count = exact_mean(value, w)
    out = df.withColumn("__mean", F.try_divide(total, count.cast("double")))
    out = out.withColumn(name, round_half_up(F.col("__mean"), digits))
    if deviation:
        out = out.withColumn(deviation, round_half_up(F.col(value) - F.col("__mean"), digits))
    return out.drop("__mean")


def component_gap(
    df: DataFrame, a: str, b: str, series: Sequence[str], order: str = "ordinal",
    name: str = "gap", change: str = "gap_change",
) -> DataFrame:
    """a - b and its change against the row before."""
    out = df.withColumn("__gap", F.col(a) - F.col(b))
    out = out.withColumns({
        name: round_half_up(F.col("__gap"), 1),
        change: round_half_up(F.col("__gap") - previous("__gap", series, order), 2),
    })
    return out.drop("__gap")


def character(df: DataFrame, a: str, b: str, name: str = "character", **kw) -> DataFrame:
    return df.withColumn(name, classify_sign(F.col(a), F.col(b), **kw))


def first_match(
    df: DataFrame, predicate: Column, series: Sequence[str], cols: Sequence[str],
    order: str = "ordinal",
) -> DataFrame:
    """First row of each series, by order, that satisfies the predicate."""
    return _pick(df.filter(predicate), series, cols, F.min_by, order)


def latest(
    df: DataFrame, series: Sequence[str], cols: Sequence[str], order: str = "ordinal"
) -> DataFrame:
    """Last row of each series."""
    return _pick(df, series, cols, F.max_by, order)


def _pick(df, series, cols, pick, order):
    # One aggregate per column keeps hash aggregation; a struct buffer would force a sort.
    return df.groupBy(*series).agg(*[pick(c, order).alias(c) for c in cols])


def _carried_sign(value: str, series: Sequence[str], order: str) -> Column:
    """Sign of the value; a zero keeps the sign before it."""
    sign = F.signum(F.col(value)).cast("int")
    w = W.partitionBy(*series).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return F.last(F.when(sign != 0, sign), ignorenulls=True).over(w)


def sign_change(
    df: DataFrame, value: str, series: Sequence[str], order: str = "ordinal"
) -> DataFrame:
    """Rows where the sign differs from the last non-zero sign before them."""
    signed = df.withColumn("sign", _carried_sign(value, series, order))
    w = W.partitionBy(*series).orderBy(order)
    return (
        signed.withColumns({
            "__sign_before": F.lag("sign").over(w), "value_before": F.lag(value).over(w),
        })
        .filter(F.col("sign") != F.col("__sign_before"))
        .drop("__sign_before")
    )


def regime_runs(
    df: DataFrame, value: str, series: Sequence[str], label: str, order: str = "ordinal",
    labels: Sequence[str] = ("positive", "negative"),
) -> DataFrame:
    """Consecutive periods with the same sign: first and last label, length, mean value."""
    w = W.partitionBy(*series).orderBy(order)
    signed = (
        df.withColumn("__sign", _carried_sign(value, series, order))
        .filter(F.col("__sign").isNotNull())
        .withColumn("__new", F.coalesce(F.col("__sign") != F.lag("__sign").over(w), F.lit(True)))
        .withColumn("run", F.sum(F.col("__new").cast("bigint")).over(w))
    )
    usable = exact(F.col(value))
    total, count = F.sum(usable).cast("double"), F.count(usable).cast("double")
    return signed.groupBy(*series, "run", "__sign").agg(
        F.min_by(label, order).alias("first_label"),
        F.max_by(label, order).alias("last_label"),
        F.count("*").alias("length"),
        round_half_up(F.try_divide(total, count), 2).alias("mean_value"),
    ).select(
        *series, "run", F.when(F.col("__sign") > 0, labels[0]).otherwise(labels[1]).alias("regime"),
        "first_label", "last_label", "length", "mean_value",
    )


def series_range(
    df: DataFrame, series: Sequence[str], label: str, value: str, order: str = "ordinal"
) -> DataFrame:
    """Rows, first and last label, peak value and the (earliest) label it was reached.

    `order` is a number.
    """
    return df.groupBy(*series).agg(
        F.count("*").alias("n_rows"),
        F.min_by(label, order).alias("first_label"),
        F.max_by(label, order).alias("last_label"),
        F.max(value).alias("peak"),
        F.max_by(label, F.when(F.col(value).isNotNull(), F.struct(value, -F.col(order))))
        .alias("peak_label"),
    )


def recompute_check(
    df: DataFrame, index: str, stored: str, series: Sequence[str], order: str = "ordinal",
    digits: int = 1, tolerance: float = 0.05,
) -> DataFrame:
    """Change recomputed from the stored index, beside the stored change.

    `within_tol` compares the unrounded recomputation with half a unit of the last stored
    digit, plus 0.01 for the rounding of the index itself.
    """
    prev = previous(index, series, order)
    out = df.withColumn("index_prev", prev).withColumn(
        "__calc", pct_change(F.col(index), F.col("index_prev"))
    )
    return out.withColumns({
        "calculated": round_half_up(F.col("__calc"), 2),
        "matches": round_half_up(F.col("__calc"), digits) == F.col(stored),
        "within_tol": F.abs(F.col("__calc") - F.col(stored)) <= tolerance + 0.01,
    }).drop("__calc")


def latest_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Top-n report; give `order` a unique tie-break."""
    return df.orderBy(*order).limit(n)
