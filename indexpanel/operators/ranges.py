"""Running sums over groups of any size, cut into ranges of the order.

The order keys of a group are cut at keys taken from the group itself: of every 1/SAMPLE of the hash space the key with the
lowest hash, every STRIDE-th of them in order. That sample depends on the data alone, so a task that runs again finds the same
ranges. Rows are summed within their range, ranges are summed per group (at most SAMPLE / STRIDE + 1 figures), and the sums of
earlier ranges are added back. No task holds a group, and no row goes through a window by group alone. All rows of one key
fall into one range: callers aggregate equal keys first or make keys unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE = 1024
STRIDE = 16


def matched(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """`side` joined to `df` by keys of which NULL equals NULL; the columns of `df`, then the rest of `side`."""
    renamed = side.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    same = [df[k].eqNullSafe(renamed[f"__on_{k}"]) for k in keys]
    return df.join(renamed, reduce(and_, same, F.lit(True)), how).drop(*[f"__on_{k}" for k in keys])


def descending(c: Column) -> list[Column]:
    """Key columns that sort by the value downwards, NaN first and NULL last."""
    return [c.isNull(), ~F.isnan(c.cast("double")), -c]


def running(df: DataFrame, by: Sequence[str], key: Sequence[Column], sums: Mapping[str, Column],
            sample: int = SAMPLE, stride: int = STRIDE) -> DataFrame:
    """`df` with running sums {output column: summand} of each group in the order of the key, the row itself included.

    Rows of equal keys come in no defined order. NULL summands count as nothing."""
    held = df.withColumns({"__key": F.struct(*key), **{f"__in_{n}": c for n, c in sums.items()}})
    hashed = held.select(*by, "__key", F.xxhash64("__key").alias("__hash"))
    lowest = hashed.groupBy(*by, F.pmod("__hash", F.lit(sample)).alias("__part")).agg(
        F.min(F.struct("__hash", "__key")).alias("__low"))
    cuts = lowest.groupBy(*by).agg(F.sort_array(F.collect_list("__low.__key")).alias("__all")).select(
        *by, F.filter("__all", lambda _, i: i % stride == stride - 1).alias("__cuts"))
    placed = matched(held, cuts, by).withColumn(
        "__range", F.size(F.filter("__cuts", lambda c: c <= F.col("__key")))).drop("__cuts")

    parts = placed.groupBy(*by, "__range").agg(*[F.sum(f"__in_{n}").alias(f"__sum_{n}") for n in sums])
    every = parts.groupBy(*by).agg(F.collect_list(F.struct("__range", *[f"__sum_{n}" for n in sums])).alias("__parts"))
    types = {n: parts.schema[f"__sum_{n}"].dataType for n in sums}

    def earlier(p: Column, n: str) -> Column:
        before = F.filter("__parts", lambda q: q["__range"] < p["__range"])
        return F.aggregate(before, F.lit(0).cast(types[n]),
                           lambda a, q: (a + F.coalesce(q[f"__sum_{n}"], F.lit(0))).cast(types[n])).alias(f"__before_{n}")

    offsets = every.select(*by, F.inline(F.transform(
        "__parts", lambda p: F.struct(p["__range"].alias("__range"), *[earlier(p, n) for n in sums]))))
    within = W.partitionBy(*by, "__range").orderBy("__key").rowsBetween(W.unboundedPreceding, 0)
    inner = placed.withColumns({f"__in_{n}": F.coalesce(F.sum(f"__in_{n}").over(within), F.lit(0)) for n in sums})
    return matched(inner, offsets, [*by, "__range"]).select(
        *df.columns, *[(F.col(f"__in_{n}") + F.col(f"__before_{n}")).cast(types[n]).alias(n) for n in sums])


def rank_of_values(df: DataFrame, value: str, by: Sequence[str], name: str, highest_first: bool = True,
                   sample: int = SAMPLE, stride: int = STRIDE) -> DataFrame:
    """Competition rank (1, 2, 2, 4): rows are counted per value, values are ranked, and ranks are joined back."""
    c = F.col(value)
    key = descending(c) if highest_first else [c.isNull(), F.isnan(c.cast("double")), c]
    counts = df.groupBy(*by, value).agg(F.count("*").alias("__n"))
    ranks = running(counts, by, key, {"__upto": F.col("__n")}, sample, stride).select(
        *by, value, (F.col("__upto") - F.col("__n") + 1).alias(name))
    return matched(df, ranks, [*by, value])
