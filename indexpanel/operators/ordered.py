"""Order-dependent carries (fill-down, sections, cut-off) that survive hot groups.

A running window runs one group in one task. Where a group can be huge, the caller gives `chunk`: a deterministic
expression that never decreases along the order (a truncated timestamp, row_idx div n). Every group is then filled
chunk by chunk, whatever its size: each chunk's last value is pre-aggregated, carried across the chunk summaries, and
enters the next chunks as one extra leading row. The rows are read twice and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str],
    partition: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Replace NULLs in `cols` by the last non-NULL value above them in the group."""
    if chunk is None:
        if not partition:
            raise ValueError("a global fill needs a chunk expression")
        w = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})

    rows = df.withColumn("__chunk", chunk.cast("bigint"))
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    tails = rows.groupBy(*partition, "__chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in cols]
    )
    before = (
        W.partitionBy(*partition).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    )
    leads = tails.select(
        *partition, "__chunk", *[F.last(c, ignorenulls=True).over(before).alias(c) for c in cols]
    )
    both = rows.withColumn("__body", F.lit(True)).unionByName(
        leads.withColumn("__body", F.lit(False)), allowMissingColumns=True
    )
    w = (
        W.partitionBy(*partition, "__chunk")
        .orderBy("__body", *order)
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        both.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
        .filter("__body")
        .select(*df.columns)
    )


def section_carry(
    df: DataFrame, section: Column, name: str, order: Sequence[str], partition: Sequence[str], chunk: Column | None = None
) -> DataFrame:
    """Rows where `section` is not NULL open a section: they are dropped, the rows below get
    its value, and rows before the first one are dropped."""
    marked = df.withColumns({name: section, "__marker": section.isNotNull()})
    filled = forward_fill(marked, [name], order, partition, chunk)
    return filled.filter(F.col(name).isNotNull() & ~F.col("__marker")).drop("__marker")


def cut_at_sentinel(
    df: DataFrame, sentinel: Column, order: Sequence[str], partition: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Rows above the first sentinel row of each group."""
    flagged = df.withColumn("__seen", F.when(sentinel, True))
    filled = forward_fill(flagged, ["__seen"], order, partition, chunk)
    return filled.filter(F.col("__seen").isNull()).drop("__seen")


def valid_rows(df: DataFrame, label: str, allowed: Sequence[str], carried: str) -> DataFrame:
    """Rows whose trimmed label is allowed and whose carried value is set."""
    return df.filter(F.trim(label).isin(*allowed) & F.col(carried).isNotNull())
