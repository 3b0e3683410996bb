"""Connected components by alternating large-star and small-star rounds (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexpanel.llm.common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links a node's neighbours (the larger ones, or the smaller ones and itself) to its least neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    centre = both.groupBy("a").agg(F.min("b").alias("m"))
    centre = centre.select("a", F.least("a", "m").alias("m"))
    linked = both.join(centre, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            centre.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one root: then a further round changes nothing."""
    ends = links.select("a", F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        links.select("b", F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("a").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not nodes.agg(F.count_if((F.col("down") > 1) | (F.col("down") * F.col("up") > 0))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """a, b: links between longs. Returns node, component (the least node that can be reached) of every linked node.

    Each double round is written to the shared folder; the number of rounds is logarithmic in practice. Nothing but one
    count of a round's table reaches the driver. Self-links and repeated links are allowed; nulls are dropped.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"),
                                                   F.least("a", "b").cast("long").alias("b")).distinct())
    while not _settled(now):
        after = materialize(_star(_star(now, large=True), large=False))
        discard(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
