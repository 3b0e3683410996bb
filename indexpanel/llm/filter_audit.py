"""Interaction of filters over all orders of applying them, enumerated by a recursive CTE over cells of failure masks.

Every document is reduced where it is read to its part, the mask of the filters it fails, and a digest of its text. The last
filter, E, fails a document whose text a smaller id has anywhere in the table: documents are first counted per (digest, part,
flags, least id), combined before the shuffle, so that a text with any number of copies is a few rows when its least id is
looked up. What remains is one cell per (part, mask): at most 32 per part. The recursion starts from the empty prefix of every
part, extends a prefix by each unused letter, meets the part's cells, and carries the applied bits and the metrics of each
step; its fifth level holds the 120 orders with their five steps.

Recursion makes 325 rows per part. Its row limit (spark.sql.cteRecursionRowLimit) is lifted while the result is written.

Defined results: null text counts as empty, so it fails A and no other filter but E; a text without words does not fail B, an
empty one not C; null part is the empty string, also where that is a part of its own; a null id is smaller than none and
larger than none, so such rows never fail E and make no other row fail it; rows with the least id of a text do not fail E,
however often repeated; a document is good or toxic if any label of its id says so, and neither without one; very long texts
stay in their row and are judged whole; an empty table gives an empty result. Only the columns named are read, so others
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexpanel.llm.common import SPACE_RUN, SPACES, materialize, quoted, scratch

LETTERS = "ABCDE"
MIN_WORDS = 200  # A
MIN_DISTINCT_PERCENT = 50  # B
MAX_CAPITAL_PERCENT = 2  # C
SYMBOLS = "[#$%&*|]"  # D
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that the text fails."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n,
              100 * capitals > MAX_CAPITAL_PERCENT * F.char_length(text), text.rlike(SYMBOLS)]
    mask = F.lit(0)
    for bit, bad in enumerate(failed):
        mask = mask + bad.cast("int") * F.lit(1 << bit)
    return mask


def cells(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the exact set of filters they fail."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(F.col(quoted(id)).alias("id"), F.coalesce(F.col(quoted(part)), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("digest"), text_mask(body).alias("mask"),
                       F.monotonically_increasing_id().alias("spread"))
    # Null ids have no label; a key of their own deals them over all tasks.
    rows = rows.select("*", F.when(F.col("id").isNull(), F.col("spread")).otherwise(F.lit(-1)).alias("side"))
    flags = (labels.groupBy(F.col("doc_id").alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .select("id", "good", "toxic", F.lit(-1).cast("long").alias("side")))
    flagged = rows.join(flags, ["id", "side"], "left").select(
        "id", "part", "digest", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    # Per copy group: rows with an id, rows with the least id of this line, rows without an id.
    group = ["digest", "mask", "part", "good", "toxic"]
    least = flagged.groupBy(*group, "id").agg(F.count("*").alias("n")).groupBy(*group).agg(
        F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    first = F.min("least").over(Window.partitionBy("digest"))
    split = least.select("*", first.alias("first")).select(
        "mask", "part", "good", "toxic", "n",
        (F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0) + F.col("n_null")).alias("n_first"))
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("n_first").alias("n")),
                             F.struct((F.col("mask") + F.lit(16)).alias("mask"), (F.col("n") - F.col("n_first")).alias("n"))))
    return (split.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
            .groupBy("part", F.col("x.mask").alias("mask")).agg(
                F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"),
                F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")))


_BEFORE, _FAILS = "(c.mask & s.applied) <> 0", "(c.mask & f.bit) <> 0"


def _sum(condition: str, value: str = "n") -> str:
    return f"aggregate(p.cells, 0L, (t, c) -> t + if({condition}, c.{value}, 0L))"


_STEP = ", ".join(f"'{name}', {total}" for name, total in zip(METRICS, (
    _sum(f"NOT {_BEFORE} AND NOT {_FAILS}"), _sum(f"NOT {_BEFORE} AND {_FAILS}"), _sum(f"{_BEFORE} AND {_FAILS}"),
    _sum("c.mask = f.bit"), _sum(f"NOT {_BEFORE} AND {_FAILS}", "good"), _sum(f"NOT {_BEFORE} AND {_FAILS}", "toxic")),
    strict=True))
_VALUES = ", ".join(f"('{letter}', {1 << bit})" for bit, letter in enumerate(LETTERS))
_STEPS = f"array<struct<letter: string, {', '.join(f'{m}: bigint' for m in METRICS)}>>"

ORDERS = f"""
WITH RECURSIVE steps(part, filter_order, applied, done) AS (
  SELECT part, '', 0, CAST(array() AS {_STEPS}) FROM {{parts}}
  UNION ALL
  SELECT s.part, s.filter_order || f.letter, s.applied | f.bit, s.done || array(named_struct('letter', f.letter, {_STEP}))
  FROM steps s JOIN (VALUES {_VALUES}) AS f(letter, bit) ON (s.applied & f.bit) = 0 JOIN {{parts}} p ON p.part = s.part)
SELECT part, filter_order, posexplode(done) AS (at, m) FROM steps WHERE applied = {(1 << len(LETTERS)) - 1}
"""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def audited(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step, the METRICS, and shapley: the removals of the step's filter in all orders together."""
    spark = docs.sparkSession
    with scratch() as keep:
        table = materialize(cells(docs, labels, id, text, part))
        parts = materialize(table.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
        limit = spark.conf.get(ROW_LIMIT)
        spark.conf.set(ROW_LIMIT, "-1")
        try:
            rows = spark.sql(ORDERS, parts=parts).select(
                "part", "filter_order", (F.col("at") + 1).cast("int").alias("step"), "m.*")
            total = F.sum("removed").over(Window.partitionBy("part", "letter"))
            return keep(rows.select("part", "filter_order", "step", *METRICS, total.alias("shapley")))
        finally:
            spark.conf.set(ROW_LIMIT, limit)
