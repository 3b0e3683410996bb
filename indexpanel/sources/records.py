"""Records of text files whose quoted fields hold line breaks, read in splits like any text file.

A line break ends a record where the number of quotes before it in the file is even. A line knows the quotes before it in its own
split only, so every split states its quotes, its lines and how many of its lines end a record if it is entered outside or inside
a quote. Running sums over the splits of a file (one row per split) say which of the two holds and how many records came before.
The text is shuffled once, by split; records that cross the edge of a split are put together from their parts. A record is
held whole, a file or split never is as one value.

A quote that stays open to the end of its file ends with its line, and so does every line after it: such lines are records of their
own, so that a stray quote neither joins the rest of a file into one row nor loses it. Compressed files are one split each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPLIT = ["file", "split"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files: (file STRUCT<file_path, file_name>, split, at, line); `at` orders the lines of a split."""
    return spark.read.text(path, lineSep="\n").select(
        F.struct("_metadata.file_path", "_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _marked(lines: DataFrame) -> DataFrame:
    """Lines with what their split knows: quotes and lines up to here, and how many of these leave an even number of quotes."""
    order = W.partitionBy(*SPLIT).orderBy("at")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.select(*SPLIT, "at", "line", quotes.cast("bigint").alias("__n")).withColumn("__quotes", F.sum("__n").over(upto))
    return counted.select(*SPLIT, "at", "line", "__quotes", F.row_number().over(order).cast("bigint").alias("__line"),
                          F.sum((F.col("__quotes") % 2 == 0).cast("bigint")).over(upto).alias("__even"))


def _entered(marked: DataFrame) -> DataFrame:
    """One row per split: the state it is entered in, and records and lines of its file before it."""
    even = F.col("__quotes") % 2 == 0
    splits = marked.groupBy(*SPLIT).agg(
        F.max("__quotes").alias("quotes"), F.max("__line").alias("lines"), F.max("__even").alias("even"),
        F.max(F.when(even, F.col("__line"))).alias("last_even"), F.max(F.when(~even, F.col("__line"))).alias("last_odd"))
    whole = W.partitionBy("file")
    before = whole.orderBy("split").rowsBetween(W.unboundedPreceding, -1)

    def earlier(name: str):
        return F.coalesce(F.sum(name).over(before), F.lit(0))

    known = splits.select(*SPLIT, "lines", "even", "last_even", "last_odd", (earlier("quotes") % 2).alias("__inside"),
                          earlier("lines").alias("__lines_before"), (F.sum("quotes").over(whole) % 2 == 1).alias("__open"))
    outside = F.col("__inside") == 0
    known = known.withColumns({
        "ends": F.when(outside, F.col("even")).otherwise(F.col("lines") - F.col("even")),
        "last": F.col("__lines_before") + F.when(outside, F.col("last_even")).otherwise(F.col("last_odd"))})
    return known.select(*SPLIT, "__inside", "__lines_before", "__open", earlier("ends").alias("__before"),
                        F.sum("ends").over(whole).alias("__records"),
                        F.coalesce(F.max("last").over(whole), F.lit(0)).alias("__last"))


def records(lines: DataFrame) -> DataFrame:
    """(file, record, line): the records of each file, numbered from 0, without the carriage return before their line break.

    `lines` are those of `read_lines`, or any (file, split, at, line) without NULLs: splits of a file in order, lines of a split in
    the order of `at`. A NULL line is no line.
    """
    marked = _marked(lines.where(F.col("line").isNotNull()))
    placed = marked.join(_entered(marked), SPLIT)
    closes = (F.col("__quotes") + F.col("__inside")) % 2 == 0
    ended = F.when(F.col("__inside") == 0, F.col("__even")).otherwise(F.col("__line") - F.col("__even"))
    number = F.col("__before") + ended - closes.cast("bigint")
    tail = F.col("__open") & ~closes & (number == F.col("__records"))
    past = F.col("__lines_before") + F.col("__line") - F.col("__last") - 1
    numbered = placed.select(
        *SPLIT, "at", "line", (number + F.when(tail, past).otherwise(0)).alias("record"),
        (tail | closes).alias("__closes"), (~tail & (F.col("__inside") == 1) & (number == F.col("__before"))).alias("__begun"))

    def joined(order: str, text: str):
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda p: p[text]), "\n").alias("line")

    # Grouping by split and record needs no shuffle beyond that by split.
    parts = numbered.groupBy(*SPLIT, "record").agg(
        joined("at", "line"), F.bool_or("__closes").alias("__closes"), F.bool_or("__begun").alias("__begun"))
    whole = F.col("__closes") & ~F.col("__begun")
    crossing = parts.where(~whole).groupBy("file", "record").agg(joined("split", "line"))
    both = parts.where(whole).select("file", "record", "line").unionByName(crossing)
    return both.withColumn("line", F.regexp_replace("line", r"\r\z", ""))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of text files."""
    return records(read_lines(spark, path))
