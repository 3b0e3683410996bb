"""Positional load of staged CSV lines: strict casts reject the row, lenient ones give NULL."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexpanel.sources.records import read_records


class Pick(NamedTuple):
    """Column `position` (from 1) of the file as `name`, cast to `kind`."""

    name: str
    position: int
    kind: str = "string"
    strict: bool = True


def _cast(raw: Column, kind: str) -> Column:
    if kind == "date":
        return F.try_to_date(raw, "yyyy-MM-dd")
    if kind in ("int", "bigint"):
        return raw.try_cast("decimal(38,0)").try_cast(kind)
    return raw if kind == "string" else raw.try_cast(kind)


def load_with_rejects(lines: DataFrame, picks: Sequence[Pick], line: str = "line") -> DataFrame:
    """Typed columns, plus `status` ('loaded', 'rejected' or 'malformed') and the column that failed.

    A row is rejected when a strict column has text that does not cast, and malformed when a quote stays open or it has
    fewer fields than the last one picked. Fields beyond that one are ignored, as the load is by position.
    """
    width = max(p.position for p in picks)
    ddl = ", ".join(f"_{i} string" for i in range(1, width + 1))
    # A generator, so that a line is parsed once however many columns are picked from it.
    parsed = lines.select(line, F.inline(F.array(F.from_csv(line, ddl, {"quote": '"', "escape": '"'}))))
    outside = F.regexp_replace(F.col(line), '"[^"]*"', "")  # what no quotes enclose
    malformed = outside.contains('"') | (F.size(F.split(outside, ",")) < width)
    typed = parsed.select(line, F.coalesce(malformed, F.lit(True)).alias("__malformed"),
                          *[F.col(f"_{p.position}").alias(f"__raw_{p.name}") for p in picks])
    typed = typed.withColumns({p.name: _cast(F.col(f"__raw_{p.name}"), p.kind) for p in picks})
    failed = F.coalesce(*[
        F.when(F.col(f"__raw_{p.name}").isNotNull() & F.col(p.name).isNull(), p.name)
        for p in picks if p.strict and p.kind != "string"
    ], F.lit(None).cast("string"))
    return typed.select(
        line, *[p.name for p in picks], failed.alias("failed_column"),
        F.when(F.col("__malformed"), "malformed").when(failed.isNull(), "loaded").otherwise("rejected").alias("status"),
    )


def staged_load(lines: DataFrame, picks: Sequence[Pick], line: str = "line") -> DataFrame:
    """The rows that load."""
    return load_with_rejects(lines, picks, line).filter("status = 'loaded'").select(
        *[p.name for p in picks]
    )


def rejects(loaded: DataFrame, line: str = "line") -> DataFrame:
    """Lines that don't load; malformed ones have no failed column."""
    return loaded.filter("status <> 'loaded'").select(line, F.when(F.col("status") == "rejected", F.col("failed_column"))
                                                      .alias("failed_column"))


def read_staged(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """`line` of staged files, without the first record of each file if they have a header. Line breaks inside quotes
    belong to their field (see `records`)."""
    rows = read_records(spark, path)
    return (rows.where("record > 0") if header else rows).select("line")


def load_metrics(loaded: DataFrame) -> DataFrame:
    """Rows parsed, loaded, rejected and malformed, in one row."""
    return loaded.agg(
        F.count("*").alias("rows_parsed"),
        F.count_if(F.col("status") == "loaded").alias("rows_loaded"),
        F.count_if(F.col("status") != "loaded").alias("errors_seen"),
        F.count_if(F.col("status") == "malformed").alias("n_malformed"),
    )
