"""Dimensional model: dimensions, derived flag, and the verified star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexpanel.functions.periods import (
    axis_label, ordinal, ordinal_end, period_label, quarter_name,
)
from indexpanel.functions.text import group_level
from indexpanel.operators import quality
from indexpanel.sources.schema import KEYS, REFERENCES, STAR


def period_dim(df: DataFrame, date: str) -> DataFrame:
    """Distinct quarters of a date column. De-duplicated on one integer, then described."""
    quarters = df.select(ordinal(F.col(date)).alias("ordinal")).distinct()
    end = quarters.withColumn("period_date", ordinal_end(F.col("ordinal")))
    return end.select(
        period_label(F.col("period_date")).alias("period"), "period_date",
        F.year("period_date").alias("year"), quarter_name(F.col("period_date")).alias("quarter"),
        "ordinal", axis_label(F.col("period_date")).alias("axis_label"),
    )


def group_dim(df: DataFrame, name: str, ref: str) -> DataFrame:
    """One row per name: its (smallest) reference code and its level."""
    return df.groupBy(F.col(name).alias("group_name")).agg(F.min(ref).alias("series_ref")).select(
        "group_name", "series_ref", group_level(F.col("group_name")).alias("level")
    )


def dim_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def flag_since(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """TRUE where the condition holds, else FALSE (never NULL)."""
    return df.withColumn(name, F.coalesce(condition, F.lit(False)))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns, order, types and comments of a star table."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in STAR[table]
    ])


def build_star(series: DataFrame, groups: DataFrame, regional: DataFrame) -> dict[str, DataFrame]:
    """Three tidy panels to three dimensions and three facts."""
    by_year = F.col("year") >= 2020
    by_date = F.col("period_date") >= F.lit("2020-01-01").cast("date")
    flag = "is_post_covid"
    tables = {
        "dim_period": dim_distinct(series, ["period", "period_date", "year", "quarter"]),
        "dim_group": group_dim(groups, "group_name", "series_ref"),
        "dim_region": dim_distinct(regional, ["region"]),
        "fact_allgroups": flag_since(series, by_year, flag),
        "fact_groups": flag_since(groups, by_date, flag),
        "fact_regional": flag_since(regional, by_year, flag),
    }
    return {name: conform(df, name) for name, df in tables.items()}


def verify_star(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """One report: row counts, duplicate keys and orphans; check, n, status.

    The keys of all tables and references meet in one aggregation by (check, key), combined where they are read: a key's
    count shows duplicates, and a key that only the fact's side has is an orphan. A NULL reference is no orphan.
    """
    def keys_of(table: str, keys: Sequence[str], check: str, kind: str) -> DataFrame:
        # Concatenated with lengths, so that no two keys meet and NULL stays apart.
        parts = [F.coalesce(F.concat(F.length(k).cast("string"), F.lit(":"), k), F.lit("-")) for k in
                 (F.col(c).cast("string") for c in keys)]
        return tables[table].select(F.lit(check).alias("check"), F.concat(*parts).alias("key"),
                                    F.lit(int(kind != "parent")).alias("n"), F.lit(int(kind == "parent")).alias("parent"))

    rows = [keys_of(t, keys, t, "own") for t, keys in KEYS.items() if t in tables]
    links = []
    for fact, dim, key in REFERENCES:
        check = f"orphans {fact} {key}"
        links += [keys_of(fact, [key], check, "child").filter(F.col("key") != "-"), keys_of(dim, [key], check, "parent")]
    seen = reduce(DataFrame.unionByName, [*rows, *links]).groupBy("check", "key").agg(
        F.sum("n").alias("n"), F.max("parent").alias("parent")
    )
    found = seen.groupBy("check").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_duplicates"),
        F.sum(F.when(F.col("parent") == 0, F.col("n")).otherwise(0)).alias("n_orphans"),
    )
    # Every check has a row, also over an empty table.
    checks = [*[t for t in KEYS if t in tables], *[f"orphans {f} {k}" for f, _, k in REFERENCES]]
    zero = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in checks])).alias("check"))
    found = zero.join(found, "check", "left").fillna(0)

    def broken(check, n):
        status = F.when(n == 0, "OK").otherwise("BROKEN")
        return F.struct(check.alias("check"), n.cast("bigint").alias("n"), status.alias("status"))

    is_link = F.col("check").startswith("orphans ")
    counted = found.filter(~is_link).select(F.col("check").alias("table_name"), "n_rows", "n_duplicates")
    checked = quality.expect_counts(counted, expected)
    sizes = F.struct(F.concat(F.lit("rows "), "table_name").alias("check"), F.col("n_rows").cast("bigint").alias("n"), "status")
    repeats = broken(F.concat(F.lit("duplicate keys "), "table_name"), F.col("n_duplicates"))
    return checked.select(F.inline(F.array(sizes, repeats))).unionByName(
        found.filter(is_link).select(F.inline(F.array(broken(F.col("check"), F.col("n_orphans")))))
    )
