"""Data-quality operators. Every one is an aggregation that combines before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexpanel.functions.numbers import minor_units


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, n_rows: all tables in one job."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def expect_counts(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts beside expectations (table_name, expected): OK, EXPECTED n, or MISSING for a table that has no count."""
    wanted = F.coalesce(F.col("expected").cast("string"), F.lit("nothing"))
    ok = F.col("n_rows").eqNullSafe(F.col("expected"))
    numbers = [c for c in counts.columns if c != "table_name"]
    return (
        counts.unionByName(expected, allowMissingColumns=True)
        .groupBy("table_name")
        .agg(*[F.max(c).alias(c) for c in (*numbers, "expected")])
        .withColumn("status", F.when(F.col("n_rows").isNull(), "MISSING").when(ok, "OK")
                    .otherwise(F.concat(F.lit("EXPECTED "), wanted)))
    )


def all_ok(checked: DataFrame) -> DataFrame:
    return checked.agg(F.bool_and(F.col("status") == "OK").alias("all_ok"))


def _per_column(row: DataFrame, columns: Sequence[str], fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row of c__field columns -> one row per column."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields])
        for c in columns
    ])
    return row.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Shape and NULLs per column in one pass."""
    row = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__n_nulls") for c in df.columns],
    ).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))
    out = _per_column(row, df.columns, ["n_nulls"], ["n_rows", "n_columns"])
    return out.withColumn("status", F.when(F.col("n_nulls") == 0, "clean").otherwise("missing values"))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns declared NOT NULL that hold NULLs."""
    return null_profile(df.select(*[F.col(f"`{c}`") for c in cols])).filter(F.col("n_nulls") > 0).select("column_name", "n_nulls")


def unusable_amounts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per amount column, the values that minor_units turns into NULL: NaN, infinities, beyond its range."""
    row = df.agg(*[
        F.count_if(F.col(f"`{c}`").isNotNull() & minor_units(F.col(f"`{c}`")).isNull()).alias(f"{c}__n_unusable") for c in cols
    ])
    return _per_column(row, cols, ["n_unusable"])


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct values per column.

    One pass: cells are stacked as (column, value) pairs, de-duplicated map-side, then counted.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols
    ])).alias("p")).select("p.*").distinct()
    return pairs.groupBy("column_name").agg(F.count("v").alias("n_distinct"))


def data_dictionary(df: DataFrame, table: str) -> DataFrame:
    """Column, type, comment, NULLs and an example (the smallest value as text)."""
    row = df.agg(*[
        a for c in df.columns for a in (
            F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}__n_nulls"),
            F.min(F.col(f"`{c}`")).cast("string").alias(f"{c}__example"),
        )
    ])
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    comments = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.metadata.get("comment", ""))])
    return _per_column(row, df.columns, ["n_nulls", "example"]).select(
        F.lit(table).alias("table_name"), "column_name",
        types[F.col("column_name")].alias("data_type"),
        comments[F.col("column_name")].alias("meaning"),
        "example", "n_nulls",
    )


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """table_name, n_rows, n_duplicates (keys that repeat): one aggregation by key per table."""
    parts = [
        df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count_if(F.col("n") > 1).alias("n_duplicates"),
        ).select(F.lit(t).alias("table_name"), "n_rows", "n_duplicates")
        for t, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key no parent has; a NULL key refers to nothing and is no orphan."""
    keys = parent.select(F.col(parent_key).alias("__key")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(
        keys, F.col(child_key) == F.col("__key"), "left_anti"
    )


def panel_gaps(df: DataFrame, entity: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """Periods some entity has and this entity lacks.

    Each entity's periods become one array, as long as the calendar at most, and are taken
    from the array of all periods: only the gaps are ever produced as rows.
    """
    arrays = df.groupBy(*entity).agg(F.collect_set(ordinal).alias("__seen"))
    # Taken from the arrays, so that both sides read one shuffle, not the facts twice.
    every = arrays.select(F.explode("__seen").alias(ordinal)).agg(F.collect_set(ordinal)).scalar()
    return arrays.select(*entity, F.explode(F.array_except(every, "__seen")).alias(ordinal))


def check_scale(df: DataFrame, col: str) -> DataFrame:
    """Did the decimals survive the load? Rows with a fraction, largest value, digits used."""
    c = F.col(col)
    fraction = F.rtrim(F.substring_index(c.cast("decimal(24,6)").cast("string"), ".", -1), F.lit("0"))
    return df.agg(
        F.count(c).alias("n_values"),
        F.count_if(c != F.floor(c)).alias("n_fractional"),
        F.max(c).cast("double").alias("max_value"),
        F.max(F.length(fraction)).cast("bigint").alias("max_digits"),
    )


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by a total order. Each task keeps one row per key before the
    shuffle, so copies of a hot key do not travel."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
