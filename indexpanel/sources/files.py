"""Typed CSV scans and literal lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted fields, typed by a fixed schema; dates are yyyy-MM-dd."""
    return spark.read.schema(schema).csv(
        path, header=True, quote='"', escape='"', dateFormat="yyyy-MM-dd", mode="PERMISSIVE"
    )


def literal_df(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Literal rows as a local relation, whose size Spark knows and can broadcast by."""
    names = [column.split()[0] for column in ddl.split(",")]
    columns = zip(*rows, strict=True)
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns), strict=True))), ddl)


def lookup_df(
    spark: SparkSession, mapping: Mapping, key: str, name: str, types: tuple[str, str]
) -> DataFrame:
    """A literal dictionary as a two-column table."""
    return literal_df(spark, list(mapping.items()), f"{key} {types[0]}, {name} {types[1]}")
