"""Fixed schemas of the tidy CSV files and of the star tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

MEASURE = T.DecimalType(10, 2)


def _field(name: str, kind: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


def _period(with_parts: bool = True) -> list[T.StructField]:
    fields = [
        _field("period", T.StringType(), "quarter label, e.g. Mar-26", False),
        _field("period_date", T.DateType(), "last day of the quarter"),
    ]
    if with_parts:
        fields += [
            _field("year", T.IntegerType(), "calendar year"),
            _field("quarter", T.StringType(), "last month of the quarter"),
        ]
    return fields


FLAG = _field("is_post_covid", T.BooleanType(), "quarter ends in 2020 or later")

# The three components of the wide series, in file order.
COMPONENTS = ("tradeables", "nontradeables", "allgroups")
SERIES_MEASURES = [f"{c}_{m}" for c in COMPONENTS for m in ("index", "qoq_pct", "yoy_pct")]

SERIES = T.StructType(_period() + [
    _field(m, MEASURE, f"{m.split('_', 1)[0]}: {what}")
    for m, what in zip(SERIES_MEASURES, ("index", "% on last quarter", "% on same quarter last year") * 3)
])
GROUPS = T.StructType(_period(False) + [
    _field("group_name", T.StringType(), "group, subgroup or total", False),
    _field("series_ref", T.StringType(), "hierarchy code; a child starts with its parent's"),
    _field("index_value", MEASURE, "index"),
    _field("qoq_pct_change", MEASURE, "% on last quarter"),
    _field("yoy_pct_change", MEASURE, "% on same quarter last year"),
])
REGIONAL = T.StructType(_period() + [
    _field("region", T.StringType(), "region; totals overlap", False),
    _field("cpi_index", MEASURE, "index"),
    _field("qoq_pct_change", MEASURE, "% on last quarter"),
    _field("yoy_pct_change", MEASURE, "% on same quarter last year"),
])


def _subset(schema: T.StructType, names: list[str]) -> T.StructType:
    return T.StructType([schema[n] for n in names])


STAR = {
    "dim_period": T.StructType(_period()),
    "dim_group": T.StructType([
        GROUPS["group_name"], GROUPS["series_ref"],
        _field("level", T.StringType(), "group or subgroup"),
    ]),
    "dim_region": _subset(REGIONAL, ["region"]),
    "fact_allgroups": T.StructType([*SERIES, FLAG]),
    "fact_groups": T.StructType([*_subset(GROUPS, [
        "group_name", "period", "period_date", "index_value", "qoq_pct_change", "yoy_pct_change",
    ]), FLAG]),
    "fact_regional": T.StructType([*_subset(REGIONAL, [
        "region", "period", "period_date", "year", "quarter",
        "cpi_index", "qoq_pct_change", "yoy_pct_change",
    ]), FLAG]),
}
KEYS = {
    "dim_period": ["period"], "dim_group": ["group_name"], "dim_region": ["region"],
    "fact_allgroups": ["period"], "fact_groups": ["group_name", "period"],
    "fact_regional": ["region", "period"],
}
# (fact, dimension, key)
REFERENCES = [
    ("fact_allgroups", "dim_period", "period"),
    ("fact_groups", "dim_group", "group_name"), ("fact_groups", "dim_period", "period"),
    ("fact_regional", "dim_region", "region"), ("fact_regional", "dim_period", "period"),
]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_tables(spark: SparkSession, database: str) -> None:
    """Declare the six empty tables, with column comments, in a database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in STAR.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} COMMENT '{_quoted(f.metadata['comment'])}'"
            for f in schema
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
