"""CSV and Parquet sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """CSV part files with header; given sort columns, ordered within and across the parts."""
    if sort:
        df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    df.write.option("header", True).option("quote", '"').option("escape", '"').mode("overwrite").csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table; of a partitioned one, only the partitions being written."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


MANIFEST = "CURRENT"
KEPT_VERSIONS = 2  # the current one, and the one that readers may still hold


def _files(spark: SparkSession, path: str):
    """The file system of the path, and the JVM's Path class."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """Version, kept versions and schemas of the last complete load; None before the first one."""
    fs, kind = _files(spark, path)
    if not fs.exists(kind(f"{path}/{MANIFEST}")):
        return None
    stream = fs.open(kind(f"{path}/{MANIFEST}"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """The new manifest is written beside the old one, then takes its name in one step."""
    fs, kind = _files(spark, path)
    new = kind(f"{path}/{MANIFEST}.{manifest['version']}")
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(kind(f"{path}/{MANIFEST}")), options)


def reload_tables(tables: Mapping[str, DataFrame], path: str) -> str:
    """Full refresh as a snapshot swap; returns the new version.

    All tables are written into a folder of their own, dimensions first, facts partitioned by year where they have one; the
    manifest names that folder only when the last table is whole. Readers see the old tables or the new ones, never a mixture,
    and a load that fails changes nothing for them. Rows, years and tables that the new data lack are gone. Folders that the
    manifest no longer names are deleted after the swap; one load runs at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    before = read_manifest(spark, path) or {"kept": []}
    version = uuid.uuid4().hex
    for name in sorted(tables, key=lambda n: (not n.startswith("dim_"), n)):
        by_year = ["year"] if name.startswith("fact_") and "year" in tables[name].columns else []
        tables[name].write.partitionBy(*by_year).parquet(f"{path}/versions/{version}/{name}")
    kept = [version, *before["kept"]][:KEPT_VERSIONS]
    _write_manifest(spark, path, {"version": version, "kept": kept, "schemas": {n: t.schema.jsonValue() for n, t in tables.items()}})
    fs, kind = _files(spark, path)
    for folder in fs.listStatus(kind(f"{path}/versions")):
        if folder.getPath().getName() not in kept:
            fs.delete(folder.getPath(), True)
    return version


def read_tables(spark: SparkSession, names: Sequence[str], path: str) -> dict[str, DataFrame]:
    """Tables of the last complete load, with the columns in the order in which they were given."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no complete load in {path}")
    found = {}
    for name in names:
        schema = T.StructType.fromJson(manifest["schemas"][name])
        table = spark.read.schema(schema).parquet(f"{path}/versions/{manifest['version']}/{name}")
        found[name] = table.select(*["`" + c.replace("`", "``") + "`" for c in schema.names])
    return found
