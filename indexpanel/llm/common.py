"""What the operators share: whole texts as words, tables written to the shared folder, rows kept beside new columns."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = " \t\n\v\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the context's checkpoint folder. Where neither is set, a session of one machine
    gets one of its own; a cluster, whose executors share no local folder, is refused."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-checkpoints-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


_scratch: ContextVar[list[DataFrame] | None] = ContextVar("scratch", default=None)


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and reads them again: short lineage that outlives any executor, and a size
    that Spark knows when it plans a join."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (held := _scratch.get()) is not None:
        held.append(table)
    return table


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end the tables materialized inside, but for those written by the function it gives."""
    outer, mine, kept = _scratch.get(), [], []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(materialize(df))
        return kept[-1]

    token = _scratch.set(mine)
    try:
        yield keep
    finally:
        _scratch.reset(token)
        discard(*[t for t in mine if not any(t is k for k in kept)])
        if outer is not None:
            outer.extend(kept)


_shipped: set[str] = set()


def map_arrow(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """mapInArrow with a function of this package; the first call of an application sends the package to its executors."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "package")
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)
    return df.mapInArrow(fn, schema)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of materialized tables that no later read needs."""
    for table in tables:
        jvm = table.sparkSession._jvm
        for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as the struct `row` beside new columns, so that no name of the input can clash with them."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in columns.items()])


def unpacked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The columns of the packed row again."""
    return df.select(*[F.col("row")[c].alias(c) for c in columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ of the whole text; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("long")


def without(text: Column, characters: str) -> Column:
    """The text without these characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text
