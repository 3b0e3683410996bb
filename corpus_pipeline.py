"""From raw documents to packed training sequences: STAGES in order, each over all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. A stage's result is written as
Parquet to the shared folder and read again as the next one's docs, so a lost executor costs a part of one stage; it is deleted
once the next one is written. What the stages do with nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names is stated by the operators they call: such rows are judged, kept or dropped like any other, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexpanel.llm import mixing, near_dedup, quality_rules, residual_packing, secret_ownership
from indexpanel.llm.common import discard, materialize, unpacked

SHINGLE_WORDS, SIMILARITY_PERCENT, SEQUENCE = 5, 80, 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return unpacked(quality_rules.judged(docs).where("kept"), docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.deduplicated(docs, size=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked."""
    return secret_ownership.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target weights."""
    return unpacked(mixing.mixed(docs).where("kept"), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in training sequences."""
    pieces = residual_packing.pieces(docs, length=SEQUENCE)
    return residual_packing.placed(pieces, length=SEQUENCE).select(
        F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("quality rules", quality), ("near-dedup", dedup), ("secret scan", secrets), ("mixing", mixture),
          ("packing", packing)]
ORACLE_SQL = None  # the stages hash, sketch and tokenize in ways SQL has no words for; tests check them by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
        discard(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
