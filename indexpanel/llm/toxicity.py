"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios (Wang & Manning, ACL 2012).

A text is lower-cased, its white space runs become one space, and a space is put before and after. Its features are the
n-grams of 2 to 5 characters it holds, hashed to 2^18 buckets, each present or not. The log-count ratio of a bucket is
ln((a + p) / |a + p|) - ln((a + q) / |a + q|), p and q being the toxic and the other training documents that hold it, a = 1.
Buckets whose ratio is at least 3 standard errors from 0 are kept, the FEATURES furthest at most; a document's value of a kept
bucket is its ratio. A logistic regression with an L2 penalty is trained on these values.

Training rows are a bounded sample of labelled documents: of either class the PER_CLASS ones with the lowest hash of their id,
weighted so that the classes have their true shares. Spark reads the sample's texts once, counts buckets and lists features in
tasks; the driver gets the FEATURES kept buckets and the sample's feature lists, and fits the weights. Scoring reads every
document's whole text in tasks; long texts are taken in overlapping pieces, which changes no feature.

Defined results: null text counts as empty; a text without features (empty, white space only) has the score of the
intercept; labels other than 0 and 1, and null ids, are no labels; an id with labels of both kinds is toxic; of several rows
with one labelled id, the least text is trained on, once; without features, as without labels of both kinds, all scores
are the smoothed share of toxic labels (0.5 without any); ties of buckets go to the lower number; an empty table gives an
empty result; columns of the input keep their names, whatever they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexpanel.llm.common import map_arrow, materialize, packed, quoted, scratch
from indexpanel.llm.word_hash import batches_by_bytes, byte_values

SIZES = (2, 3, 4, 5)
BITS = 18
PER_CLASS = 10_000  # most training documents of a class
FEATURES = 4096  # most buckets with a weight
ERRORS = 3  # least distance of a ratio from 0
SMOOTHING = 1.0
PENALTY = 1e-4
ROUNDS = 250
PIECE = 1 << 20  # characters worked on at once
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Weights of values that are the log-count ratio of their bucket."""
    buckets: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    intercept: float


def normalized(text: bytes | None) -> str:
    words = (text or b"").decode().lower().split()
    return f" {' '.join(words)} " if words else ""


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Characters and the number of their text, in runs of about PIECE; n-grams at a cut are in the next piece again."""
    held: list[tuple[int, str]] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        characters = np.frombuffer("".join(t for _, t in held).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        return characters, np.repeat([i for i, _ in held], [len(t) for _, t in held])

    for i, raw in enumerate(texts):
        text = normalized(raw)
        for at in range(0, len(text), PIECE):
            if size and size + min(PIECE, len(text) - at) > PIECE:
                yield joined()
                held, size = [], 0
            held.append((i, text[at:at + PIECE + SIZES[-1] - 1]))
            size += len(held[-1][1])
    if held:
        yield joined()


def buckets_of(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of every n-gram, repeated ones too."""
    for characters, owner in _pieces(texts):
        hashes = characters + np.uint64(1)
        for n in range(2, SIZES[-1] + 1):
            hashes = hashes[:-1] * _FACTOR + characters[n - 1:] if len(hashes) > 1 else hashes[:0]
            whole = owner[:len(hashes)] == owner[n - 1:][:len(hashes)]
            if n in SIZES:
                mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield owner[:len(hashes)][whole], (mixed >> np.uint64(64 - BITS)).astype(np.int32)[whole]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class by bucket, summed over the task."""
    totals = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for text, toxic in zip(byte_values(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
            seen = np.zeros(1 << BITS, bool)
            for _, found in buckets_of([text]):
                seen[found] = True
            totals[toxic] += seen
    at = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(totals[0][at]), pa.array(totals[1][at])],
                                     names=["bucket", "clean", "toxic"])


def _features(texts: list[bytes | None], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, feature) pairs; number has the feature of a bucket, or -1."""
    found = [np.empty(0, np.int64)]
    for owner, buckets in buckets_of(texts):
        feature = number[buckets]
        hit = np.flatnonzero(feature >= 0)
        found.append(np.unique(owner[hit].astype(np.int64) * FEATURES + feature[hit]))
    pairs = np.unique(np.concatenate(found))
    return pairs // FEATURES, pairs % FEATURES


def _numbers(buckets: np.ndarray) -> np.ndarray:
    number = np.full(1 << BITS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))
    return number


def _listed(buckets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbers(buckets)
        for batch in batches:
            for first, texts in batches_by_bytes(byte_values(batch.column("text"))):
                owner, feature = _features(texts, number)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), batch.column("toxic").slice(first, len(texts)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))], names=["id", "toxic", "features"])
    return run


def logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int,
             penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept of the least weighted log loss plus penalty / 2 times the squared weights.

    Accelerated gradient steps of the length that the largest curvature allows, restarted when they point uphill.
    """
    weight = weight / weight.sum()

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, value * w[column], len(label)) + w[n]

    def back(g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(column, value * g[row], n), g.sum())

    probe = np.ones(n + 1)
    for _ in range(20):  # power iteration on the curvature, at most a quarter of the weighted square
        probe = back(weight * forward(probe)) / 4
        curvature = np.linalg.norm(probe)
        probe /= curvature
    step = 1 / (1.1 * curvature + penalty)
    rate = min(max(weight @ label, 1e-6), 1 - 1e-6)
    w = np.zeros(n + 1)
    w[n] = np.log(rate / (1 - rate))
    ahead, momentum = w, 1.0
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(forward(ahead), -500, 500)))
        slope = back(weight * (chance - label)) + penalty * np.append(ahead[:n], 0)
        after = ahead - step * slope
        if slope @ (after - w) > 0:
            momentum = 1.0
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        ahead = after + (momentum - 1) / following * (after - w)
        w, momentum = after, following
    return w[:n], float(w[n])


def _sampled(docs: DataFrame, labels: DataFrame, id: str, text: str, per_class: int) -> tuple[DataFrame, list[int]]:
    """id, toxic, text of the training documents, and the labels of either class."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
             .groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")))
    known = materialize(known)
    chosen = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    sample = materialize(chosen[0].unionAll(chosen[1]))
    totals = dict(known.groupBy("toxic").count().collect())
    rows = docs.select(F.col(quoted(id)).alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    # At most 2 * per_class rows of two numbers: the bound of the sample is that of the broadcast.
    texts = rows.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return materialize(texts.repartition("id")), [totals.get(c, 0) for c in (0, 1)]


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS) -> Model:
    """The classifier of the given labels; labels has the columns id and label."""
    with scratch():
        labels = labels.select(F.col(quoted(id)).alias("id"), F.col(quoted(label)).alias("toxic"))
        sample, totals = _sampled(docs, labels, id, text, per_class)
        prior = (totals[1] + 0.5) / (sum(totals) + 1)
        none = Model(np.empty(0, np.int64), np.empty(0), np.empty(0), float(np.log(prior / (1 - prior))))
        counts = materialize(map_arrow(sample.select("toxic", "text"), _counted, "bucket int, clean long, toxic long")
                             .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
        sums = counts.agg(F.sum("clean"), F.sum("toxic")).first()
        if not all(sums):
            return none
        share = [(F.col(c) + SMOOTHING) / (s + SMOOTHING * (1 << BITS)) for c, s in zip(("clean", "toxic"), sums, strict=True)]
        ratio: Column = F.log(share[1]) - F.log(share[0])
        error = F.sqrt(1 / (F.col("clean") + SMOOTHING) + 1 / (F.col("toxic") + SMOOTHING))
        kept = (counts.select("bucket", ratio.alias("ratio"), F.round(F.abs(ratio) / error, 9).alias("far"))
                .where(F.col("far") >= ERRORS).orderBy(F.desc("far"), "bucket").limit(FEATURES).select("bucket", "ratio").collect())
        if not kept:
            return none
        buckets, ratios = np.array([r.bucket for r in kept], np.int64), np.array([r.ratio for r in kept])
        rows = sorted(map_arrow(sample, _listed(buckets), "id long, toxic int, features array<int>").collect())
    lengths = [len(r.features) for r in rows]
    column = np.fromiter((f for r in rows for f in r.features), np.int64, sum(lengths))
    toxic = np.array([r.toxic for r in rows], float)
    seen = [max((toxic == c).sum(), 1) for c in (0, 1)]
    weight = np.where(toxic == 1, totals[1] / seen[1], totals[0] / seen[0])
    weights, intercept = logistic(np.repeat(np.arange(len(rows)), lengths), column, ratios[column], toxic, weight, len(buckets))
    return Model(buckets, ratios, weights, intercept)


def scores(texts: list[bytes | None], model: Model, number: np.ndarray) -> np.ndarray:
    owner, feature = _features(texts, number)
    total = np.bincount(owner, (model.weights * model.ratios)[feature], len(texts)) + model.intercept
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row without its text as the struct `row`, and `score`, the probability that its text is toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbers(model.buckets)
        for batch in batches:
            for first, texts in batches_by_bytes(byte_values(batch.column("text"))):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(first, len(texts)), pa.array(scores(texts, model, number))],
                                                 names=["row", "score"])

    others = [c for c in docs.columns if c != text]
    rows = packed(docs, text=F.col(quoted(text))).withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in others]))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return map_arrow(rows, run, schema)
