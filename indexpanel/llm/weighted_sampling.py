"""Document fingerprints by improved consistent weighted sampling (Ioffe, ICDM 2010).

A text is a weighted set: its words (A-Z lowered) weighted by their numbers of occurrence. For each of K samples a word w of
weight S draws r, c ~ Gamma(2, 1) and b ~ U(0, 1), fixed by (w, sample); t = floor(ln S / r + b), ln y = r (t - b) and
ln a = ln c - ln y - r; the sample is the pair (w, t) with the least a. Two texts agree in a sample with a probability
equal to their generalised Jaccard similarity, sum of minima over sum of maxima of the weights. A fingerprint is K hashes
of 16 bits; likeness is the share of equal ones.

Each document is also compared with its edited text and with the next document by descending id. The next document's text is
needed in the same task, so documents are dealt into ranges of ids, sorted inside, and read in one pass; the first document
of a range goes to the range before it too. The range bounds are as many ids as there are ranges.

Defined results: null text counts as empty; a text without words has the fingerprint of zeros, equal to itself; equal ids
follow by text; null ids come last, and rows with one id stay in one range; a single row is its own next one; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexpanel.llm.common import map_arrow, packed, quoted
from indexpanel.llm.word_hash import batches_by_bytes, byte_values, hashed_words, mix

K = 64
BATCH = 4 << 20  # bytes of text worked on at once
REMEMBERED = 30_000  # words whose draws a worker keeps
BLOCK = 30_000  # words whose draws are held at once
RESULT = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double")


class Draws:
    """The draws of words, one row per word; those of the commonest words of the first batch are remembered."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.known: np.ndarray | None = None

    def remember(self, words: np.ndarray, counts: np.ndarray) -> None:
        if self.known is None:
            self.known = np.sort(words[np.argsort(-counts, kind="stable")[:REMEMBERED]])
            self.values = self._drawn(self.known)

    def of(self, words: np.ndarray) -> np.ndarray:
        """(3, len(words), k): r, b, ln c - r."""
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        hit = self.known[at] == words
        out = np.empty((3, len(words), self.k), np.float32)
        out[:, hit] = self.values[:, at[hit]]
        out[:, ~hit] = self._drawn(words[~hit])
        return out

    def _drawn(self, words: np.ndarray) -> np.ndarray:
        base = words[:, None] + np.arange(1, self.k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        uniform = []
        for i in range(3):
            bits = mix(base ^ np.uint64(0xA0761D6478BD642F * (2 * i + 1) & (1 << 64) - 1))
            for shift in (40, 16):
                part = ((bits >> np.uint64(shift)) & np.uint64(0xFFFFFF)).astype(np.float32)
                uniform.append((part + np.float32(0.5)) * np.float32(2.0**-24))
        r = -np.log(uniform[0] * uniform[1])
        return np.stack([r, uniform[4], np.log(-np.log(uniform[2] * uniform[3])) - r])


def fingerprints(texts: list[bytes | None], k: int, draws: Draws) -> np.ndarray:
    """(len(texts), k) uint16."""
    hashes, owner = hashed_words(texts, lower=True)
    out = np.zeros((len(texts), k), np.uint16)
    if not len(hashes):
        return out
    vocabulary, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    draws.remember(vocabulary, counts)
    pair, weight = np.unique(owner * len(vocabulary) + number, return_counts=True)
    owner, number = pair // len(vocabulary), pair % len(vocabulary)
    log_weight = np.log(weight.astype(np.float32))[:, None]
    least = np.full((len(texts), k), np.inf, np.float32)
    samples = np.arange(k)
    for start in range(0, len(vocabulary), BLOCK):
        r, b, rest = draws.of(vocabulary[start:start + BLOCK])
        here = np.flatnonzero((number >= start) & (number < start + BLOCK)) if len(vocabulary) > BLOCK else slice(None)
        words, owners, logs = number[here] - start, owner[here], log_weight[here]
        bounds = np.searchsorted(owners, np.arange(len(texts) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            w = words[bounds[i]:bounds[i + 1]]
            rw, bw = r[w], b[w]
            t = np.floor(logs[bounds[i]:bounds[i + 1]] / rw + bw)
            a = rest[w] - rw * (t - bw)
            best = a.argmin(axis=0)
            lower = a[best, samples] < least[i]
            chosen = mix(vocabulary[start + w[best]] + t[best, samples].astype(np.int64).astype(np.uint64))
            out[i][lower] = (chosen >> np.uint64(48)).astype(np.uint16)[lower]
            least[i][lower] = a[best, samples][lower]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first ones, or all it has."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _compared(k: int):
    """Rows come sorted by part and order; the last of a part is `ahead`: it only serves as the next one of the row before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(k)
        held = None  # the last row, which waits for its next one: (part, ahead, id, text, fingerprint)
        for batch in batches:
            parts, ahead, ids = (batch.column(c).to_pylist() for c in ("part", "ahead", "id"))
            for first, texts in batches_by_bytes(byte_values(batch.column("text")), BATCH):
                rows = [(parts[i], ahead[i], ids[i], t or b"") for i, t in enumerate(texts, first)]
                waiting = rows if held is None else [held[:4], *rows]
                pairs = [(x, y) for x, y in zip(waiting, waiting[1:], strict=False) if x[0] == y[0] and not x[1]]
                bodies = [x[3].decode() for x, _ in pairs]
                changed = [edited(t, y[3].decode()).encode() for t, (_, y) in zip(bodies, pairs, strict=True)]
                found = fingerprints([r[3] for r in rows] + changed, k, draws)
                own = list(found[:len(rows)]) if held is None else [held[4], *found[:len(rows)]]
                held = (*rows[-1], own[-1])
                if pairs:
                    at = [i for i, (x, y) in enumerate(zip(waiting, waiting[1:], strict=False)) if x[0] == y[0] and not x[1]]
                    mine, following, new = np.array([own[i] for i in at]), np.array([own[i + 1] for i in at]), found[len(rows):]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(t) for t in bodies], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in changed]), _text(mine), _text(new),
                        pa.array(likeness(mine, new)), pa.array(likeness(mine, following))],
                        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                               "near_next"])
    return run


def _text(prints: np.ndarray) -> pa.Array:
    return pa.array([p.astype(">u2").tobytes().hex() for p in prints])


def fingerprinted(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """docs with the column `fingerprint` added; a text's print depends on nothing but the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws(k)
        for batch in batches:
            for first, texts in batches_by_bytes(byte_values(batch.column("text")), BATCH):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(first, len(texts)), _text(fingerprints(texts, k, draws))],
                    names=["row", "fingerprint"])

    rows = packed(docs, text=F.col(quoted(text)))
    schema = T.StructType([rows.schema["row"], T.StructField("fingerprint", T.StringType())])
    return map_arrow(rows, run, schema).select("row.*", "fingerprint")


def _range_of(id: Column, bounds: list[int], first: int = 0) -> Column:
    """Number of bounds at or below the id, by halving."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(id >= bounds[middle], _range_of(id, bounds[middle + 1:], first + middle + 1)).otherwise(
        _range_of(id, bounds[:middle], first))


def compared(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, ranges: int | None = None) -> DataFrame:
    """RESULT of every row. `ranges`, by default the number of shuffle partitions, is how many parts the ids are cut into."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(quoted(id)).cast("long").alias("id"), F.col(quoted(text)).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    cut = rows.agg(F.percentile_approx("id", shares, 20 * ranges)).first()[0] if shares else None
    bounds = sorted(set(cut or []))
    part = F.when(F.col("id").isNull(), len(bounds) + 1).otherwise(F.lit(len(bounds)) - _range_of(F.col("id"), bounds))
    rows = rows.select(part.cast("int").alias("part"), "id", F.xxhash64("text").alias("hash"), "text")
    heads = rows.groupBy("part").agg(F.min(F.struct((-F.col("id")).alias("down"), "hash")).alias("h")).orderBy("part").collect()
    if not heads:
        return spark.createDataFrame([], RESULT)
    before = [(heads[i - 1].part, None if h.h.down is None else -h.h.down, h.h.hash) for i, h in enumerate(heads)]
    serve = spark.createDataFrame(before, "serves int, head_id long, head_hash long")
    # Filtered by the few ids before the join, so that no other text is shuffled for it.
    few = F.col("id").isin([i for _, i, _ in before if i is not None]) | (F.col("id").isNull() & F.lit(None in [i for _, i, _ in before]))
    ahead = (rows.where(few).join(serve, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash")))
             .select(F.col("serves").alias("part"), "id", "hash", "text").dropDuplicates(["part"]))
    both = rows.withColumn("ahead", F.lit(False)).unionByName(ahead.withColumn("ahead", F.lit(True)))
    dealt = both.repartition(max(ranges, 1), "part").sortWithinPartitions(
        "part", "ahead", F.col("id").desc_nulls_last(), "hash", "text")
    return map_arrow(dealt.select("part", "ahead", "id", "text"), _compared(k), RESULT)
