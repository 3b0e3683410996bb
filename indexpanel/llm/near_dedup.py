"""Near-duplicate documents: SetSketch registers banded into candidates, likelihood, exact check, components.

A document's set holds the distinct shingles of its words (A-Z lowered). Documents with equal sets are one node. Nodes are
candidates when the registers of a band agree; with bands of 5 of 211 registers a pair of similarity 0.8 meets in
at least one of 42 bands but for 6 cases in 10^8. Candidates whose likelihood estimate lies more than 8 standard errors
below the threshold are dropped, the others are confirmed on their full sets of 64-bit shingle hashes.

A bucket (equal registers in a band) of g nodes never becomes g^2 pairs: its members are first compared with one member,
then with another one of each bucket that is still open; linked nodes form components, and only nodes that are
still in different components of their bucket and share enough shingles with others to have a link at all are compared
one by one, inside the join. So copies cost one comparison each, no link between components is lost, no bucket is capped.

Defined results: null text and text without words have an empty set and are linked with nothing; a text shorter than a
shingle is one shingle; rows with a null id belong to components but give them no id; repeated rows are copies; empty
tables give empty results; texts of any length are hashed whole, in parts of bounded size. Only the columns named are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexpanel.llm import setsketch
from indexpanel.llm.common import map_arrow, materialize, packed, quoted, scratch, unpacked
from indexpanel.llm.components import components
from indexpanel.llm.word_hash import batches_by_bytes, byte_values, hashed_words, mix

BAND = 5
BANDS = setsketch.M // BAND
STAR_ROUNDS = 1


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes, sorted within each text, and the number of the text each belongs to."""
    words, owner = hashed_words(texts, lower=True)
    counts = np.bincount(owner, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    hashes, owners = [], []
    for length in range(1, size + 1):  # a text with fewer words is one shingle of its own length
        if length < size:
            at = starts[counts == length]
        else:
            at = np.flatnonzero(owner[size - 1:] == owner[:len(owner) - size + 1]) if len(owner) >= size else starts[:0]
        h = np.full(len(at), length, np.uint64)
        for k in range(length):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
        hashes.append(h)
        owners.append(owner[at])
    shingles, owner = np.concatenate(hashes), np.concatenate(owners)
    if size > 1:  # back into the order of the texts
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        shingles[a:b].sort()
    kept = np.ones(len(shingles), bool)
    kept[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[kept], owner[kept]


SIGNATURE = "id long, text_hash long, n int, set_hash binary, registers binary"


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in batches_by_bytes(byte_values(batch.column("text"))):
                yield _sketched(batch.slice(first, len(texts)), *shingle_sets(texts, size))
    return run


def _sketched(rows: pa.RecordBatch, shingles: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    n = np.bincount(owner, minlength=rows.num_rows)
    sets = np.split(shingles, np.cumsum(n)[:-1])
    found = setsketch.registers(shingles, owner, rows.num_rows)
    return pa.RecordBatch.from_arrays([
        rows.column("id"), rows.column("text_hash"), pa.array(n, pa.int32()),
        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
        pa.array([r.tobytes() for r in found], pa.binary())], names=["id", "text_hash", "n", "set_hash", "registers"])


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in batches_by_bytes(byte_values(batch.column("text"))):
                shingles, owner = shingle_sets(texts, size)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, len(texts)), lists],
                                                 names=["node", "shingles"])
    return run


def _promising(threshold: float):
    """Keeps the pairs whose likelihood estimate isn't clearly below the threshold."""
    least = threshold - 8 * (threshold * (1 - threshold) / setsketch.M) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, setsketch.M)
                    for c in ("ra", "rb"))
            n = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb")]
            kept = pa.array(setsketch.likeness(a, b, *n) >= least)
            yield batch.select(["a", "b"]).filter(kept)
    return run


def _band_keys() -> Column:
    """One 64-bit key per band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("registers"), k * F.lit(2 * BAND) + 1, F.lit(2 * BAND))))


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("registers").alias(f"r{name}"))

    def full(name: str) -> DataFrame:
        return needed.select(F.col("node").alias(name), F.col("shingles").alias(f"s{name}"))

    likely = pairs.join(side("a"), "a").join(side("b"), "b")
    likely = likely.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    likely = materialize(map_arrow(likely, _promising(percent / 100), "a long, b long"))
    ends = materialize(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    needed = sets.join(ends, "node", "left_semi")
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return likely.join(full("a"), "a").join(full("b"), "b").where(100 * both >= percent * union).select("a", "b")


def grouped(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of docs: row, id, text_hash, n_shingles, component, component_id (its least id), is_first.

    row is a number given here; component is the same number for all rows of a component, also without ids; is_first marks
    one row of each, that of the least id. Tables written on the way are deleted before it returns.
    """
    with scratch() as keep:
        return keep(_grouped(docs, id, text, size, percent))


def _grouped(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    source = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).alias("text"))
    source = source.select("id", F.xxhash64("text").alias("text_hash"), "text")
    signed = map_arrow(source, _signatures(size), SIGNATURE)
    signed = materialize(signed.withColumn("row", F.monotonically_increasing_id()))
    filled = signed.where("n > 0")
    # Registers stay out of the shuffle: a set's least row is found without them, and the other rows are the shorter list.
    first = F.min(F.struct("row", "id", "text_hash", "n")).alias("x")
    nodes = materialize(filled.groupBy("set_hash").agg(first).select(F.col("x.row").alias("node"), "set_hash", "x.id", "x.text_hash", "x.n"))
    others = materialize(filled.select("row").join(nodes, filled["row"] == nodes["node"], "left_anti"))
    bands = filled.join(others, "row", "left_anti").select(F.col("row").alias("node"), F.explode(_band_keys()).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    met = materialize(bands.join(shared.select("key"), "key", "left_semi").select("key", "node"))
    members = materialize(met.join(met.groupBy("key").agg(F.min("node").alias("centre")), "key").select("key", "node", "centre"))
    linkable = materialize(members.select("node").distinct())
    candidates = materialize(filled.withColumnRenamed("row", "node").join(linkable, "node", "left_semi")
                             .select("node", "id", "text_hash", "n", "registers"))
    name = ["text_hash", "no_id", "some_id"]  # null-safe in plain columns, so that join and aggregation share one exchange
    named = [F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("some_id")]
    wanted = candidates.select("node", "text_hash", *named)
    # 32 bits of the wanted hashes leave out nearly all other texts, mostly without a shuffle of the texts.
    few = materialize(candidates.select(F.hash("text_hash").alias("short")).distinct())
    likely = source.withColumn("short", F.hash("text_hash")).join(few, "short", "left_semi").select("text_hash", *named, "text")
    texts = likely.groupBy(*name).agg(F.first("text").alias("text")).join(wanted, name)
    sets = materialize(map_arrow(texts.select("node", "text"), _sets(size), "node long, shingles array<long>"))

    def pairs_of(rows: DataFrame) -> DataFrame:
        return rows.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    links = materialize(_verified(pairs_of(members.select(F.col("node").alias("x"), F.col("centre").alias("y"))),
                                  candidates, sets, percent))
    for round_ in range(STAR_ROUNDS):
        open_members = _open(members, components(links))
        order = F.xxhash64(F.lit(round_), "node")
        centre = open_members.groupBy("key").agg(
            F.min_by(F.struct("node", "component"), order).alias("c"))
        pairs = (open_members.join(centre, "key").where(F.col("component") != F.col("c.component"))
                 .select(F.col("node").alias("x"), F.col("c.node").alias("y")))
        links = materialize(links.unionAll(_verified(pairs_of(pairs), candidates, sets, percent)))
    links = materialize(links.unionAll(_across(materialize(_open(members, components(links))), candidates, sets, percent)))

    parts = components(links)
    labelled = (nodes.select("node", "set_hash").join(parts, "node", "left")
                .select("set_hash", F.coalesce("component", "node").alias("component")))
    rows = materialize(signed.select("row", "id", "text_hash", "n", "set_hash").join(labelled, "set_hash", "left")
                       .select("row", "id", "text_hash", F.col("n").cast("long").alias("n_shingles"),
                               F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("row")).alias("component")))
    least = rows.groupBy("component").agg(
        F.min("id").alias("component_id"),
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first"))
    return rows.join(least, "component").select(
        "row", "id", "text_hash", "n_shingles", "component", "component_id",
        (F.col("row") == F.col("first.row")).alias("is_first"))


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component, one with the least id; rows with an empty set all stay.

    docs is read several times and must be the same each time, as a table is. A row is known by its id and the hash of its
    text; of rows that agree in both, all of one component, the least row stays.
    """
    with scratch() as keep:
        rows = grouped(docs, id, text, size, percent)
        found = materialize(rows.groupBy("id", "text_hash").agg(F.count("*").alias("n"), F.count_if("is_first").alias("stay")))
        ids = found.groupBy("id").agg(F.sum("n").alias("n"), F.sum("stay").alias("stay"))
        # Ids without a row that stays are the shorter list: where Spark can broadcast it, no text is shuffled.
        gone = keep(ids.where("stay = 0").select(F.col("id").alias("gone")))
        mixed = ids.where("stay > 0 AND stay < n").select(F.col("id").alias("known_id"))
        some = found.where("stay < n").withColumnRenamed("text_hash", "known_hash")
        some = keep(some.join(mixed, F.col("id").eqNullSafe(F.col("known_id"))).select("known_id", "known_hash", "stay"))
        twins = keep(some.where("stay > 0"))
    docs_by_name = packed(docs, id=F.col(quoted(id)), text_hash=F.xxhash64(F.col(quoted(text))))
    same = F.col("id").eqNullSafe(F.col("known_id")) & (F.col("text_hash") == F.col("known_hash"))
    single = docs_by_name.join(gone, F.col("id").eqNullSafe(F.col("gone")), "left_anti").join(some, same, "left_anti").select("row")
    least = docs_by_name.join(twins, same, "left_semi").groupBy("id", "text_hash").agg(F.min("row").alias("row")).select("row")
    return unpacked(single.unionAll(least), docs.columns)


def _across(open_members: DataFrame, candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of one bucket that are still in different components, confirmed on their full sets.

    Only shingles that two open nodes have can be in an intersection, so their number bounds it: nodes and pairs whose
    bound is too low are left out first. The confirmation is the condition of the join, so only links come out of it.
    """
    opened = sets.join(materialize(open_members.select("node").distinct()), "node", "left_semi")
    alone = (opened.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1").groupBy("node").agg(F.count("*").alias("own")))
    able = (candidates.select("node", "n").join(alone, "node", "left")
            .select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most"))
            .where(100 * F.col("most") >= percent * F.col("n")))
    # The sets are joined only to nodes whose bound allows a link with some node of another component in the bucket.
    small = materialize(_apart(open_members.join(able, "node")))
    other = small.select(*[F.col(c).alias(f"o_{c}") for c in ("key", "component", "n", "most")])
    possible = ((F.col("key") == F.col("o_key")) & (F.col("component") != F.col("o_component"))
                & ((100 + percent) * F.least("most", "o_most") >= percent * (F.col("n") + F.col("o_n"))))
    few = materialize(small.join(other, possible, "left_semi"))
    sizes = few.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("largest"))
    rows = few.join(sets, "node")
    minor = few.join(largest, "key").where("component <> largest").join(sets, "node")
    x = minor.select("key", *[F.col(c).alias(f"{c}_x") for c in ("node", "component", "n", "most", "shingles")])
    y = rows.select("key", *[F.col(c).alias(f"{c}_y") for c in ("node", "component", "n", "most", "shingles")])
    bound = F.least("most_x", "most_y")
    both = F.size(F.array_intersect("shingles_x", "shingles_y"))
    linked = F.when((F.col("component_x") != F.col("component_y"))
                    & ((100 + percent) * bound >= percent * (F.col("n_x") + F.col("n_y"))),
                    (100 + percent) * both >= percent * (F.col("n_x") + F.col("n_y")))
    found = x.join(y, (x["key"] == y["key"]) & linked)
    return found.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _open(members: DataFrame, parts: DataFrame) -> DataFrame:
    """key, node, component of the buckets that still have members in different components."""
    return _apart(members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")))


def _apart(rows: DataFrame) -> DataFrame:
    """The rows of buckets that have more than one component."""
    left = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return rows.join(left.select("key"), "key", "left_semi")
