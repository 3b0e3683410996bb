"""Merkle manifest of a dataset: leaves find their places by rank queries on bitmaps, slot arrays reduce the levels.

Per group (language) the ids of all documents are a bitmap kept as its non-empty words of 64 bits, merged by bit_or from any
partition of the rows. A directory of popcounts lies over the words: containers of 2^16 ids, and three wider levels; every
prefix sum runs over at most 2^16 entries under one parent, whatever the ids are. The rank of an id is the directory's count
before its word, plus the bits below it in the word. No leaf is sorted. Ids that several documents share keep their numbers
beside the word; such documents follow each other by leaf, and equal ones are one row with a count until they get their slots.

Rank r has slot r mod 1024 of block r div 1024. A task builds the tree of a block from its slot array and passes the top on as
a node of the next round, ten levels at a time, until every group has one node; the tops of the groups are reduced likewise.
Then paths are handed down, block by block, and each leaf gets the siblings from its level up to the root.

A parent is the SHA-256 of its children's hex digests, one or two of them. A step of a proof is `l` or `r` (the sibling stands
left or right) and the sibling's digest, or `n` (no sibling).

Defined results: null ids come before all others, by leaf; a null group comes before all others and is not the empty string;
repeated rows are leaves of their own; null fields are hashed as `-`, empty ones as `0:`; texts of any length are hashed whole
where they are read; an empty table gives an empty result. Only the columns named are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexpanel.llm.common import map_arrow, materialize, quoted, scratch

LEVELS = 10
FAN = 1 << LEVELS
BLOCKS_AT_ONCE = 16
RUN = 1 << 16  # equal leaves that are numbered in one go
SHIFTS = (10, 16, 16)  # from words to containers, and to the two levels above; what is left is at most 2^16 entries


def leaf_hash(*fields: Column) -> Column:
    """Hex SHA-256 of the fields, each `-` if null, else its number of UTF-8 bytes, a colon, and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in texts]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(node: Column, step: Column) -> Column:
        side, sibling = F.substring(step, 1, 1), F.substring(step, 2, 64)
        return F.sha2(F.when(side == "l", F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)
    return F.aggregate(proof, leaf, up)


def siblings_hash(proof: Column) -> Column:
    """Hex SHA-256 of the siblings of a proof, from the leaf up."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""), 256)


def _before(values: str, window: Window) -> Column:
    """Sum of the values of earlier rows of the window."""
    return F.coalesce(F.sum(values).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")


def directory(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From g, present, id, m: the bitmap's words (g, present, word, bits, shared, base), and n per g.

    `shared` lists the (bit, documents) of ids that several documents have; `base` counts the documents before the word.
    """
    bit = F.expr("CAST(id & 63 AS INT)")
    words = materialize(ids.groupBy("g", "present", F.shiftright("id", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(id & 63 AS INT)))").alias("bits"), F.sum("m").alias("n"),
        F.collect_list(F.when(F.col("m") > 1, F.struct(bit.alias("bit"), F.col("m").alias("m")))).alias("shared")))
    levels = [words.select("g", "present", F.col("word").alias("k0"), "n")]
    for i, shift in enumerate(SHIFTS):
        parent = F.shiftright(f"k{i}", shift).alias(f"k{i + 1}")
        levels.append(materialize(levels[-1].groupBy("g", "present", parent).agg(F.sum("n").alias("n"))))
    top = len(SHIFTS)
    base = levels[top].select("g", "present", f"k{top}", _before("n", Window.partitionBy("g").orderBy("present", f"k{top}")).alias("base"))
    for i in range(top - 1, -1, -1):
        parent = F.shiftright(f"k{i}", SHIFTS[i]).alias(f"k{i + 1}")
        inside = _before("n", Window.partitionBy("g", "present", f"k{i + 1}").orderBy(f"k{i}")).alias("inside")
        base = (levels[i].select("g", "present", f"k{i}", parent, "n").select("g", "present", f"k{i}", f"k{i + 1}", inside)
                .join(base, ["g", "present", f"k{i + 1}"])
                .select("g", "present", f"k{i}", (F.col("base") + F.col("inside")).alias("base")))
    placed = words.drop("n").join(base.withColumnRenamed("k0", "word"), ["g", "present", "word"])
    return placed, levels[top].groupBy("g").agg(F.sum("n").alias("n"))


def _behind(leaves: DataFrame, ids: DataFrame) -> DataFrame:
    """g, present, id, leaf, claim, behind: for different documents of one id, how many of them have a lower leaf.

    The leaves of an id are counted by their first 16 bits, so no window holds more than a 65,536th of them.
    """
    tied = leaves.join(ids.where("d > 1").select("g", "present", "id"), ["g", "present", "id"]).withColumn(
        "head", F.substring("leaf", 1, 2))
    heads = tied.groupBy("g", "present", "id", "head").agg(F.sum("c").alias("n"))
    heads = heads.select("g", "present", "id", "head", _before("n", Window.partitionBy("g", "present", "id").orderBy("head")).alias("lower"))
    inside = _before("c", Window.partitionBy("g", "present", "id", "head").orderBy("leaf", "claim"))
    return (tied.select("g", "present", "id", "head", "leaf", "claim", inside.alias("inside"))
            .join(heads, ["g", "present", "id", "head"])
            .select("g", "present", "id", "leaf", "claim", (F.col("lower") + F.col("inside")).alias("behind")))


def ranked(rows: DataFrame) -> DataFrame:
    """From g, present, id, leaf, claim: each row's place `rank` in its g, and the size n of g."""
    leaves = materialize(rows.groupBy("g", "present", "id", "leaf", "claim").agg(F.count("*").alias("c")))
    ids = materialize(leaves.groupBy("g", "present", "id").agg(F.sum("c").alias("m"), F.count("*").alias("d")))
    words, totals = directory(ids)
    behind = materialize(_behind(leaves, ids))
    words, totals = materialize(words), materialize(totals)
    runs = leaves.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(c - 1) div {RUN}"))).alias("run"))
    runs = runs.repartition("g", "id", "leaf", "run").withColumn("word", F.shiftright("id", 6))
    same = [runs[k] == behind[k] for k in ("g", "present", "id", "leaf")] + [runs["claim"].eqNullSafe(behind["claim"])]
    runs = runs.join(behind, same, "left").select(
        *[runs[k] for k in ("g", "present", "id", "word", "leaf", "claim", "c", "run")], F.coalesce("behind", F.lit(0)).alias("behind"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, CAST(id & 63 AS INT)))")
    extra = F.expr("aggregate(shared, 0L, (t, s) -> t + if(s.bit < (id & 63), s.m - 1, 0L))")
    found = (runs.join(words, ["g", "present", "word"])
             .select("g", "present", "id", "leaf", "claim", "c", "run", (F.col("base") + below + extra + F.col("behind")).alias("rank")))
    last = F.least(F.col("c") - 1, F.col("run") * RUN + (RUN - 1))
    slots = found.withColumn("i", F.explode(F.sequence(F.col("run") * RUN, last))).select(
        "g", "present", "id", "leaf", "claim", (F.col("rank") + F.col("i")).alias("rank"))
    return slots.join(totals, "g")


def _height(n: int) -> int:
    """Levels that one round reduces n nodes by."""
    return LEVELS if n > FAN else (n - 1).bit_length()


def _parent(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def tree(hashes: list[str], height: int) -> list[list[str]]:
    """All levels over the nodes of a block, the top last."""
    levels = [hashes]
    for _ in range(height):
        now = levels[-1]
        levels.append([_parent(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return levels


def path(levels: list[list[str]], slot: int) -> list[str]:
    """The steps of a proof inside the block."""
    steps = []
    for nodes in levels[:-1]:
        other = slot ^ 1
        steps.append("n" if other >= len(nodes) else ("l" if other < slot else "r") + nodes[other])
        slot >>= 1
    return steps


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict], list[list[str]]]]:
    """Block by block: its row, its nodes by slot, its tree."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCKS_AT_ONCE):
            for row in batch.slice(start, BLOCKS_AT_ONCE).to_pylist():
                nodes: list = [None] * len(row["slots"])
                for node in row["slots"]:
                    nodes[node["rank"] % FAN] = node
                yield row, nodes, tree([x["leaf"].hex() for x in nodes], _height(row["n"]))


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("g", pa.string()), ("rank", pa.int64()), ("leaf", pa.binary()), ("n", pa.int64())])
    for row, _, levels in _blocks(batches):
        yield pa.RecordBatch.from_pylist([{"g": row["g"], "rank": row["block"], "leaf": bytes.fromhex(levels[-1][0]),
                                           "n": -(-row["n"] // FAN)}], schema)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("g", pa.string()), ("rank", pa.int64()), ("steps", pa.list_(pa.string()))])
    for row, nodes, levels in _blocks(batches):
        yield pa.RecordBatch.from_pylist([{"g": row["g"], "rank": x["rank"], "steps": path(levels, slot) + row["steps"]}
                                          for slot, x in enumerate(nodes)], schema)


_LEAVES = "g string, id long, rank long, leaf string, claim string, proof array<string>"


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("g", pa.string()), ("id", pa.int64()), ("rank", pa.int64()), ("leaf", pa.string()), ("claim", pa.string()),
                        ("proof", pa.list_(pa.string()))])
    for row, nodes, levels in _blocks(batches):
        yield pa.RecordBatch.from_pylist([
            {"g": row["g"], "id": x["id"] if x["present"] else None, "rank": x["rank"], "leaf": x["leaf"].hex(),
             "claim": x["claim"].hex() if x["claim"] is not None else None, "proof": path(levels, slot) + row["steps"]}
            for slot, x in enumerate(nodes)], schema)


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """g, block, n, slots: the nodes of each block, in no order."""
    columns = [c for c in nodes.columns if c not in ("g", "n")]
    return nodes.groupBy("g", F.shiftright("rank", LEVELS).alias("block")).agg(
        F.max("n").alias("n"), F.collect_list(F.struct(*columns)).alias("slots"))


def reduced(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and the last node of every g."""
    rounds = []
    while True:
        rounds.append(materialize(_in_blocks(nodes)))
        nodes = materialize(map_arrow(rounds[-1], _tops, "g string, rank long, leaf binary, n long"))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return rounds, nodes


def manifest(docs: DataFrame, leaf: Column, id: str = "doc_id", group: str = "lang", claim: Column | None = None) -> DataFrame:
    """One row per document: id, group, rank in the group, leaf, claim, subroot, root, proof.

    leaf is the digest of the document's fields. claim, another digest of the document or null, is carried along, so that it
    can be folded with the proof of the leaf.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    key = F.col(quoted(id)).cast("long")
    rows = docs.select(
        F.when(F.col(quoted(group)).isNull(), "").otherwise(F.concat(F.lit("x"), F.col(quoted(group)).cast("string"))).alias("g"),
        key.isNotNull().cast("int").alias("present"), F.coalesce(key, F.lit(0)).alias("id"),
        F.unhex(leaf).alias("leaf"), F.unhex(claim).alias("claim"))
    with scratch() as keep:
        rounds, tops = reduced(ranked(rows))
        # One row per group: the subroots are leaves of the tree above, ordered by group.
        order = Window.orderBy("g")
        above = tops.select("g", "leaf", (F.row_number().over(order) - 1).cast("long").alias("rank"))
        above = materialize(above)
        upper_rounds, root = reduced(above.select(F.lit("").alias("g"), "rank", "leaf", F.lit(above.count()).alias("n")))
        steps = upper_rounds[-1].select("g", "block", F.array().cast("array<string>").alias("steps"))
        for blocks in reversed(upper_rounds):
            steps = _handed_down(blocks, steps)
        steps = materialize(above.join(steps.drop("g").withColumnRenamed("block", "rank"), "rank").select(
            "g", F.lit(0).cast("long").alias("block"), "steps"))
        for blocks in reversed(rounds[1:]):
            steps = materialize(_handed_down(blocks, steps))
        found = map_arrow(rounds[0].join(steps, ["g", "block"]), _leaves, _LEAVES)
        ends = tops.select("g", F.lower(F.hex("leaf")).alias("subroot")).join(root.select(F.lower(F.hex("leaf")).alias("root")))
        return keep(found.join(ends, "g").select(
            "id", F.when(F.col("g") != "", F.expr("substring(g, 2)")).alias("group"), "rank", "leaf", "claim", "subroot", "root", "proof"))


def _handed_down(blocks: DataFrame, steps: DataFrame) -> DataFrame:
    """The steps of the nodes of each block, under those of the block."""
    found = map_arrow(blocks.join(steps, ["g", "block"]), _paths, "g string, rank long, steps array<string>")
    return found.withColumnRenamed("rank", "block")
