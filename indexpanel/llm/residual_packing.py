"""Best-fit packing by hierarchical residuals: partitions fit locally, nearly full bins leave, underfull ones meet again.

Texts become token ids (byte-level BPE of a vocabulary file, then id 0 as the end mark). A document longer than a sequence
is cut into whole sequences after a shorter first piece; others stay whole. Every partition packs its pieces by best fit,
longest first. Bins filled to at least FULL leave; the others are items of the next round, in which one task gets the
bins of FAN_IN tasks, until one task holds all that is left or a round no longer lowers its number by a hundredth. A task
never gets more than TASK_ITEMS items on average, so the tree stops growing before a task does. In the last round all
bins leave. A bin carries the list of its pieces (at most a sequence long), so no join is needed to name places.

Defined results: null and empty texts are the single id 0; repeated rows are packed each; rows without an id keep a null
id; an empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexpanel.llm.common import map_arrow, materialize, quoted

END = 0
FULL = 0.995
FAN_IN = 8
TASK_ITEMS = 200_000
CACHE = 250_000  # chunks of text whose ids a worker remembers in a generation
FIRST = "\n\n"  # marks a text's first chunk; no chunk of a regular text starts so
PIECE = "struct<id:bigint,piece:int,start:bigint,length:int,crc:bigint,offset:bigint>"


def vocabulary(name: str = "byte_bpe_50k") -> str:
    """Path of a public vocabulary, as <path>.json for tokenizers and <path>.tiktoken for tiktoken."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json").removesuffix(".json")


class Ids:
    """Texts to the little-endian 32-bit ids that `tokenizers` gives them.

    Regular texts are cut into chunks that tokenize on their own, and the ids of chunks are remembered in two generations,
    the older of which is dropped when the younger is full. Unknown chunks of a batch go through tiktoken as one string:
    the same vocabulary and the same pattern, several times faster. All other texts go through `tokenizers` whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(f"{path}.json")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        """Remembers the ids of chunks, each of which starts with the space or line break that makes it independent."""
        marked = [("\n" + c[2:] if c.startswith(FIRST) else c if c[0] == "\n" else " " + c).encode() for c in chunks]
        found = np.array(self.fast.encode_ordinary(b"".join(marked).decode()), "<u4")
        ends = np.searchsorted(np.cumsum(self.width[found]), np.cumsum([len(m) for m in marked])) + 1
        bounds, joined = (4 * np.concatenate([[0], ends])).tolist(), found.tobytes()
        if len(self.young) + len(chunks) > CACHE:
            self.old, self.young = self.young, {}
        for chunk, a, z in zip(chunks, bounds[:-1], bounds[1:], strict=True):
            self.young[chunk] = joined[a + 4 if chunk.startswith(FIRST) else a:z]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split = [self._chunks(t) for t in texts]
        known, old, new = self.young, self.old, []
        for chunk in set().union(*(c for c in split if c is not None)):
            if chunk not in known:
                if chunk in old:
                    known[chunk] = old[chunk]
                else:
                    new.append(chunk)
        before = known
        if new:
            self.learn(new)
        known = self.young if self.young is before else before | self.young
        return [self.encode(t) if c is None else b"".join(map(known.__getitem__, c))
                for t, c in zip(texts, split, strict=True)]

    def _chunks(self, text: str) -> list[str] | None:
        """Chunks of a regular text, in which single spaces and line breaks part the words; None for any other."""
        if not text or text.replace("\n", " ").split(" ") != text.split() or any(s in text for s in self.special):
            return None
        return (FIRST + text.replace("\n", " \n")).split(" ")


def _pieces(path: str, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from indexpanel.llm.word_hash import batches_by_bytes

        ids = None
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids = ids or Ids(path)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, part in batches_by_bytes(texts):
                rows = []
                for i, found in enumerate(ids.texts(part), first):
                    found += end
                    n, at, piece = len(found) // 4, 0, 0
                    while at < n:
                        size = (n % length or length) if at == 0 and n > length else min(length, n - at)
                        cut = found[4 * at:4 * (at + size)]
                        rows.append((i, piece, at, size, zlib.crc32(cut), np.frombuffer(cut, "<u4") if with_ids else None))
                        at, piece = at + size, piece + 1
                column = list(zip(*rows, strict=True))
                arrays = [batch.column("id").take(pa.array(column[0], pa.int64())), pa.array(column[1], pa.int32()),
                          pa.array(column[2], pa.int64()), pa.array(column[3], pa.int32()), pa.array(column[4], pa.int64())]
                names = ["id", "piece", "start", "length", "crc"]
                if with_ids:
                    arrays.append(pa.array(column[5], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 2048, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, crc of every piece, and its token ids if asked for."""
    schema = "id long, piece int, start long, length int, crc long" + (", ids array<int>" if with_ids else "")
    source = docs.select(F.col(quoted(id)).cast("long").alias("id"), F.col(quoted(text)).alias("text"))
    return map_arrow(source, _pieces(path or vocabulary(), length, with_ids), schema)


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the open bin that it leaves the least room in."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(length + 1)]  # open bins by free places
    some = 0  # bit r: a bin with r free places exists
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            at = room[free].pop()
            if not room[free]:
                some ^= 1 << free
            bins[at].append(item)
        else:
            free, at = length, len(bins)
            bins.append([item])
        free -= size
        if free:
            room[free].append(at)
            some |= 1 << free
    return bins


BIN = f"fill int, pieces array<{PIECE}>"


def _round(length: int):
    """Packs the bins of a partition, TASK_ITEMS at a time; items are sizes and short lists, never texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= TASK_ITEMS:
                yield from _refitted(held, length)
                held = []
        yield from _refitted(held, length)
    return run


def _refitted(held: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    sizes = np.concatenate([np.empty(0, np.int64), *(b.column("fill").to_numpy() for b in held)]).astype(np.int64)
    if not len(sizes):
        return
    bins = best_fit(sizes, length)
    lists = pa.concat_arrays([b.column("pieces") for b in held])
    order = np.array([i for b in bins for i in b])
    flat = lists.take(pa.array(order)).flatten()
    edges = np.cumsum([0] + [len(b) for b in bins])
    totals = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy()[order])])[edges]
    fills = np.add.reduceat(sizes[order], edges[:-1])
    ends = np.cumsum(flat.field("length").to_numpy().astype(np.int64))
    offset = ends - flat.field("length").to_numpy() - np.repeat(np.cumsum(fills) - fills, np.diff(totals))
    names = [f.name for f in flat.type]
    flat = pa.StructArray.from_arrays([pa.array(offset) if n == "offset" else flat.field(n) for n in names], names=names)
    for a in range(0, len(bins), 20_000):
        z = min(len(bins), a + 20_000)
        starts = pa.array((totals[a:z + 1] - totals[a]).astype(np.int32))
        part = pa.ListArray.from_arrays(starts, flat.slice(totals[a], totals[z] - totals[a]))
        yield pa.RecordBatch.from_arrays([pa.array(fills[a:z].astype(np.int32)), part], names=["fill", "pieces"])


def packed_sequences(pieces_: DataFrame, length: int = 2048) -> DataFrame:
    """sequence_id and pieces (in order) of every sequence; pieces_ as `pieces` gives them."""
    item = F.struct("id", "piece", "start", "length", "crc", F.lit(0).alias("offset")).cast(PIECE)
    items = materialize(pieces_.select(F.col("length").alias("fill"), F.array(item).alias("pieces")))
    whole = items.where(F.col("fill") >= length)
    open_, done = items.where(F.col("fill") < length), [whole]
    tasks, left = None, None
    while True:
        if tasks is not None:
            open_ = open_.repartition(tasks, F.xxhash64("fill", "pieces"))
        bins = materialize(map_arrow(open_, _round(length), BIN))
        under = bins.where(F.col("fill") < FULL * length)
        now = under.count()
        if now == 0 or tasks == 1 or (left is not None and now > 0.99 * left and tasks <= max(1, now // TASK_ITEMS)):
            done.append(bins)
            break
        done.append(bins.where(F.col("fill") >= FULL * length))
        before = tasks or len(bins.inputFiles())
        tasks, left, open_ = max(1, -(-before // FAN_IN), -(-now // TASK_ITEMS)), now, under
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces")


def placed(pieces_: DataFrame, length: int = 2048) -> DataFrame:
    """id, piece, start, length, crc, sequence_id and offset, the place of the piece's first token in its sequence."""
    return packed_sequences(pieces_, length).select("sequence_id", F.explode("pieces").alias("p")).select("p.*", "sequence_id")
