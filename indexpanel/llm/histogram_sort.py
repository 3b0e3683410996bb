"""Sharding by histogram sort: probe the key space, count exact bytes below the probes, refine, exchange once.

The sort key of a row is text hash, id and row number, as 48 hexadecimal digits, so equal texts lie side by side and a
large group of them is cut only where a boundary falls into it. Every round counts the exact bytes under each prefix of
the key that is still of interest: first all prefixes of `digits` digits, then the longer prefixes inside those that
hold a boundary. A boundary is settled when a probe lies within the tolerance of its target or its prefix holds one row.
Partial sums are taken where the rows lie; the driver gets at most 16^digits figures a boundary and round, whatever the
input. Then one exchange brings each row to its shard.

Law `bytes`: sizes (UTF-8 bytes of the text plus 8) of the shards are equal up to the tolerance, or the size of one row.

Defined results: null text has 0 bytes; null ids sort first; repeated rows are told apart by their row number; an empty
table gives an empty result; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexpanel.llm.common import packed, quoted

DIGITS = 3
KEY_DIGITS = 48
OVERHEAD = 8
TOLERANCE = 0.002


def _hex(value: Column) -> Column:
    """A long as 16 hexadecimal digits that sort as the number does."""
    return F.lpad(F.hex(value.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def keyed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """row (the whole row), size, crc (of the text), key."""
    body, number = F.col(quoted(text)), F.col(quoted(id)).cast("long")
    key = F.concat(_hex(F.xxhash64(body)), F.coalesce(_hex(number), F.lit("")), _hex(F.monotonically_increasing_id()))
    return packed(docs, size=(F.coalesce(F.octet_length(body), F.lit(0)) + OVERHEAD).cast("long"),
                  crc=F.crc32(F.coalesce(body, F.lit("")).cast("binary")),
                  key=F.rpad(key, KEY_DIGITS, "0"))


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[str]:
    """shards - 1 ascending key prefixes; a row belongs to the shard of the number of prefixes at or below its key."""
    target = None
    found: dict[int, str] = {}
    wanted: dict[str, list[int]] = {"": list(range(1, shards))}
    below: dict[str, int] = {"": 0}
    depth = 0
    while wanted and depth < KEY_DIGITS:
        inside = rows if depth == 0 else rows.where(F.substring("key", 1, depth).isin(list(wanted)))
        depth += DIGITS
        counted = (inside.groupBy(F.substring("key", 1, depth).alias("prefix"))
                   .agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("prefix").collect())
        if target is None:
            target = sum(c.bytes for c in counted) / shards
        probes: dict[str, list] = {}
        for c in counted:
            probes.setdefault(c.prefix[:depth - DIGITS], []).append(c)
        still: dict[str, list[int]] = {}
        for prefix, boundaries in wanted.items():
            for b in boundaries:
                start = below[prefix]
                for c in probes.get(prefix, []):
                    end = start + c.bytes
                    if end >= b * target:
                        break
                    start = end
                else:
                    found[b] = prefix + "~"
                    continue
                near_start, near_end = abs(b * target - start), abs(end - b * target)
                if min(near_start, near_end) <= tolerance * target or c.n == 1 or depth >= KEY_DIGITS:
                    found[b] = c.prefix if near_start <= near_end else c.prefix + "~"
                else:
                    still.setdefault(c.prefix, []).append(b)
                    below[c.prefix] = start
        wanted = still
    return [found[b] for b in sorted(found)]


def sharded(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text",
            tolerance: float = TOLERANCE) -> DataFrame:
    """row, size, crc, shard (0 to shards - 1) and slot, the place in the shard in key order, without gaps from 0."""
    rows = keyed(docs, id, text)
    cuts = splitters(rows.select("key", "size"), shards, tolerance) if shards > 1 else []
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("key")) - 1
    return rows.withColumn("shard", shard).select("row", "size", "crc", "shard", place.cast("long").alias("slot"))
