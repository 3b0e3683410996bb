"""Secret scans with corpus-wide ownership frequency.

Every whole text is scanned for candidates: assignments to secret-like names, access key ids, long hexadecimal runs, and
bare tokens of mixed characters. The hashes of the candidate values are counted over the whole corpus by distinct
repositories and distinct owners. A value that many owners have is a copied example; one that few have is a credential of
theirs that looks live. Base kinds are always spans; bare tokens become spans only where their value looks live. Redaction
replaces live-looking values and leaves copied examples.

The count of a value goes over (value, owner, repository) first, so that copies are summed where they lie and a value with
a third of all rows costs a row per owner and repository.

The columns that name owners and repositories are the caller's. By default the source is the owner, and no column is taken for
a repository: values are then judged by their owners alone.

Defined results: null text counts as empty; null owners or repositories are no owner and no repository, and a value without
any counts as owned by one; repeated rows have the same owner; empty tables give empty results; any columns may stand beside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexpanel.llm.common import map_arrow, materialize, packed, quoted

KINDS = ("assign", "access", "hex", "bare")
MAX_OWNERS = 3  # a value with more owners, or with more repositories than MAX_REPOSITORIES, is a copied example
MAX_REPOSITORIES = 5
MARK = "<SECRET>"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BARE = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
# True of every text with a candidate, and of few others; the scan leaves all other texts in the JVM.
MAYBE = r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{24}|[a-z0-9+/_-]{24}"
FOUND = T.StructType([T.StructField("found", T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("from", T.IntegerType()), T.StructField("hash", T.StringType())])))])


def candidates(text: str) -> list[tuple[int, int, int, int, str]]:
    """(kind, start, end, start of the value, hash of the value) in code points, leftmost and non-overlapping per kind."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found.append((0, m.start(), m.end(), m.start(2), m[2]))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= 20:
            found.append((1, m.start(), m.end(), m.start(), m[0]))
    found += [(2, m.start(), m.end(), m.start(), m[0]) for m in HEX.finditer(text)]
    if any(len(w) >= 24 for w in text.split()):
        for m in BARE.finditer(text):
            if _mixed(m[0]) and not any(a <= m.start() and m.end() <= z for _, a, z, _, _ in found):
                found.append((3, m.start(), m.end(), m.start(), m[0]))
    found.sort(key=lambda x: (x[1], x[0]))
    return [(*x[:4], hashlib.sha256(x[4].encode("utf-8", "surrogatepass")).hexdigest()) for x in found]


def _mixed(token: str) -> bool:
    """Digits, upper and lower case, and at least 12 different characters: not a word."""
    return (len(set(token)) >= 12 and any(c.isdigit() for c in token) and any(c.isupper() for c in token)
            and any(c.islower() for c in token))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("from", pa.int32()),
                               ("hash", pa.string())]))
    names = ("kind", "start", "end", "from", "hash")
    for batch in batches:
        found = [[dict(zip(names, c, strict=True)) for c in candidates(t or "")] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "found"])


def scanned(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows that hold no candidate for sure, and all others with `found`; each row is packed as `row`, with its text.

    The first are never sent to Python; the second are written to the shared folder with a row number.
    """
    rows = packed(docs, text=F.col(quoted(text)))
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    searched = map_arrow(rows.where(maybe), _scan, T.StructType([*rows.schema.fields, *FOUND.fields]))
    return rows.where(~maybe), materialize(searched.select(F.monotonically_increasing_id().alias("number"), "*"))


def ownership(values: DataFrame) -> DataFrame:
    """hash, owner, repository of every find: hash, owners, repositories and whether the value is a copied example."""
    spread = values.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    counted = spread.groupBy("hash").agg(F.count_distinct("owner").alias("owners"),
                                         F.count_distinct("repository").alias("repositories"), F.sum("n").alias("finds"))
    return counted.withColumn("copied", (F.col("owners") > MAX_OWNERS) | (F.col("repositories") > MAX_REPOSITORIES))


def judged(hits: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """number, spans: the finds of each row in order, with `copied`; bare tokens only where they look live.

    owner and repository are expressions over the packed `row`.
    """
    finds = materialize(hits.where(F.size("found") > 0).select(
        "number", owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
        F.explode("found").alias("f")).select("number", "owner", "repository", "f.*"))
    verdicts = ownership(finds.select("hash", "owner", "repository"))
    marked = finds.join(verdicts, "hash").where((F.col("kind") != KINDS.index("bare")) | ~F.col("copied"))
    span = F.struct("start", "kind", "end", "from", "copied", "owners", "repositories", "hash")
    return marked.groupBy("number").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kind_name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def repository_of(columns: Sequence[str]) -> Column:
    """One string over the columns of `row` that name a repository; null if all of them are or there are none."""
    parts = [F.col("row")[c] for c in columns]
    if not parts:
        return F.lit(None).cast("string")
    named = F.to_json(F.struct(*[p.alias(f"r{i}") for i, p in enumerate(parts)]))
    return F.when(F.coalesce(*[p.cast("string") for p in parts]).isNotNull(), named)


def spans(docs: DataFrame, owner: str = "source", repository: Sequence[str] = (), text: str = "text") -> DataFrame:
    """row and its spans (empty where it has none)."""
    clean, hits = scanned(docs, text)
    found = judged(hits, F.col("row")[owner], repository_of(repository))
    joined = hits.select("number", "row").join(found, "number", "left")
    empty = F.array().cast(found.schema["spans"].dataType)
    return joined.select("row", F.coalesce("spans", empty).alias("spans")).unionAll(clean.select("row", empty.alias("spans")))


def redacted(docs: DataFrame, owner: str = "source", repository: Sequence[str] = (), text: str = "text",
             length: str = "n_chars") -> DataFrame:
    """docs with each live-looking value replaced by MARK in the text, and the length column set anew where it changes."""
    rows = spans(docs, owner, repository, text)
    live = F.filter("spans", lambda s: ~s["copied"])
    merged = F.aggregate(  # overlapping values are one gap
        F.sort_array(F.transform(live, lambda s: F.struct(s["from"].alias("a"), s["end"].alias("z")))),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["a"] < acc["at"], F.struct(F.greatest(acc["at"], s["z"]).alias("at"), acc["out"].alias("out")))
        .otherwise(F.struct(s["z"].alias("at"), F.concat(
            acc["out"], F.substring(F.col("row")[text], acc["at"] + 1, s["a"] - acc["at"]), F.lit(MARK)).alias("out"))))
    rows = rows.select("row", F.when(F.size(live) > 0, merged).alias("m"))
    changed = F.concat(F.col("m.out"), F.expr(f"substring(row.{quoted(text)}, m.at + 1)"))
    rows = rows.select("row", changed.alias("changed"))
    out = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = F.coalesce("changed", value)
        elif c == length:
            value = F.when(F.col("changed").isNotNull(), F.char_length("changed").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)
