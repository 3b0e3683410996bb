"""Quality rules whose thresholds come from mergeable quantile sketches per language and source. DataFrame functions only.

Four ratios of every text are judged: ASCII punctuation marks per 1,000 characters of words, characters per 100 words, repeated
lines per 1,000 lines, and words in repeated windows per 1,000 words. For each (lang, source) a sketch of every ratio is a table
of counts per bucket: integers below 64 are their own bucket, larger ones keep their five leading bits, so a quantile is exact or
at most 1/32 too low. Counts add, so a group's sketch is merged from any partition of its rows (partial aggregation does), the
sketch of a language from those of its sources, the sketch of all from those of the languages. Sketched are the documents that
pass the base rule. A group of fewer than `support` of them takes the thresholds of its language, or else of all documents.

Marks and word length are spread around a median: their fences lie `reach` spreads from the group's median, the spread being the
distance to the quartile on the far side of the fence. These hold while less than a quarter of a group is junk, however large the
group is. Repeats are absent from most texts, so there the fence lies as far beyond the 99 % quantile as that lies beyond the
95 % one; what the base rule rejects takes no part in it. A spread is `least` at least.

Defined results: null text counts as empty; an empty text has no words and fails the base rule; null lang or source is a
group of its own; an empty table gives an empty result; repeated rows count as often as they occur; columns of the input
keep their names, whatever they are; very long texts are counted whole, within their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexpanel.llm.common import SPACE_RUN, SPACES, materialize, n_words, quoted, scratch, without

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SUPPORT = 50
MARKS = r"[!-/:-@\[-`{-~]+"
# ratio: spreads up to the fence, least spread, whether low values are judged too
AROUND = {"marks": (8, 2, False), "word_length": (10, 5, True)}
# ratio: least distance of the fence from the 99 % quantile
BEYOND = {"repeated_lines": 16, "repeated_words": 16}
RATIOS = (*AROUND, *BEYOND)


def line_counts(text: Column) -> tuple[Column, Column]:
    """Lines with a word, and those among them that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return F.size(lines).cast("long"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def cheap_counts(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    n_lines, n_dup_lines = line_counts(text)
    return {
        "n_words": n_words(text),
        "word_chars": F.char_length(without(whole, SPACES)).cast("long"),
        "n_symbols": (F.octet_length(whole) - F.octet_length(without(whole, SYMBOLS))).cast("long"),
        "n_marks": (F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, MARKS, ""))).cast("long"),
        "n_lines": n_lines,
        "n_dup_lines": n_dup_lines,
    }


def with_repeat_words(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the number of words in windows of 8 words that the text has twice or more.

    Windows are compared by a 64-bit hash of the hashes of their words, built in three doublings. All work stays in the
    row: no shuffle, n log n for a text of n words, and only texts with a repeated window sort their windows.
    """
    def tail(values: str, skip: int) -> Column:
        return F.slice(F.col(values), F.lit(1 + skip), F.greatest(F.size(values) - skip, F.lit(0)))

    def head(values: str, skip: int) -> Column:
        return F.slice(F.col(values), F.lit(1), F.greatest(F.size(values) - skip, F.lit(0)))

    kept = [F.col(quoted(c)) for c in df.columns]
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), SPACE_RUN)
    df = df.select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias("_h1"))
    for half in (1, 2, 4):
        pair = F.zip_with(head(f"_h{half}", half), tail(f"_h{half}", half), lambda a, b: F.xxhash64(a, b))
        df = df.select(*kept, pair.alias(f"_h{2 * half}"))
    repeated = F.size(F.array_distinct("_h8")) < F.size("_h8")
    ordered = F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*kept, F.when(repeated, ordered).alias("_windows"))
    twins = F.zip_with(head("_windows", 1), tail("_windows", 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.select(*kept, F.sort_array(F.array_distinct(F.flatten(twins))).alias("_starts"))
    steps = F.zip_with(head("_starts", 1), tail("_starts", 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)
    return df.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias(name))


def ratios(counts: dict[str, Column]) -> dict[str, Column]:
    """The judged ratios, whole numbers rounded down; null without words."""
    def per(part: str, scale: int, whole: str) -> Column:
        scaled = counts[part] * F.lit(scale)
        return F.when(counts[whole] > 0, (scaled - scaled % counts[whole]) / counts[whole]).cast("long")

    return {"marks": per("n_marks", 1000, "word_chars"), "word_length": per("word_chars", 100, "n_words"),
            "repeated_lines": per("n_dup_lines", 1000, "n_lines"), "repeated_words": per("n_repeat_words", 1000, "n_words")}


def bucket(value: Column) -> Column:
    """Integers below 64 as they are, larger ones cut to their five leading bits."""
    step = F.pow(F.lit(2.0), (F.length(F.bin(value)) - 6).cast("double")).cast("long")
    return F.when(value < 64, value).otherwise(value - value % step)


def measured(docs: DataFrame, row: Column, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """row, lang, source, the counts, base_failed and the ratios of every document."""
    body = F.col(quoted(text))
    rows = docs.select(row.alias("row"), F.col(quoted(lang)).alias("lang"), F.col(quoted(source)).alias("source"),
                       body.alias("text"), *[c.alias(k) for k, c in cheap_counts(body).items()])
    rows = with_repeat_words(rows, F.col("text"), "n_repeat_words").drop("text")
    counts = {k: F.col(k) for k in rows.columns[3:]}
    few = counts["n_words"] < MIN_WORDS
    repeats = 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    return rows.select("*", (few | repeats).alias("base_failed"), *[c.alias(k) for k, c in ratios(counts).items()])


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, ratio, bucket, n over all measured documents that pass the base rule."""
    # A filter on base_failed would be pushed below the counts and take their expressions along, many times over.
    pairs = F.array(*[F.struct(F.lit(k).alias("ratio"), F.when(~F.col("base_failed"), bucket(F.col(k))).alias("bucket")) for k in RATIOS])
    return (rows.select("lang", "source", F.explode(pairs).alias("p"))
            .where("p.bucket IS NOT NULL")
            .groupBy("lang", "source", F.col("p.ratio").alias("ratio"), F.col("p.bucket").alias("bucket"))
            .agg(F.count("*").alias("n")))


def group_key(*parts: Column) -> Column:
    """One string for a group; nulls and empty strings stay apart."""
    return F.to_json(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]))


def fences(sketch: DataFrame, support: int = SUPPORT) -> DataFrame:
    """lang, source and, for every ratio, the lowest and highest accepted value."""
    own, language, everything = (group_key(F.lit(3), F.col("lang"), F.col("source")), group_key(F.lit(2), F.col("lang")),
                                 group_key(F.lit(1)))
    levels = (sketch.select(F.explode(F.array(own, language, everything)).alias("key"), "ratio", "bucket", "n")
              .groupBy("key", "ratio", "bucket").agg(F.sum("n").alias("n")))
    group = Window.partitionBy("key", "ratio")
    ranked = levels.select(
        "key", "ratio", "bucket", F.sum("n").over(group).alias("total"),
        F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))

    def quantile(percent: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("bucket"))).alias(f"q{percent}")

    stats = ranked.groupBy("key", "ratio").agg(F.max("total").alias("total"), *[quantile(p) for p in (25, 50, 75, 95, 99)])
    low, high = F.lit(None).cast("long"), F.lit(None).cast("long")
    for name, (reach, least, both) in AROUND.items():
        mine = F.col("ratio") == name
        high = F.when(mine, F.col("q50") + reach * F.greatest(F.col("q50") - F.col("q25"), F.lit(least))).otherwise(high)
        if both:
            low = F.when(mine, F.col("q50") - reach * F.greatest(F.col("q75") - F.col("q50"), F.lit(least))).otherwise(low)
    for name, least in BEYOND.items():
        high = F.when(F.col("ratio") == name, F.col("q99") + F.greatest(F.col("q99") - F.col("q95"), F.lit(least))).otherwise(high)
    stats = stats.select("key", "ratio", "total", low.alias("low"), high.alias("high"))
    wanted = (sketch.select("lang", "source").distinct()
              .select("lang", "source", F.explode(F.array(*[
                  F.struct(F.lit(rank).alias("rank"), k.alias("key")) for rank, k in enumerate((own, language, everything))]))
                  .alias("w"))
              .select("lang", "source", "w.rank", "w.key"))
    fit = (F.col("total") >= support) | (F.col("rank") == 2)
    chosen = (wanted.join(stats, "key").where(fit).groupBy("lang", "source", "ratio")
              .agg(F.min_by(F.struct("low", "high"), "rank").alias("fence")))
    return chosen.groupBy("lang", "source").agg(*[
        F.first(F.when(F.col("ratio") == name, F.col("fence")), ignorenulls=True).alias(f"fence_{name}") for name in RATIOS])


def judged(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
           support: int = SUPPORT) -> DataFrame:
    """Every row as the struct `row`, with the base counts, base_failed, the ratios, and kept."""
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    with scratch() as keep:
        # Written first: in the sketch every ratio is used many times, and Spark would count its text as often.
        counted = materialize(measured(docs, F.lit(0), lang, source, text))
        thresholds = keep(fences(materialize(sketches(counted)), support))
    return _verdicts(measured(docs, row, lang, source, text), thresholds)


def verdicts(docs: DataFrame, carry: list[str], lang: str = "lang", source: str = "source", text: str = "text",
             support: int = SUPPORT) -> DataFrame:
    """As judged, with only the columns `carry` in the struct `row`: their measures are written, so texts are read once."""
    with scratch() as keep:
        rows = materialize(measured(docs, F.struct(*[F.col(quoted(c)) for c in carry]), lang, source, text))
        return keep(_verdicts(rows, materialize(fences(materialize(sketches(rows)), support))))


def _verdicts(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    keys = thresholds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(keys, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    # One sum instead of a conjunction: a filter on `kept` then stays above the join. Pushed below it, a term would take
    # the expressions of all columns that lead to it along, each as often as it is used.
    faults = F.col("base_failed").cast("int")
    for name in RATIOS:
        fence = F.col(f"fence_{name}")
        for bad in (F.col(name) < fence["low"], F.col(name) > fence["high"]):
            faults = faults + F.coalesce(bad.cast("int"), F.lit(0))
    return joined.select("row", "n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words",
                         "base_failed", *RATIOS, (faults == 0).alias("kept"))
