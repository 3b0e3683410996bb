"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted into cells (source, language, topic) with their tokens. Raking multiplies the token weights of cells
by the ratio of target to fitted marginal, one dimension after the other, until every marginal is within TOLERANCE of its
target, or, where no weights meet all targets, until the largest gap stops falling; a gap that remains is logged. Targets are tables (value, share); without one, a dimension's target is the tempered marginal: shares to the power
of `temper`, which lifts small sources, languages and topics. Cells that the targets give weight are sampled at
p = min(1, scale * fitted weight / tokens); the scale is calibrated so that the expected tokens meet the budget. A
document stays when the hash of its id and text, as a number in [0, 1), is below p, so the sample is the same in every run.

Cells are aggregated where rows lie before they meet. All work on cells is joins and sums of the cell table, which has
one row per source, language and topic; the driver gets one figure per round.

Defined results: null source or language is a value of its own; null or empty text has no tokens, topic `empty` and p of
its cell, which is 0 without tokens; repeated rows share one fate; targets of absent values are spread over the present
ones in proportion; values without a target get weight 0; an empty table gives an empty result; input columns keep their names.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexpanel.llm.common import discard, materialize, n_words, packed, quoted, without

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
BUDGET = 0.5  # tokens wanted, as a share of all tokens
TOLERANCE = 1e-6
PATIENCE = 5  # rounds without a smaller gap after which it counts as no longer falling
CALIBRATIONS = 30
SEED = 17
LOG = logging.getLogger(__name__)


def topic_of(text: Column) -> Column:
    """A topic from the form of the whole text; used where the documents name none."""
    whole = F.coalesce(text, F.lit(""))
    size = F.octet_length(whole)
    signs = size - F.octet_length(without(whole, "#*$%&<>=@"))
    bars, lines = size - F.octet_length(without(whole, "|")), size - F.octet_length(without(whole, "\n"))
    return (F.when(size == 0, "empty").when(40 * bars > size, "table").when(40 * signs > size, "markup")
            .when(size < 400, "note").when(300 * lines > size, "list").otherwise("prose"))


def celled(docs: DataFrame, text: str = "text", topic: str | None = None) -> DataFrame:
    """row, the three dimensions (null made a value of its own) and tokens (words)."""
    def value(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))

    body = F.col(quoted(text))
    return packed(docs, source=value(F.col("source")), lang=value(F.col("lang")),
                  topic=value(F.col(quoted(topic)) if topic else topic_of(body)), tokens=n_words(body))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").cast("double").alias("tokens"))


def _targets(cells: DataFrame, dimension: str, given: DataFrame | None) -> DataFrame:
    """value, share of the values that have tokens; shares add up to 1."""
    have = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    if given is None:
        raw = have.select("value", F.pow("tokens", F.lit(TEMPER[dimension])).alias("raw"))
    else:
        named = given.select(F.coalesce(F.concat(F.lit("="), F.col("value").cast("string")), F.lit("null")).alias("value"),
                             F.col("share").cast("double").alias("raw"))
        raw = have.join(named, "value").select("value", "raw")
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select("value", (F.col("raw") / F.lit(total)).alias("share"))


def raked(cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """cells with `weight`, the share of the mixture's tokens that the cell should have."""
    given = targets or {}
    goals = {d: materialize(_targets(cells, d, given.get(d))) for d in DIMENSIONS}
    now = materialize(cells.where("tokens > 0").withColumn("weight", F.col("tokens")))
    least, since = float("inf"), 0
    while True:
        fitted = now
        for d in DIMENSIONS:
            sums = fitted.groupBy(F.col(d).alias("value")).agg(F.sum("weight").alias("s"))
            factor = sums.join(goals[d], "value").select("value", (F.col("share") / F.col("s")).alias("factor"))
            fitted = (fitted.join(factor, F.col(d) == F.col("value"), "left")
                      .withColumn("weight", F.col("weight") * F.coalesce("factor", F.lit(0.0)))
                      .select(*DIMENSIONS, "tokens", "weight"))
        after = materialize(fitted)
        # The last dimension fits exactly; the others are off by what the later ones moved.
        gaps = [after.groupBy(F.col(d).alias("value")).agg(F.sum("weight").alias("s")).join(goals[d], "value")
                .select(F.abs(F.col("s") - F.col("share")).alias("gap")) for d in DIMENSIONS[:-1]]
        worst = gaps[0]
        for g in gaps[1:]:
            worst = worst.unionAll(g)
        off = worst.agg(F.max("gap")).first()[0] or 0.0
        discard(now)
        now = after
        if off <= TOLERANCE:
            return now
        least, since = (off, 0) if off < least * (1 - TOLERANCE) else (least, since + 1)
        if since == PATIENCE:
            LOG.warning("no weights found that meet all targets: a share is off by %.3g", off)
            return now


def calibrated(weights: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The cells with p, such that the expected tokens are the share `budget` of all tokens, as far as the weighted cells reach."""
    ratio = F.col("weight") / F.col("tokens")
    wanted = budget * (weights.agg(F.sum("tokens")).first()[0] or 0.0)
    reach = weights.where("weight > 0").agg(F.sum("tokens"), F.min(ratio), F.max(ratio)).first()
    if not reach[0]:
        return weights.withColumn("p", F.lit(0.0))
    low, high = 0.0, 1.0 / reach[1]
    if wanted >= reach[0]:
        low = high
    else:  # expected tokens grow with the scale: halve its logarithmic range, several probes a pass
        low = min(1.0 / reach[2], high)
        for _ in range(CALIBRATIONS // 5):
            steps = [low * (high / low) ** (i / 32) for i in range(33)]
            expected = weights.agg(*[F.sum(F.least(F.lit(1.0), F.lit(s) * ratio) * F.col("tokens")) for s in steps]).first()
            if expected[0] >= wanted:  # nothing is capped below the first probe: the sum is in proportion
                low = high = steps[0] * wanted / expected[0]
                break
            k = max(i for i in range(33) if expected[i] < wanted)
            low, high = steps[k], steps[min(k + 1, 32)]
    return weights.withColumn("p", F.least(F.lit(1.0), F.lit((low * high) ** 0.5) * ratio))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, id: str = "doc_id",
          text: str = "text", topic: str | None = None, seed: int = SEED) -> DataFrame:
    """row, source, lang, topic, tokens, weight (per token, 1 on average), p and kept of every document."""
    rows = celled(docs, text, topic)
    cells = materialize(cells_of(rows))
    weights = materialize(calibrated(raked(cells, targets), budget))
    total = weights.agg(F.sum("tokens")).first()[0] or 0.0
    factors = weights.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS],
                             (F.col("weight") / F.col("tokens") * F.lit(total)).alias("weight"), "p")
    same = [F.col(d) == F.col(f"_{d}") for d in DIMENSIONS]
    joined = rows.join(factors, same[0] & same[1] & same[2], "left")
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("row")[id], F.col("row")[text]), F.lit(1 << 52)) / F.lit(float(1 << 52))
    p = F.coalesce("p", F.lit(0.0))
    return joined.select("row", *DIMENSIONS, "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), p.alias("p"),
                         (place < p).alias("kept"))
