from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from indexpanel.llm import mixing as m

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        source = "s0" if rng.random() < 0.6 else f"s{rng.randint(1, 3)}"
        text = " ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.randint(1, 200)))
        rows.append((i, text, rng.choice(["en", "en", "de"]), source, len(text)))
    return spark.createDataFrame(rows, COLUMNS), rows


def raked(rows, goals):
    """The same fit, cell by cell in plain Python."""
    cells: dict = {}
    for _, text, lang, source, _ in rows:
        size = len(text.encode())
        topic = "note" if size < 400 else "prose"
        key = (f"={source}", f"={lang}", f"={topic}")
        cells[key] = cells.get(key, 0) + len(text.split())
    weight = {k: float(v) for k, v in cells.items()}
    shares = []
    for d, temper in enumerate((0.7, 0.7, 0.9)):
        sums: dict = {}
        for k, v in cells.items():
            sums[k[d]] = sums.get(k[d], 0) + v
        raw = {k: v**temper for k, v in sums.items()}
        if goals.get(d):
            raw = {k: goals[d][k] for k in raw if k in goals[d]}
        shares.append({k: v / sum(raw.values()) for k, v in raw.items()})
    for _ in range(200):
        for d in range(3):
            sums = {}
            for k, v in weight.items():
                sums[k[d]] = sums.get(k[d], 0) + v
            weight = {k: v * shares[d].get(k[d], 0) / sums[k[d]] for k, v in weight.items()}
    return cells, weight


@pytest.mark.parametrize("goals", [{}, {1: {"=en": 0.5, "=de": 0.5}}])
def test_weights_are_those_of_a_plain_fit(spark, goals):
    docs, rows = corpus(spark)
    cells, weight = raked(rows, goals)
    targets = {"lang": spark.createDataFrame([("en", 1.0), ("de", 1.0), ("xx", 5.0)], "value string, share double")} if goals else None
    got = {(r.source, r.lang, r.topic): (r.weight, r.p) for r in
           m.mixed(docs, targets).groupBy(*m.DIMENSIONS).agg(F.first("weight").alias("weight"), F.first("p").alias("p")).collect()}
    total = sum(cells.values())
    for k, tokens in cells.items():
        assert got[k][0] == pytest.approx(weight[k] / tokens * total, rel=1e-4)
    assert sum(got[k][1] * t for k, t in cells.items()) == pytest.approx(0.5 * total, rel=1e-3)


def test_sample_follows_the_probabilities(spark):
    docs, _ = corpus(spark, 3000)
    rows = m.mixed(docs, budget=0.4).collect()
    assert len(rows) == 3000
    expected = sum(r.p * r.tokens for r in rows)
    assert abs(sum(r.tokens for r in rows if r.kept) - expected) < 0.1 * expected
    again = {r.row.doc_id for r in m.mixed(docs.repartition(3), budget=0.4).collect() if r.kept}
    assert again == {r.row.doc_id for r in rows if r.kept}


def test_a_budget_of_everything_keeps_everything_with_tokens(spark):
    docs, _ = corpus(spark, 50)
    assert all(r.kept for r in m.mixed(docs, budget=1.0).collect())


def test_odd_documents_and_empty_table(odd_docs, no_docs):
    rows = m.mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all((r.p > 0) or r.tokens == 0 or not r.kept for r in rows)
    assert all(not r.kept for r in rows if not (r.row.text or "").strip(" \t\n\v\f\r"))
    assert m.mixed(no_docs).count() == 0


def test_values_without_a_target_get_nothing(spark):
    docs, _ = corpus(spark, 200)
    only = {"source": spark.createDataFrame([("s0", 1.0)], "value string, share double")}
    rows = m.mixed(docs, only, budget=0.2).collect()
    assert {r.source for r in rows if r.kept} == {"=s0"} and all(r.weight == 0 for r in rows if r.source != "=s0")


def fitted(spark, cells, langs):
    """Shares of the languages after raking to halves of the sources and the shares given."""
    rows = [(f"={a}", f"={b}", "=t", n) for a, b, n in cells]
    shares = {"source": [("a", 0.5), ("b", 0.5)], "lang": langs}
    targets = {d: spark.createDataFrame(v, "value string, share double") for d, v in shares.items()}
    out = m.raked(spark.createDataFrame(rows, "source string, lang string, topic string, tokens double"), targets)
    return {d: {r[0][1:]: r.s for r in out.groupBy(d).agg(F.sum("weight").alias("s")).collect()} for d in shares}


def test_targets_that_converge_slowly_are_met(spark, caplog):
    got = fitted(spark, [("a", "x", 1000.0), ("b", "x", 1.0), ("b", "y", 1000.0)], [("x", 0.57), ("y", 0.43)])
    assert got["source"]["a"] == pytest.approx(0.5, abs=2e-6) and got["lang"]["x"] == pytest.approx(0.57, abs=2e-6)
    assert not caplog.records


def test_a_gap_that_remains_is_logged(spark, caplog):
    fitted(spark, [("a", "x", 10.0), ("b", "y", 10.0)], [("x", 0.7), ("y", 0.3)])
    assert "off by 0.2" in caplog.text
