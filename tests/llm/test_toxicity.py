from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from indexpanel.llm import toxicity as t
from tests.llm.conftest import prose

BAD = ["zqxvile", "wkyfoul"]
LABELS = "doc_id long, quality int, toxic int"


def grams(text: str) -> set[str]:
    words = text.lower().split()
    whole = f" {' '.join(words)} " if words else ""
    return {whole[i:i + n] for n in t.SIZES for i in range(len(whole) - n + 1)}


def bucket(gram: str) -> int:
    h = ord(gram[0]) + 1
    for c in gram[1:]:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
    return ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - t.BITS)


def corpus(n: int) -> list[tuple]:
    """(doc_id, text, toxic): every third is toxic by one or more bad words inside other prose."""
    out = []
    for i in range(n):
        words = prose(i, 20 + i % 150).split()
        if i % 3 == 0:
            for k in range(1 + i % 2):
                words.insert(random.Random(i + k).randrange(len(words)), BAD[(i // 3 + k) % 2].upper() if i % 5 == 0 else BAD[(i // 3 + k) % 2])
        out.append((i, " \n".join(words), int(i % 3 == 0)))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 7, 40])
def test_buckets_are_those_of_all_n_grams(monkeypatch, piece):
    monkeypatch.setattr(t, "PIECE", piece)
    texts = ["One  two\tTHREE", "", None, " \n ", "ß İ 日本語 🎉x", prose(1, 200), "a"]
    found = [set() for _ in texts]
    for owner, buckets in t.buckets_of([x if x is None else x.encode() for x in texts]):
        for o, b in zip(owner.tolist(), buckets.tolist(), strict=True):
            found[o].add(b)
    assert found == [{bucket(g) for g in grams(x or "")} for x in texts]


def test_logistic_finds_the_least_loss():
    rng = np.random.default_rng(3)
    x = (rng.random((60, 4)) < 0.4) * rng.normal(size=4)
    label, weight = (rng.random(60) < 0.4).astype(float), rng.random(60) + 0.1
    row, column = np.nonzero(x)

    def loss(w, b):
        z = x @ w + b
        return (weight * (np.logaddexp(0, z) - label * z)).sum() / weight.sum() + 0.005 * (w @ w)

    w, b = t.logistic(row, column, x[row, column], label, weight, 4, penalty=0.01, rounds=3000)
    best = loss(w, b)
    for k in range(5):
        for d in (-1e-3, 1e-3):
            moved = np.append(w, b)
            moved[k] += d
            assert loss(moved[:4], moved[4]) > best
    assert loss(*t.logistic(row, column, x[row, column], label, weight, 4, penalty=0.01)) < best + 1e-4


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 != 1], LABELS)
    return rows, docs, labels, t.fit(docs, labels)


def test_model_and_scores_against_plain_counts(spark, fitted):
    rows, docs, _, model = fitted
    train = [(x, y) for i, x, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    counts = [dict.fromkeys(range(1 << t.BITS), 0) for _ in range(2)]
    for x, y in train:
        for b in {bucket(g) for g in grams(x)}:
            counts[y][b] += 1
    sums = [sum(c.values()) + (1 << t.BITS) for c in counts]
    ratio = {b: math.log((counts[1][b] + 1) / sums[1]) - math.log((counts[0][b] + 1) / sums[0]) for b in counts[0]}
    far = {b: abs(r) / math.sqrt(1 / (counts[0][b] + 1) + 1 / (counts[1][b] + 1)) for b, r in ratio.items() if counts[0][b] + counts[1][b]}
    kept = [b for b in far if far[b] >= t.ERRORS]
    assert len(kept) <= t.FEATURES and sorted(kept) == sorted(model.buckets.tolist())
    assert all(math.isclose(ratio[b], r) for b, r in zip(model.buckets.tolist(), model.ratios, strict=True))
    weight = dict(zip(model.buckets.tolist(), model.weights * model.ratios, strict=True))
    got = {r.row.doc_id: r.score for r in t.scored(docs, model).collect()}
    for i, x, _ in rows:
        z = model.intercept + sum(weight.get(b, 0) for b in {bucket(g) for g in grams(x)})
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), abs_tol=1e-9)


def test_held_out_accuracy(fitted):
    rows, docs, _, model = fitted
    got = {r.row.doc_id: r.score for r in t.scored(docs, model).collect()}
    held = [(got[i] >= 0.7, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(p == bool(y) for p, y in held) >= 0.98 * len(held)


def test_scores_do_not_depend_on_order_or_other_columns(spark, fitted):
    _, docs, labels, model = fitted
    again = t.fit(docs.repartition(3).withColumn("toxic", F.lit("x")).withColumn("bucket", F.lit(1)), labels.repartition(2).unionAll(labels))
    assert again.buckets.tolist() == model.buckets.tolist() and again.weights.tolist() == model.weights.tolist()


def test_bounded_sample_has_the_true_shares(spark, fitted):
    rows, docs, labels, model = fitted
    small = t.fit(docs, labels, per_class=60)
    got = [r.score for r in t.scored(docs, small).collect()]
    assert abs(np.mean(got) - np.mean([y for _, _, y in rows])) < 0.1 and small.buckets.tolist() != model.buckets.tolist()


def test_odd_documents_and_odd_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(19)] + [(0, 1, 1), (None, 1, 1), (3, 1, 7), (4, 1, None)], LABELS)
    rows = t.scored(odd_docs, t.fit(odd_docs, labels))
    assert rows.count() == odd_docs.count() and set(rows.schema["row"].dataType.names) == set(odd_docs.columns) - {"text"}
    assert rows.where("score IS NULL OR NOT score BETWEEN 0 AND 1").count() == 0
    empty = {r.score for r in rows.where("row.doc_id IN (4, 5, 6)").collect()}
    assert len(empty) == 1
    assert t.scored(no_docs, t.fit(no_docs, labels)).count() == 0
    none = t.fit(odd_docs, labels.where("false"))
    assert {r.score for r in t.scored(odd_docs, none).collect()} == {0.5}
    clean = t.fit(odd_docs, labels.where("toxic = 0 AND doc_id <> 0"))
    assert {r.score < 0.1 for r in t.scored(odd_docs, clean).collect()} == {True}
