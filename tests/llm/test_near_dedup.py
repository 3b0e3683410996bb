from __future__ import annotations

import random

import numpy as np
import pytest

from indexpanel.llm import near_dedup as nd
from indexpanel.llm import setsketch
from indexpanel.llm.components import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def truth(docs, size, percent):
    """Component of every document number, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label, [len(s) for s in sets]


def check(frame, size=4, percent=80):
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    label, sizes = truth(docs, size, percent)
    least = {}
    for (i, _), c in zip(docs, label, strict=True):
        least.setdefault(c, []).append(i)
    expected = sorted([(i is not None, i or 0, n, min((x for x in least[c] if x is not None), default=None) or 0)
                       for (i, _), c, n in zip(docs, label, sizes, strict=True)])
    rows = nd.grouped(frame, size=size, percent=percent).collect()
    assert sorted([(r.id is not None, r.id or 0, r.n_shingles, r.component_id or 0) for r in rows]) == expected
    assert sum(r.is_first for r in rows) == len(set(label))
    return rows


def test_odd_documents(odd_docs):
    check(odd_docs.repartition(4))


def cloud(n, rng):
    """Copies of one text with different shares of words replaced, so that links lie on both sides of the threshold."""
    base = [f"w{i}" for i in range(150)]
    out = []
    for k in range(n):
        edits = rng.randint(0, 12)
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"e{k}x{rng.random()}"
        out.append(" ".join(words))
    return out


def test_cloud_of_near_copies_and_shared_passages(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = cloud(140, rng) + [passage + " " + " ".join(f"u{k}v{i}" for i in range(rng.randint(10, 90))) for k in range(60)]
    texts += ["copy of a text that many have " * 3] * 30
    rng.shuffle(texts)
    rows = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    assert 3 < len({r.component_id for r in rows}) < 180


def test_empty_table(no_docs):
    assert nd.grouped(no_docs).count() == 0


def test_deduplicated_keeps_one_row_of_each_group_and_all_columns(odd_docs):
    kept = nd.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    label, _ = truth(docs, 5, 80)
    assert kept.count() == len(set(label))


@pytest.mark.parametrize("j", [0.3, 0.6, 0.8, 0.95])
def test_registers_estimate_similarity_and_merge(j):
    rng = np.random.default_rng(int(100 * j))
    total, found = 600, []
    for _ in range(30):
        both = int(total * 2 * j / (1 + j))
        x, y, z = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (both, total - both, total - both))
        a, b = np.concatenate([x, y]), np.concatenate([x, z])
        r = setsketch.registers(np.concatenate([a, b]), np.repeat([0, 1], total), 2)
        union = setsketch.registers(np.unique(np.concatenate([a, b])), np.zeros(2 * total - both, int), 1)
        assert (np.maximum(r[0], r[1]) == union[0]).all()
        found.append(setsketch.likeness(r[:1], r[1:], np.array([total]), np.array([total]))[0])
    assert abs(np.mean(found) - j) < 0.02


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star + ring, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(9)}}
