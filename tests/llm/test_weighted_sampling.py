from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from indexpanel.llm import weighted_sampling as w


def words(text):
    return Counter((text or "").encode().lower().split())


def jaccard(a, b):
    p, q = words(a), words(b)
    union = sum(max(p[k], q[k]) for k in set(p) | set(q))
    return sum(min(p[k], q[k]) for k in p) / union if union else 1.0


def expected(rows):
    """(n_chars, digest of the edited text, edited text, next text) by descending id, nulls last, equal ids in any order."""
    out = []
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        third = len(text) // 3
        out.append((key, text, text[:len(text) - third] + following[:third], following))
    return out


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_documents_and_edits(spark, ranges):
    rng = np.random.default_rng(ranges)
    rows = [(int(i) * 7 - 300, " ".join(f"w{rng.zipf(1.4) % 200}é" for _ in range(rng.integers(0, 60)))) for i in rng.permutation(200)]
    rows[5] = (rows[5][0], None)
    got = {r.id: r for r in w.compared(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), ranges=ranges).collect()}
    assert len(got) == 200
    draws = w.Draws(w.K)
    for key, text, edited, following in expected(sorted(rows, reverse=True)):
        r = got[key]
        own, new, nxt = (w.fingerprints([t.encode()], w.K, draws)[0] for t in (text, edited, following))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == own.astype(">u2").tobytes().hex() and r.edited_fingerprint == new.astype(">u2").tobytes().hex()
        assert r.near_edited == (own == new).mean() and r.near_next == (own == nxt).mean()


def test_odd_documents(odd_docs, no_docs):
    rows = w.compared(odd_docs, ranges=4).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    assert Counter((r.id, r.n_chars) for r in rows) == Counter((i, len(t)) for i, t in texts)
    assert w.compared(no_docs).count() == 0
    assert len(w.compared(odd_docs.limit(1)).collect()) == 1
    prints = w.fingerprinted(odd_docs)
    assert prints.columns == [*odd_docs.columns, "fingerprint"]
    by_text: dict = {}
    for r in prints.collect():
        by_text.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(1)
    draws, errors = w.Draws(512), []
    for share in (0.1, 0.4, 0.7, 0.95):
        for seed in range(12):
            a = [f"x{seed}_{i}" for i in range(40) for _ in range(rng.integers(1, 6))]
            b = [x if rng.random() < share else f"y{seed}_{rng.integers(0, 30)}" for x in a] + [f"x{seed}_0"] * int(rng.integers(0, 8))
            texts = [" ".join(x) for x in (a, b)]
            prints = w.fingerprints([t.encode() for t in texts], 512, draws)
            errors.append(w.likeness(*prints) - jaccard(*texts))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.035


def test_blocks_of_words_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(2000)).encode()
    whole = w.fingerprints([text, b"", text[:500]], 32, w.Draws(32))
    monkeypatch.setattr(w, "BLOCK", 50)
    monkeypatch.setattr(w, "REMEMBERED", 7)
    assert (w.fingerprints([text, b"", text[:500]], 32, w.Draws(32)) == whole).all()
