from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indexpanel.llm import residual_packing as p


@pytest.fixture(scope="module")
def ids():
    return p.Ids(p.vocabulary())


def whole(ids, text):
    return ids.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from([*"ab c.\n\t's<|>", "\x00", "\u0085", "é", "日", "🎉", "<|endoftext|>", "  ", " don't", "\n\n",
                                      "12 3"]), max_size=40).map("".join) | st.text(max_size=60))
def test_cached_ids_are_the_tokenizer_s(ids, text):
    assert np.frombuffer(ids.texts([text])[0], "<u4").tolist() == whole(ids, text)


def test_cache_turnover_changes_nothing(ids, monkeypatch):
    monkeypatch.setattr(p, "CACHE", 20)
    texts = [" ".join(f"w{(i * k) % 97}" for i in range(30)) + "." for k in range(40)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.texts(texts[:20]) + ids.texts(texts)] == [
        whole(ids, t) for t in texts[:20] + texts]


def check(rows, docs, ids, length):
    by_seq: dict = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    expected = []
    for i, t in docs:
        found = np.array(whole(ids, t) + [0], "<u4")
        first = len(found) % length if len(found) > length and len(found) % length else min(length, len(found))
        at, piece = 0, 0
        while at < len(found):
            size = first if at == 0 else length
            expected.append((i, piece, at, size, zlib.crc32(found[at:at + size].tobytes())))
            at, piece = at + size, piece + 1
    got = [(r.id, r.piece, r.start, r.length, r.crc) for r in rows]
    key = lambda x: tuple((v is not None, v) if v is not None else (False, 0) for v in x)
    assert sorted(got, key=key) == sorted(expected, key=key)
    return len(by_seq), sum(e[3] for e in expected)


def test_odd_documents(odd_docs, ids):
    rows = p.placed(p.pieces(odd_docs, length=256), length=256).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], ids, 256)


def test_empty_table(no_docs):
    assert p.placed(p.pieces(no_docs)).count() == 0


def test_few_sequences_over_many_partitions(spark, ids):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(0, 90, 4000))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(24)
    n, tokens = check(p.placed(p.pieces(frame, length=128), length=128).collect(), docs, ids, 128)
    assert n <= 1.02 * -(-tokens // 128)


def test_best_fit_takes_the_fullest_bin():
    assert p.best_fit(np.array([6, 5, 4, 3, 2]), 10) == [[0, 2], [1, 3, 4]]


def test_ids_of_sequences(spark, ids):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    rows = {r.id: list(r.ids) for r in p.pieces(docs, with_ids=True).collect()}
    assert rows == {1: [*whole(ids, "a b c"), 0], 2: [0]}
