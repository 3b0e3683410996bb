from __future__ import annotations

import itertools
import re
from collections import Counter

from indexpanel.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def failed(text: str) -> str:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    checks = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
              "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
    return "".join(k for k, bad in checks.items() if bad)


def plain(docs: list[tuple], labels: list[tuple]) -> dict:
    """docs: (id, text, part)."""
    rows = []
    for i, text, part in docs:
        same = [j for j, other, _ in docs if (other or "") == (text or "") and j is not None]
        copy = i is not None and min(same) < i
        mine = [(q, t) for j, q, t in labels if j is not None and j == i]
        rows.append((part or "", failed(text or "") + "E" * copy, any(q == 1 for q, _ in mine), any(t == 1 for _, t in mine)))
    out = {}
    for part in {r[0] for r in rows}:
        total = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                cut = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                out[part, order, step] = (len(left), len(cut), sum(letter in r[1] for r in gone),
                                          sum(r[0] == part and r[1] == letter for r in rows),
                                          sum(r[2] for r in cut), sum(r[3] for r in cut))
                gone += cut
                total[letter] += len(cut)
        for order, step in [(o, s) for p, o, s in out if p == part]:
            out[part, order, step] += (total[order[step - 1]],)
    return out


def found(rows) -> dict:
    got = {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*filter_audit.METRICS, "shapley")) for r in rows.collect()}
    assert rows.count() == len(got)
    return got


def test_odd_documents(spark, odd_docs):
    labels = [(0, 1, 0), (0, None, 1), (1, 1, 1), (4, 0, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (16, 1, 0), (16, 1, 0)]
    got = found(filter_audit.audited(odd_docs, spark.createDataFrame(labels, LABELS)))
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert got == plain(docs, labels)
    assert {k[0] for k in got} == {"", "s0", "s1"} and len(got) == 3 * 600


def test_copies_across_parts_and_null_ids(spark):
    text = "word " * 300
    docs = [(5, text, "a"), (5, text, "b"), (7, text, "a"), (None, text, "a"), (9, text, None), (1, "other", "b"),
            *[(i, text, "hot") for i in range(20, 60)], *[(3, "same", "hot")] * 5, *[(4, "same", "hot")] * 5]
    labels = [(7, 1, 1), (5, 1, 0), (21, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert found(filter_audit.audited(frame, spark.createDataFrame(labels, LABELS))) == plain(docs, labels)


def test_empty_table_and_row_limit(spark, no_docs):
    limit = spark.conf.get(filter_audit.ROW_LIMIT)
    assert filter_audit.audited(no_docs, spark.createDataFrame([], LABELS)).count() == 0
    assert spark.conf.get(filter_audit.ROW_LIMIT) == limit
    spark.conf.set(filter_audit.ROW_LIMIT, "400")
    try:
        docs = spark.createDataFrame([(i, "x", f"p{i}") for i in range(7)], "doc_id long, text string, source string")
        assert filter_audit.audited(docs, spark.createDataFrame([], LABELS)).count() == 7 * 600
        assert spark.conf.get(filter_audit.ROW_LIMIT) == "400"
    finally:
        spark.conf.set(filter_audit.ROW_LIMIT, limit)
