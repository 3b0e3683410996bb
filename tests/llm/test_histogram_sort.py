from __future__ import annotations

import zlib

from indexpanel.llm import histogram_sort as h


def check(rows, shards, n):
    assert len(rows) == n
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    for r in rows:
        body = (r.row.text or "").encode()
        assert r.size == len(body) + 8 and r.crc == zlib.crc32(body)


def test_odd_documents(odd_docs):
    rows = h.sharded(odd_docs, 5).collect()
    check(rows, 5, odd_docs.count())


def test_empty_table_and_one_shard(no_docs, odd_docs):
    assert h.sharded(no_docs, 24).count() == 0
    assert {r.shard for r in h.sharded(odd_docs, 1).collect()} == {0}


def test_bytes_are_near_equal_with_a_third_in_one_text(spark):
    """A hot text is cut at a boundary; identical rows, ids included, are cut as well."""
    rows = [(i, f"text {i} " * (1 + i % 40)) for i in range(1500)]
    rows += [(10_000 + i, "copy " * 30) for i in range(400)] + [(7, "twin " * 30)] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = h.sharded(docs, 24).collect()
    check(got, 24, len(rows))
    sums = [sum(r.size for r in got if r.shard == s) for s in range(24)]
    mean = sum(sums) / 24
    assert max(abs(s - mean) for s in sums) <= 0.004 * mean + max(r.size for r in got)


def test_equal_texts_lie_side_by_side(spark):
    docs = spark.createDataFrame([(i, f"t{i % 50}") for i in range(500)], "doc_id long, text string")
    got = sorted(h.sharded(docs, 4).collect(), key=lambda r: (r.shard, r.slot))
    runs = [r.row.text for r in got]
    assert sum(a != b for a, b in zip(runs, runs[1:], strict=False)) == 49


def test_no_python_and_one_exchange_of_the_rows(odd_docs):
    plan = h.sharded(odd_docs, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan
