from __future__ import annotations

import os

import corpus_pipeline as c
import pytest

from indexpanel.llm import mixing, quality_rules, residual_packing, secret_ownership
from indexpanel.llm.common import materialize
from tests.llm.test_near_dedup import truth

SF = "/root/testdata/sf0.001"


def test_every_stage_keeps_columns_and_takes_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        now = docs
        for name, stage in c.STAGES[:-1]:
            now = materialize(stage(spark, now, SF))
            assert now.columns == docs.columns, name
            assert now.count() <= docs.count()
        assert c.STAGES[-1][1](spark, now, SF).count() >= now.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.row.doc_id for r in quality_rules.judged(docs).collect() if r.kept}
    one = materialize(c.quality(spark, docs, SF))
    assert {r.doc_id for r in one.collect()} == kept
    ids = sorted(kept)
    label, _ = truth([(i, rows[i].text) for i in ids], 5, 80)
    first = {}
    for i, g in zip(ids, label, strict=True):
        first.setdefault(g, i)
    two = materialize(c.dedup(spark, one, SF))
    assert {r.doc_id for r in two.collect()} == set(first.values())
    three = materialize(c.secrets(spark, two, SF))
    for r in three.collect():
        text, at = "", 0
        for _, a, z, start, _ in secret_ownership.candidates(rows[r.doc_id].text):
            if z > at:
                text += rows[r.doc_id].text[at:max(at, start)] + ("<SECRET>" if start >= at else "")
                at = z
        assert r.text == text + rows[r.doc_id].text[at:] and r.n_chars == len(r.text)
    four = materialize(c.mixture(spark, three, SF))
    assert {r.doc_id for r in four.collect()} == {r.row.doc_id for r in mixing.mixed(three).collect() if r.kept}
    packed = c.packing(spark, four, SF).collect()
    ids = residual_packing.Ids(residual_packing.vocabulary())
    assert sum(r.length for r in packed) == sum(len(ids.texts([r.text])[0]) // 4 + 1 for r in four.collect())
    assert {r.doc_id for r in packed} == {r.doc_id for r in four.collect()}
