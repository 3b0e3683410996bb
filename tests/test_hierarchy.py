"""Hierarchies of any depth against a loop over the codes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from indexpanel.operators.decompose import closure, code_prefixes, hierarchy, path_prefixes, rollup_closure

CODES = ["SE9", "SE90", "SE904", "SE9041", "SE9042", "SE91", "SE9231", "XX001", "SE", "é1", "é12", None, "SE90"]


@pytest.fixture
def codes(spark):
    return spark.createDataFrame([(c, 1) for c in CODES], "ref string, ancestor int")


def test_prefixes(spark):
    df = spark.createDataFrame([("SE904",), ("S",), (None,)], "c string")
    assert [r[0] for r in df.select(code_prefixes(F.col("c"), 3)).collect()] == [["SE9", "SE90", "SE904"], None, None]
    paths = spark.createDataFrame([("a b c",), ("a",), (None,)], "c string")
    assert [r[0] for r in paths.select(path_prefixes(F.col("c"))).collect()] == [["a", "a b", "a b c"], ["a"], None]


def test_closure_equals_all_pairs(codes):
    got = {tuple(r) for r in closure(codes, "ref", code_prefixes(F.col("ref"))).collect()}
    known = {c for c in CODES if c}
    assert got == {(a, d, len(d) - len(a)) for a in known for d in known if d.startswith(a)}


def test_parents_orphans_and_gaps(codes):
    pairs = closure(codes, "ref", code_prefixes(F.col("ref")))
    got = {r.ref: r for r in hierarchy(pairs, F.char_length("ref") == 2).collect()}
    assert set(got) == {c for c in CODES if c}
    assert (got["SE9231"].parent, got["SE9231"].is_gap, got["SE9231"].is_orphan) == ("SE9", True, False)
    assert (got["XX001"].parent, got["XX001"].is_orphan, got["SE"].is_orphan) == (None, True, False)
    assert (got["SE90"].n_children, got["SE9041"].is_leaf, got["SE904"].n_children) == (1, True, 2)
    assert got["é12"].parent == "é1"


def test_rollup_sums_leaves_once(spark):
    rows = [("SE9", 1, 10), ("SE90", 1, 7), ("SE904", 1, 7), ("SE9041", 1, 3), ("SE9042", 1, 4), ("SE91", 1, 3),
            ("SE9", 2, 5), ("SE91", 2, 4), (None, 1, 99), ("SE904", 3, 1), ("SE9041", 4, 2)]
    fact = spark.createDataFrame(rows, "ref string, p int, v long")
    got = {(r.ref, r.p): (r.v, r.v_rolled_up, r.ok)
           for r in rollup_closure(fact, "ref", closure(fact, "ref", code_prefixes(F.col("ref"), 3)), ["p"], ["v"]).collect()}
    assert got["SE9", 1] == (10, 10, True) and got["SE904", 1] == (7, 7, True) and got["SE91", 1] == (3, None, True)
    assert got["SE9", 2] == (5, 4, False)           # one point is in no leaf
    assert got["SE904", 3] == (1, None, False)      # no leaf has that period
    assert got["SE90", 4] == (None, 2, False)       # leaves without their parent
    assert (None, 1) not in got and got["SE9041", 4] == (2, None, True)


def test_codes_without_facts_and_facts_without_codes(spark):
    members = spark.createDataFrame([("A",), ("AB",), ("AC",)], "ref string")
    fact = spark.createDataFrame([("A", 1, 5), ("AC", 1, 5), ("ZZ", 1, 1)], "ref string, steps int, v long")
    got = {r.ref: (r.v, r.v_rolled_up, r.ok)
           for r in rollup_closure(fact, "ref", closure(members, "ref", code_prefixes(F.col("ref"))), ["steps"], ["v"]).collect()}
    assert got == {"A": (5, 5, True), "AC": (5, None, True), "ZZ": (1, None, True)}


def test_empty(spark):
    none = spark.createDataFrame([], "ref string, p int, v long")
    assert rollup_closure(none, "ref", closure(none, "ref", code_prefixes(F.col("ref"))), ["p"], ["v"]).count() == 0
    assert hierarchy(closure(none, "ref", code_prefixes(F.col("ref")))).count() == 0
