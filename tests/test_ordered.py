from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from indexpanel.operators import ordered

SCHEMA = "g string, i int, v double, tag string"


def rows(seed, n=400):
    """One group holds most rows; one key is NULL; a few groups are tiny."""
    rnd = random.Random(seed)
    out, at = [], {}
    for _ in range(n):
        g = rnd.choice(["hot"] * 8 + ["a", "b", None])
        at[g] = at.get(g, 0) + rnd.randint(1, 5)
        v = rnd.choice([None, None, None, round(rnd.random(), 3)])
        out.append((g, at[g], v, rnd.choice(["x", "m", "stop", "y", "y", "y", "y"])))
    rnd.shuffle(out)
    return out


def naive_fill(data):
    last, out = {}, []
    for g, i, v, tag in sorted(data, key=lambda r: (str(r[0]), r[1])):
        last[g] = v if v is not None else last.get(g)
        out.append((g, i, last[g], tag))
    return sorted(out, key=str)


def collected(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


PATHS = [{}, {"chunk": 10}, {"chunk": 1}, {"chunk": 10**9}, {"chunk": 7}]


def skew(path):
    path = dict(path)
    if "chunk" in path:
        path["chunk"] = F.floor(F.col("i") / path["chunk"])
    return path


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("parts", [1, 3, 17])
def test_forward_fill_any_layout(spark, path, parts):
    data = rows(parts)
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    filled = ordered.forward_fill(df, ["v"], ["i"], ["g"], **skew(path))
    assert filled.columns == df.columns
    assert collected(filled) == naive_fill(data)


def test_forward_fill_is_idempotent_and_whole(spark):
    df = spark.createDataFrame(rows(5), SCHEMA)
    once = ordered.forward_fill(df, ["v"], ["i"], ["g"], **skew(PATHS[1]))
    twice = ordered.forward_fill(once, ["v"], ["i"], ["g"], **skew(PATHS[1]))
    assert collected(once) == collected(twice)
    assert once.count() == df.count()


def test_global_fill_needs_a_chunk(spark):
    data = [("a", i, v, "") for i, v in enumerate([None, 1.0, None, None, 2.0, None])]
    df = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(ValueError):
        ordered.forward_fill(df, ["v"], ["i"], [])
    got = ordered.forward_fill(df, ["v"], ["i"], [], chunk=F.floor(F.col("i") / 2))
    assert [r.v for r in got.orderBy("i").collect()] == [None, 1.0, 1.0, 1.0, 2.0, 2.0]


def test_several_order_columns(spark):
    data = [("a", 1, 1.0, "b"), ("a", 1, None, "c"), ("a", 1, 3.0, "a"), ("a", 2, None, "a")]
    df = spark.createDataFrame(data, SCHEMA)
    for path in PATHS[:2]:
        got = ordered.forward_fill(df, ["v"], ["i", "tag"], ["g"], **skew(path)).orderBy("i", "tag")
        assert [r.v for r in got.collect()] == [3.0, 1.0, 1.0, 1.0]


@pytest.mark.parametrize("path", PATHS)
def test_section_carry(spark, path):
    data = rows(9)
    df = spark.createDataFrame(data, SCHEMA)
    section = F.when(F.col("tag") == "m", F.col("i"))
    got = ordered.section_carry(df, section, "s", ["i"], ["g"], **skew(path))
    current, want = {}, []
    for g, i, v, tag in sorted(data, key=lambda r: (str(r[0]), r[1])):
        if tag == "m":
            current[g] = i
        elif g in current:
            want.append((g, i, v, tag, current[g]))
    assert collected(got) == sorted(want, key=str)


@pytest.mark.parametrize("path", PATHS)
def test_cut_at_sentinel(spark, path):
    data = [r for r in rows(11) if not (r[0] == "a" and r[3] == "stop")]
    df = spark.createDataFrame(data, SCHEMA)
    got = ordered.cut_at_sentinel(df, F.col("tag") == "stop", ["i"], ["g"], **skew(path))
    done, want = set(), []
    for r in sorted(data, key=lambda r: (str(r[0]), r[1])):
        if r[3] == "stop":
            done.add(r[0])
        if r[0] not in done:
            want.append(r)
    assert collected(got) == sorted(want, key=str)


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered.forward_fill(df, ["v"], ["i"], ["g"], **skew(PATHS[1])).count() == 0
