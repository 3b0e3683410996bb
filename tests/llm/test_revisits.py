from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from indexpanel.llm import revisits as r

SCHEMA = ("record_id long, url string, ts long, kind string, etag string, last_modified string, digest string, "
          "headers array<struct<name:string,value:string>>, chunk string, r string")


def captures(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


@pytest.mark.parametrize("url, expected", [
    ("HTTP://WWW.Example.com:80/a/?utm_source=f&b=2&a=1#top", "example.com/a?a=1&b=2"), ("https://m.example.com", "example.com"),
    ("example.com/Path/", "example.com/Path"), (None, ""), ("", ""), ("https://x.org/?ref=x", "x.org"), ("https://x.org?q", "x.org?q")])
def test_canonical(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(r.canonical(F.col("u"))).first()[0] == expected


def test_as_of_join(spark):
    h = [("Content-Type", "a"), ("Date", "1"), ("Set-Cookie", "p"), ("Set-Cookie", "q")]
    rows = [(1, "http://x/a", 100, "response", '"e1"', "m1", "d1", h), (2, "https://x/a/", 100 + 9 * 3600, "response", '"e2"', None, "d2", None),
            (3, "http://x/a", 100, "revisit", '"e1"', None, None, None),  # not earlier
            (4, "http://x/a", 101, "revisit", 'W/"e1"', "other", None, [("date", "2"), ("CONTENT-TYPE", "b"), ("Vary", "z")]),
            (5, "http://x/a", 50 * 3600, "revisit", '"e1"', None, None, None),  # the latest one has another tag
            (6, "http://x/a", 50 * 3600, "revisit", None, "m9", "d2", None),  # only the digest is common
            (7, "http://x/a", 50 * 3600, "revisit", None, "m9", None, None), (8, "http://y", 5, "revisit", '"e"', None, None, None),
            (9, None, None, "revisit", '"e"', None, None, None), (10, None, None, "response", '"e"', None, "d", None),
            (11, None, 7, "revisit", '"e"', None, None, None)]
    got = {x.record_id: (x.verdict, x.refers_to, None if x.headers is None else [tuple(y) for y in x.headers])
           for x in r.resolved(captures(spark, rows)).collect()}
    assert got == {
        3: ("orphan", None, None), 5: ("mismatch", None, None), 6: ("resolved", 2, []), 7: ("unchecked", None, None), 8: ("orphan", None, None),
        4: ("resolved", 1, [("content-type", "a"), ("date", "2"), ("set-cookie", "p"), ("set-cookie", "q"), ("vary", "z")]),
        9: ("orphan", None, None), 11: ("orphan", None, None)}


def test_ties_and_repeated_rows(spark):
    rows = [(i, "x", 10, "response", '"e"', None, "d", None) for i in (1, 2, 2)] + [(9, "x", 20, "revisit", '"e"', None, None, None)] * 2
    assert [(x.verdict, x.refers_to) for x in r.resolved(captures(spark, rows)).collect()] == [("resolved", 2)] * 2


def test_empty_table(spark):
    assert r.resolved(captures(spark, [])).count() == 0


def test_hot_url_is_spread_over_tasks(spark):
    """A URL with nearly all captures: brute force agrees, and windows of rows are cut by the hour."""
    rows = [(i, "hot", i * 300, "response" if i % 5 == 0 else "revisit", f'"{i // 5}"', None, f"d{i}", None) for i in range(2000)]
    got = {x.record_id: x.refers_to for x in r.resolved(captures(spark, rows)).collect()}
    assert got == {i: i - i % 5 for i in range(2000) if i % 5}
    plan = r.resolved(captures(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("rangeframe" in x.lower() and "chunk" in x for x in plan.splitlines()) == 1
