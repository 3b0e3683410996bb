"""Each registered query beside its SQL, on the smallest given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from indexpanel.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    rel = con.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    expected = sorted(str([row[i] for i in order]) for row in rel.fetchall())
    assert sorted(str([row[c] for c in columns]) for row in got.collect()) == expected


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
