"""Every registered query beside its SQL: on the small tables, and on skewed copies of them in
which one order, part, customer, user and document hold a third of all rows or text."""

from __future__ import annotations

import os

import pytest
from check_oracles import TABLES, compare, connect

from indexpanel.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# Copies of a table in which a third of the rows share one key; documents get one huge text.
SKEWED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN hash(l_partkey, l_shipdate, l_extendedprice) % 3 = 0 THEN 17 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_partkey, l_shipdate, l_extendedprice) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey) FROM lineitem""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM events",
    "documents": """SELECT * REPLACE (CASE WHEN doc_id = 3 THEN
        (SELECT string_agg(text, chr(10) ORDER BY doc_id) FROM documents) ELSE text END AS text) FROM documents""",
}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def plain():
    return connect(SF)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    path, source = str(tmp_path_factory.mktemp("skewed")), connect(SF)
    for t in TABLES:
        source.execute(f"COPY ({SKEWED.get(t, f'SELECT * FROM {t}')}) TO '{path}/{t}.parquet' (FORMAT parquet)")
    return path, connect(path)


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, plain, key):
    assert compare(QUERIES[key](spark, SF), plain, ORACLES[key]) is None


@pytest.mark.parametrize("key", QUERIES)
def test_query_on_skewed_tables(spark, skewed, key):
    path, con = skewed
    assert compare(QUERIES[key](spark, path), con, ORACLES[key]) is None
