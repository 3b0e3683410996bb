"""Runs registered queries beside their SQL: python tests/check_oracles.py [sf] [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if got != want:
        in_got, in_want = set(got), set(want)
        extra = [x for x in got if x not in in_want][:2]
        missing = [x for x in want if x not in in_got][:2]
        return f"rows {len(got)} / {len(want)}; only spark {extra}; only sql {missing}"
    return None if got else "empty"


if __name__ == "__main__":
    from conftest import session

    from indexpanel.queries import ORACLES, QUERIES

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    keys = sys.argv[2:] or list(QUERIES)
    spark, con = session(), connect(sf)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            problem = compare(QUERIES[key](spark, sf), con, ORACLES[key])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} equal")
