"""Line items whose order, part or place is missing: which grains count them."""

from __future__ import annotations

import datetime

from indexpanel.plans import sales_panel as sp

TABLES = {
    "region": ("r_regionkey long, r_name string", [(1, "R")]),
    "nation": ("n_nationkey long, n_regionkey long", [(1, 1)]),
    "customer": ("c_custkey long, c_nationkey long", [(1, 1), (2, 9)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
               [(k, c, datetime.datetime(2024, 1, 5)) for k, c in ((1, 1), (2, 2), (3, 9))]),
    "part": ("p_partkey long, p_type string, p_brand string, p_name string, p_size long", [(1, "T", "B", "N", 1)]),
    # Whole; its order missing; its part missing; its customer's nation missing; its customer missing.
    "lineitem": ("l_orderkey long, l_partkey long, l_extendedprice double, l_quantity double",
                 [(1, 1, 1.0, 1.0), (9, 1, 10.0, 1.0), (1, 9, 100.0, 1.0), (2, 1, 1000.0, 1.0), (3, 1, 10000.0, 1.0)]),
}


def test_orphans_count_at_grains_that_need_no_such_key(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    def total(keys):
        return sum(float(r["value"]) for r in sp.sales_cells(spark, str(tmp_path), keys).collect())

    assert total([]) == 11101 and total(["p_type"]) == 11001
    assert total(["r_name"]) == 101 and total(["p_type", "r_name"]) == 1
