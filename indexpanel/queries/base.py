"""Registry, and the SQL building blocks of the checks."""

from __future__ import annotations

from collections.abc import Sequence

from indexpanel.functions.periods import ordinal_of

SNAPSHOT = ordinal_of(2001, 2)  # the last full quarter of the test tables, Jun-01
SNAPSHOT_QUARTERS = (SNAPSHOT - 4, SNAPSHOT - 1, SNAPSHOT)
WEIGHT_QUARTERS = tuple(range(SNAPSHOT - 8, SNAPSHOT - 4))
BENCHMARK = "EUROPE"
TARGET = 2.0

REGISTRY: dict[str, tuple] = {}


def query(sql: str):
    """Registers the function under its name, with its checking SQL."""

    def register(fn):
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return register


def r(x: str, n: int) -> str:
    """round_half_up in SQL, by DECIMAL arithmetic on the printed value."""
    return f"(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE) + 0.0)"


SALES = """sales AS (
  SELECT p_type, p_brand, p_name, r_name,
         CASE WHEN p_size <= 25 THEN 'tradeables' ELSE 'nontradeables' END AS component,
         CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS ordinal,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

END = "last_day(make_date(CAST((ordinal - 1) // 4 AS INTEGER), CAST((ordinal - (ordinal - 1) // 4 * 4) * 3 AS INTEGER), 1))"
LABEL = f"strftime({END}, '%b-%y')"
GROUPED = """grouped AS (
  SELECT 'All groups' AS group_name, 'TOTAL' AS series_ref, ordinal, v, q, p_type FROM sales
  UNION ALL SELECT p_type || ' group', rpad(p_type, 10, '.'), ordinal, v, q, p_type FROM sales)"""
GROUPED_ALL = """grouped AS (
  SELECT 'All groups' AS group_name, 'TOTAL' AS series_ref, ordinal, v, q FROM sales
  UNION ALL SELECT p_type || ' group', rpad(p_type, 10, '.'), ordinal, v, q FROM sales
  UNION ALL SELECT p_type || ' / ' || p_brand, rpad(p_type, 10, '.') || p_brand, ordinal, v, q FROM sales)"""
REGIONS = """regions AS (
  SELECT r_name AS region, ordinal, v, q FROM sales
  UNION ALL SELECT 'ALL REGIONS', ordinal, v, q FROM sales)"""
COMPONENT_ROWS = """components AS (
  SELECT component AS series, r_name, ordinal, v, q FROM sales
  UNION ALL SELECT 'allgroups', r_name, ordinal, v, q FROM sales)"""


def panel(keys: Sequence[str], source: str = "sales", name: str = "panel") -> str:
    """CTEs of an indexed panel: changes by self-joins on the quarter ordinal."""
    k = ", ".join(keys)

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)

    def pct(b: str) -> str:
        return r(f"((i.unit_value - {b}.unit_value) / NULLIF({b}.unit_value, 0) * 100)", 1)

    return f"""{name}_cells AS (
  SELECT {k}, ordinal, SUM(v) AS value, SUM(q) AS quantity FROM {source} GROUP BY {k}, ordinal),
{name}_units AS (
  SELECT *, CAST(value AS DOUBLE) / NULLIF(CAST(quantity AS DOUBLE), 0) AS unit_value FROM {name}_cells),
{name}_base AS (
  SELECT {k}, arg_min(unit_value, ordinal) AS base FROM {name}_units GROUP BY {k}),
{name} AS (
  SELECT i.*, {r("(i.unit_value * 1000.0::DOUBLE / NULLIF(b.base, 0))", 2)} AS index_value,
         {pct("p")} AS qoq, {pct("y")} AS yoy
  FROM {name}_units i JOIN {name}_base b ON {same("i", "b")}
  LEFT JOIN {name}_units p ON {same("i", "p")} AND p.ordinal = i.ordinal - 1
  LEFT JOIN {name}_units y ON {same("i", "y")} AND y.ordinal = i.ordinal - 4)"""


def wide(by: Sequence[str] = ()) -> str:
    """CTEs of the wide component series."""
    keys = ["series", *by]
    on = "".join(f" AND a.{c} = {{0}}.{c}" for c in by)
    cols = ", ".join(
        f"max(CASE WHEN series = '{c}' THEN {source} END) AS {c}_{m}"
        for c in ("tradeables", "nontradeables", "allgroups")
        for m, source in (("index", "index_value"), ("qoq_pct", "qoq"), ("yoy_pct", "yoy"))
    )
    k = "".join(f"{c}, " for c in by)
    return f"""{SALES}, {COMPONENT_ROWS}, {panel(keys, "components")},
wide AS (SELECT {k}ordinal, {cols} FROM panel GROUP BY {k}ordinal)"""
