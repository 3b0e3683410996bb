"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.functions import numbers, periods, text
from indexpanel.plans import sales_panel as sp
from indexpanel.queries.base import LABEL, SALES, panel, query, r


@query(f"""SELECT l_orderkey, l_linenumber, {r("(l_extendedprice * l_discount)", 2)} AS discount_amount,
  {r("(l_extendedprice / l_quantity / 7)", 1)} AS price_seventh, {r("(l_tax - l_discount)", 1)} AS tax_gap FROM lineitem""")
def round_exact(spark, sf):
    c = F.col
    return sp.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.round_half_up(c("l_extendedprice") * c("l_discount"), 2).alias("discount_amount"),
        numbers.round_half_up(c("l_extendedprice") / c("l_quantity") / 7, 1).alias("price_seventh"),
        numbers.round_half_up(c("l_tax") - c("l_discount"), 1).alias("tax_gap"),
    )


@query(f"""WITH {SALES}, {panel(["p_type"])}
SELECT p_type, {LABEL} AS period, yoy, CASE WHEN yoy > 3.0 THEN 'high' WHEN yoy > 0 THEN 'rising' ELSE 'falling' END AS band,
  CASE WHEN yoy > qoq THEN 'above' WHEN yoy < qoq THEN 'below' ELSE 'equal' END AS against_quarter FROM panel""")
def value_band(spark, sf):
    rows = sp.with_period(sp.type_panel(spark, sf))
    return rows.select(
        "p_type", "period", "yoy",
        text.band(F.col("yoy"), [(3.0, "high"), (0, "rising")], "falling").alias("band"),
        text.compare_band(F.col("yoy"), F.col("qoq")).alias("against_quarter"),
    )


@query(f"""WITH {SALES}, {panel(["p_type"])}
SELECT p_type, {LABEL} AS period, printf('%+.2fpp', {r("(yoy - qoq)", 2)}) AS gap_text,
  printf('%.1f%%', {r("yoy", 1)}) AS yoy_text FROM panel WHERE yoy IS NOT NULL AND qoq IS NOT NULL""")
def format_report(spark, sf):
    rows = sp.with_period(sp.type_panel(spark, sf)).filter("yoy IS NOT NULL AND qoq IS NOT NULL")
    return rows.select(
        "p_type", "period", numbers.signed_points(F.col("yoy") - F.col("qoq")).alias("gap_text"),
        numbers.percent_text(F.col("yoy")).alias("yoy_text"),
    )


@query("""SELECT p_partkey, trim(lower('  ' || p_type || ' ')) AS type_clean, split_part(p_name, ' ', 1) AS first_word,
  split_part(p_brand, '#', 2) AS brand_no, regexp_full_match(split_part(p_brand, '#', 2), '[0-9]+') AS is_number,
  contains(p_name, 'ring') AS has_ring, starts_with(p_name, 'red') AS starts_red,
  p_type || '-' || substring(p_name, 1, 3) AS short_key FROM part""")
def text_clean(spark, sf):
    brand = F.substring_index("p_brand", "#", -1)
    return sp.table(spark, sf, "part").select(
        "p_partkey", F.trim(F.lower(F.concat(F.lit("  "), "p_type", F.lit(" ")))).alias("type_clean"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"), brand.alias("brand_no"),
        brand.rlike("^[0-9]+$").alias("is_number"),
        F.col("p_name").contains("ring").alias("has_ring"),
        F.col("p_name").startswith("red").alias("starts_red"),
        F.concat_ws("-", "p_type", F.substring("p_name", 1, 3)).alias("short_key"),
    )


# A published cell per line item: quantities padded, prices plain, marks where there is none.
CELL_SQL = """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '..' WHEN l_returnflag = 'R' THEN 'n/a'
  WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'nan'
  WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN {quantity} ELSE {price} END"""


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' OR l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL
  WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_quantity ELSE l_extendedprice END AS value FROM lineitem""")
def clean_number(spark, sf):
    cell = F.expr(CELL_SQL.format(
        quantity="concat(' ', cast(l_quantity as string), '\\t')",
        price="cast(cast(l_extendedprice as decimal(18,2)) as string)",
    ))
    return sp.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.clean_number(cell).alias("value")
    )


# A two-digit year is a year of this century, so 'Dec-95' is read as 2095.
@query("""SELECT o_orderkey, strftime(o_orderdate, '%b-%y') AS label,
  CASE WHEN month(o_orderdate) IN (3, 6, 9, 12) THEN CAST(last_day(make_date(
    CAST(2000 + year(o_orderdate) % 100 AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1)) AS VARCHAR) END AS period_date FROM orders""")
def parse_period(spark, sf):
    label = F.date_format("o_orderdate", "MMM-yy")
    return sp.table(spark, sf, "orders").select(
        "o_orderkey", label.alias("label"), periods.parse_period(label).cast("string").alias("period_date")
    )
