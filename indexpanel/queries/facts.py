"""Facts, dimensions and their hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.functions.text import TOTAL_NAME
from indexpanel.operators import decompose, quality, star
from indexpanel.operators.series import index_panel
from indexpanel.plans import sales_panel as sp
from indexpanel.queries.base import (
    END, GROUPED, GROUPED_ALL, LABEL, REGIONS, SALES, panel, query, wide,
)
from indexpanel.sources.schema import KEYS, REFERENCES

PERIOD_SQL = f"{LABEL} AS period, CAST({END} AS VARCHAR) AS period_date"


def _text_date(df):
    return df.withColumn("period_date", F.col("period_date").cast("string"))


@query(f"""WITH {SALES}, {GROUPED_ALL}, {panel(["group_name", "series_ref"], "grouped")}
SELECT group_name, series_ref, {PERIOD_SQL}, CAST(value AS DOUBLE) AS value, CAST(quantity AS DOUBLE) AS quantity,
  index_value, qoq AS qoq_pct_change, yoy AS yoy_pct_change FROM panel""")
def fact_group_panel(spark, sf):
    rows = _text_date(sp.with_period(sp.group_panel(spark, sf)))
    return rows.select(
        "group_name", "series_ref", "period", "period_date", F.col("value").cast("double"),
        F.col("quantity").cast("double"), "index_value",
        F.col("qoq").alias("qoq_pct_change"), F.col("yoy").alias("yoy_pct_change"),
    )


@query(f"""WITH {SALES}, {REGIONS}, {panel(["region"], "regions")}
SELECT region, {PERIOD_SQL}, index_value, qoq AS qoq_pct_change, yoy AS yoy_pct_change FROM panel""")
def fact_region_panel(spark, sf):
    rows = _text_date(sp.with_period(sp.region_panel(spark, sf)))
    return rows.select(
        "region", "period", "period_date", "index_value",
        F.col("qoq").alias("qoq_pct_change"), F.col("yoy").alias("yoy_pct_change"),
    )


MEASURES = [f"{c}_{m}" for c in sp.COMPONENTS for m in ("index", "qoq_pct", "yoy_pct")]


@query(f"""WITH {wide()} SELECT {PERIOD_SQL}, CAST(year({END}) AS INTEGER) AS year, strftime({END}, '%b') AS quarter,
  {", ".join(MEASURES)} FROM wide""")
def fact_components(spark, sf):
    rows = _text_date(sp.with_period(sp.wide_series(spark, sf)))
    return rows.select("period", "period_date", "year", "quarter", *MEASURES)


@query(f"""WITH {SALES}, {panel(["p_type"])}
SELECT p_type, {PERIOD_SQL}, coalesce({END} >= DATE '2000-01-01', FALSE) AS is_recent, index_value FROM panel""")
def flag_since(spark, sf):
    rows = sp.with_period(sp.type_panel(spark, sf))
    since = F.col("period_date") >= F.lit("2000-01-01").cast("date")
    return _text_date(star.flag_since(rows, since, "is_recent")).select(
        "p_type", "period", "period_date", "is_recent", "index_value"
    )


@query(f"""WITH q AS (SELECT DISTINCT CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS ordinal FROM orders)
SELECT {PERIOD_SQL}, CAST(year({END}) AS INTEGER) AS year, strftime({END}, '%b') AS quarter, ordinal,
  strftime({END}, '%b %Y') AS axis_label FROM q""")
def period_dim(spark, sf):
    return _text_date(star.period_dim(sp.table(spark, sf, "orders"), "o_orderdate"))


@query("""WITH names AS (SELECT 'All groups' AS group_name, 'TOTAL' AS series_ref FROM part
  UNION ALL SELECT p_type || ' group', rpad(p_type, 10, '.') FROM part
  UNION ALL SELECT p_type || ' / ' || p_brand || ' / ' || p_name, rpad(p_type, 10, '.') || p_brand FROM part)
SELECT group_name, min(series_ref) AS series_ref,
  CASE WHEN lower(trim(group_name)) LIKE '% group' OR lower(trim(group_name)) = 'all groups' THEN 'group' ELSE 'subgroup' END AS level
FROM names GROUP BY group_name""")
def group_dim(spark, sf):
    from indexpanel.queries.snapshots import part_names

    return star.group_dim(part_names(spark, sf), "group_name", "series_ref")


@query(f"""WITH {SALES}, {GROUPED}, parents AS (SELECT series_ref, ordinal, SUM(v) AS value, SUM(q) AS quantity
  FROM grouped WHERE group_name <> 'All groups' GROUP BY 1, 2),
children AS (SELECT rpad(p_type, 10, '.') || p_brand AS child_ref, ordinal, SUM(v) AS value, SUM(q) AS quantity
  FROM sales GROUP BY 1, 2),
rolled AS (SELECT substring(child_ref, 1, 10) AS series_ref, ordinal, SUM(value) AS value, SUM(quantity) AS quantity
  FROM children GROUP BY 1, 2)
SELECT p.series_ref, {LABEL.replace("ordinal", "p.ordinal")} AS period, CAST(p.value AS DOUBLE) AS value,
  CAST(r.value AS DOUBLE) AS value_rolled_up, CAST(p.quantity AS DOUBLE) AS quantity,
  CAST(r.quantity AS DOUBLE) AS quantity_rolled_up, p.value = r.value AND p.quantity = r.quantity AS ok
FROM parents p FULL JOIN rolled r ON p.series_ref = r.series_ref AND p.ordinal = r.ordinal""")
def hierarchy_rollup(spark, sf):
    measures = ["value", "quantity"]
    fact = sp.group_cells(spark, sf).filter(F.col("group_name") != TOTAL_NAME)
    out = decompose.rollup_check(fact, "series_ref", sp.REF_WIDTH, ["ordinal"], measures)
    return sp.with_period(out).select(
        "series_ref", "period",
        *[F.col(c).cast("double") for m in measures for c in (m, f"{m}_rolled_up")], "ok",
    )


@query(f"""WITH {SALES}, cells AS (SELECT DISTINCT p_type, p_brand, r_name, ordinal FROM sales),
entities AS (SELECT DISTINCT p_type, p_brand, r_name FROM cells), quarters AS (SELECT DISTINCT ordinal FROM cells)
SELECT p_type, p_brand, r_name, {LABEL} AS period FROM entities, quarters
WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.p_type = entities.p_type AND c.p_brand = entities.p_brand
  AND c.r_name = entities.r_name AND c.ordinal = quarters.ordinal)""")
def panel_gaps(spark, sf):
    entity = ["p_type", "p_brand", "r_name"]
    gaps = quality.panel_gaps(sp.sales_cells(spark, sf, entity), entity)
    return sp.with_period(gaps).select(*entity, "period")


STAR_SQL = f"""{SALES}, {GROUPED_ALL}, {REGIONS},
dim_period AS (SELECT DISTINCT {LABEL} AS period FROM sales),
dim_group AS (SELECT group_name, min(series_ref) AS series_ref FROM grouped GROUP BY group_name),
dim_region AS (SELECT DISTINCT region FROM regions),
fact_allgroups AS (SELECT {LABEL} AS period FROM sales GROUP BY ordinal),
fact_groups AS (SELECT group_name, {LABEL} AS period FROM grouped GROUP BY group_name, ordinal),
fact_regional AS (SELECT region, {LABEL} AS period FROM regions GROUP BY region, ordinal),
n AS (SELECT (SELECT count(DISTINCT year(o_orderdate) * 4 + quarter(o_orderdate)) FROM orders) AS quarters,
  (SELECT 1 + count(DISTINCT p_type) + count(DISTINCT (p_type, p_brand)) FROM part) AS members,
  (SELECT count(*) + 1 FROM region) AS places),
expected AS (SELECT unnest(['dim_period', 'dim_group', 'dim_region', 'fact_allgroups', 'fact_groups', 'fact_regional']) AS t,
  unnest([quarters, members, places, quarters, members * quarters, places * quarters]) AS expected FROM n)"""
ROWS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in KEYS)
REPEATS_SQL = " UNION ALL ".join(
    f"SELECT 'duplicate keys {t}' AS c, count(*) AS n FROM (SELECT 1 FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)"
    for t, k in KEYS.items()
)
LOST_SQL = " UNION ALL ".join(
    f"SELECT 'orphans {f} {k}' AS c, count(*) AS n FROM {f} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {d})"
    for f, d, k in REFERENCES
)


@query(f"""WITH {STAR_SQL}
SELECT 'rows ' || t AS "check", CAST(n AS BIGINT) AS n, CASE WHEN n = expected THEN 'OK' ELSE 'EXPECTED ' || expected END AS status
FROM ({ROWS_SQL}) JOIN expected USING (t)
UNION ALL SELECT c, CAST(n AS BIGINT), CASE WHEN n = 0 THEN 'OK' ELSE 'BROKEN' END FROM ({REPEATS_SQL} UNION ALL {LOST_SQL})""")
def star_report(spark, sf):
    """The star built from the sales panels, and its verification against counts derived from the source tables."""
    # One aggregation of the line items feeds all three panels; its exchange is reused by every check.
    cells = sp.sales_cells(spark, sf, ["p_type", "p_brand", "component", "r_name"])
    changes = {"qoq": "qoq_pct_change", "yoy": "yoy_pct_change"}
    groups = index_panel(sp.group_members(cells), ["group_name"]).withColumnsRenamed(changes)
    regional = index_panel(sp.region_members(cells), ["region"]).withColumnsRenamed(
        {"index_value": "cpi_index", **changes}
    )
    panels = [sp.with_period(p) for p in (sp.wide_of(cells), groups, regional)]
    quarters = sp.table(spark, sf, "orders").agg(F.count_distinct(sp.ordinal(F.col("o_orderdate")))).scalar()
    members = sp.table(spark, sf, "part").agg(
        F.count_distinct("p_type") + F.count_distinct("p_type", "p_brand") + 1
    ).scalar()
    places = sp.table(spark, sf, "region").agg(F.count("*") + 1).scalar()
    sizes = {
        "dim_period": quarters, "dim_group": members, "dim_region": places, "fact_allgroups": quarters,
        "fact_groups": members * quarters, "fact_regional": places * quarters,
    }
    pairs = F.array(*[F.struct(F.lit(t).alias("table_name"), n.alias("expected")) for t, n in sizes.items()])
    return star.verify_star(star.build_star(*panels), spark.range(1).select(F.inline(pairs)))


# Codes of four levels: 'PROMO' > 'PROMO 1' > 'PROMO 1 Brand#11' > 'PROMO 1 Brand#11 tradeables'. Some are not published, so that
# orphans (no SMALL), gaps (no 'PROMO 1') and wrong totals (ECONOMY without Brand#11) show.
LEVELS_SQL = f"""{SALES},
named AS (SELECT p_type || ' ' || substring(p_brand, 7, 1) AS b, * FROM sales),
published AS (
  SELECT b || ' ' || p_brand || ' ' || component AS code, ordinal, v, q FROM named
  UNION ALL SELECT b || ' ' || p_brand, ordinal, v, q FROM named
  UNION ALL SELECT b, ordinal, v, q FROM named WHERE p_type <> 'PROMO'
  UNION ALL SELECT p_type, ordinal, v, q FROM named WHERE p_type <> 'SMALL' AND NOT (p_type = 'ECONOMY' AND p_brand = 'Brand#11')),
cells AS (SELECT code, ordinal, SUM(v) AS value, SUM(q) AS quantity FROM published GROUP BY code, ordinal),
listed AS (SELECT p_type AS a, p_type || ' ' || substring(p_brand, 7, 1) AS b, p_brand,
  CASE WHEN p_size <= 25 THEN 'tradeables' ELSE 'nontradeables' END AS component FROM part),
members AS (SELECT DISTINCT code FROM (SELECT b || ' ' || p_brand || ' ' || component AS code FROM listed
  UNION ALL SELECT b || ' ' || p_brand FROM listed UNION ALL SELECT b FROM listed WHERE a <> 'PROMO'
  UNION ALL SELECT a FROM listed WHERE a <> 'SMALL' AND NOT (a = 'ECONOMY' AND p_brand = 'Brand#11')) WHERE code IS NOT NULL),
climb AS (SELECT code AS descendant, code AS ancestor, 0 AS steps FROM members
  UNION ALL SELECT descendant, regexp_replace(ancestor, ' [^ ]*$', ''), steps + 1 FROM climb WHERE ancestor LIKE '% %'),
pairs AS (SELECT descendant, ancestor, steps FROM climb JOIN members ON ancestor = code WHERE steps > 0),
leaves AS (SELECT code FROM members WHERE code NOT IN (SELECT ancestor FROM pairs)),
rolled AS (SELECT ancestor AS code, ordinal, SUM(value) AS value, SUM(quantity) AS quantity
  FROM pairs JOIN leaves ON descendant = leaves.code JOIN cells ON cells.code = descendant GROUP BY ancestor, ordinal),
parents AS (SELECT descendant AS code, arg_min(ancestor, steps) AS parent, min(steps) AS steps_up FROM pairs GROUP BY descendant),
children AS (SELECT parent AS code, count(*) AS n FROM parents GROUP BY parent)"""


@query(f"""WITH RECURSIVE {LEVELS_SQL}
SELECT coalesce(c.code, r.code) AS code, {LABEL.replace("ordinal", "coalesce(c.ordinal, r.ordinal)")} AS period,
  CAST(c.value AS DOUBLE) AS value, CAST(r.value AS DOUBLE) AS value_rolled_up, CAST(c.quantity AS DOUBLE) AS quantity,
  CAST(r.quantity AS DOUBLE) AS quantity_rolled_up,
  n.n IS NULL OR (c.value IS NOT DISTINCT FROM r.value AND c.quantity IS NOT DISTINCT FROM r.quantity) AS ok,
  p.parent, CAST(coalesce(n.n, 0) AS BIGINT) AS n_children,
  p.parent IS NULL AND coalesce(c.code, r.code) LIKE '% %' AS is_orphan, coalesce(p.steps_up > 1, FALSE) AS is_gap
FROM cells c FULL JOIN rolled r ON c.code = r.code AND c.ordinal = r.ordinal
LEFT JOIN parents p ON p.code = coalesce(c.code, r.code) LEFT JOIN children n ON n.code = coalesce(c.code, r.code)""")
def hierarchy_closure(spark, sf):
    """A hierarchy of four levels rolled up from its leaves, with orphans and gaps in the levels."""
    kind, brand = F.col("p_type"), F.col("p_brand")
    line = F.concat(kind, F.lit(" "), F.substring(brand, 7, 1))
    levels = F.filter(F.array(
        F.concat(line, F.lit(" "), brand, F.lit(" "), "component"), F.concat(line, F.lit(" "), brand),
        F.when(kind != "PROMO", line), F.when((kind != "SMALL") & ~((kind == "ECONOMY") & (brand == "Brand#11")), kind),
    ), lambda c: c.isNotNull())
    fact = sp.sales_cells(spark, sf, ["p_type", "p_brand", "component"]).select(
        "ordinal", "value", "quantity", F.explode(levels).alias("code"))
    component = F.when(F.col("p_size") <= sp.COMPONENT_SIZE, sp.COMPONENTS[0]).otherwise(sp.COMPONENTS[1])
    members = sp.table(spark, sf, "part").withColumn("component", component).select(F.explode(levels).alias("code"))
    pairs = decompose.closure(members, "code", decompose.path_prefixes(F.col("code")))
    measures = ["value", "quantity"]
    rolled = decompose.rollup_closure(fact, "code", pairs, ["ordinal"], measures)
    linked = decompose.hierarchy(pairs, ~F.col("ref").contains(" "))
    out = sp.with_period(rolled).join(linked.withColumnRenamed("ref", "code"), "code")
    return out.select("code", "period", *[F.col(c).cast("double") for m in measures for c in (m, f"{m}_rolled_up")], "ok",
                      "parent", "n_children", "is_orphan", "is_gap")
