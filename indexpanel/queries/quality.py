"""Data-quality queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.operators import quality as q
from indexpanel.operators import series, star
from indexpanel.plans.sales_panel import table
from indexpanel.queries.base import query
from indexpanel.sources.files import lookup_df

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# Fixed sizes: the two tables whose row count is the same at every scale.
EXPECTED = {"region": 5, "nation": 25, "supplier": 0}


@query("WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in TABLES
) + """), e(table_name, expected) AS (VALUES ('region', 5), ('nation', 25), ('supplier', 0))
SELECT table_name, n_rows, CAST(expected AS BIGINT) AS expected,
  CASE WHEN n_rows = expected THEN 'OK' ELSE 'EXPECTED ' || coalesce(CAST(expected AS VARCHAR), 'nothing') END AS status
FROM c LEFT JOIN e USING (table_name)""")
def row_counts(spark, sf):
    counts = q.row_counts({t: table(spark, sf, t) for t in TABLES})
    expected = lookup_df(spark, EXPECTED, "table_name", "expected", ("string", "bigint"))
    return q.expect_counts(counts, expected)


LABELLED_SQL = "d AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
LABELLED = ("doc_id", "lang", "source", "n_chars", "quality", "toxic")


def _labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").select(*LABELLED)


@query(f"WITH {LABELLED_SQL} " + " UNION ALL ".join(
    f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(6 AS BIGINT) AS n_columns, '{c}' AS column_name,
  CAST(count(*) - count({c}) AS BIGINT) AS n_nulls, CASE WHEN count(*) = count({c}) THEN 'clean' ELSE 'missing values' END AS status FROM d"""
    for c in LABELLED
))
def null_profile(spark, sf):
    return q.null_profile(_labelled(spark, sf))


@query(f"WITH {LABELLED_SQL} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM d" for c in LABELLED
) + ") WHERE n_nulls > 0")
def not_null(spark, sf):
    return q.not_null(_labelled(spark, sf), LABELLED)


PART_TYPES = {
    "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
    "p_size": "int", "p_retailprice": "double",
}


@query(" UNION ALL ".join(
    f"""SELECT 'part' AS table_name, '{c}' AS column_name, '{t}' AS data_type, '' AS meaning,
  CAST(min({c}) AS VARCHAR) AS example, CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM part"""
    for c, t in PART_TYPES.items()
))
def data_dictionary(spark, sf):
    return q.data_dictionary(table(spark, sf, "part").select(*PART_TYPES), "part")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM orders"
    for c in ("o_custkey", "o_orderstatus", "o_orderpriority")
))
def distinct_counts(spark, sf):
    return q.distinct_counts(
        table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"]
    )


LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def pk_duplicates(spark, sf):
    return q.pk_duplicates(table(spark, sf, "lineitem"), LINE_KEY)


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dim_distinct(spark, sf):
    return star.dim_distinct(table(spark, sf, "lineitem"), LINE_KEY)


REST = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(REST)}) = 1""")
def dedup_first(spark, sf):
    out = q.dedup_first(table(spark, sf, "lineitem"), LINE_KEY, [F.col(c) for c in REST])
    return out.select(*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("""SELECT doc_id, lang, source FROM documents
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)""")
def fk_orphans(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return q.orphans(docs, table(spark, sf, "labels"), "doc_id", "doc_id")


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 8""")
def latest_n(spark, sf):
    orders = table(spark, sf, "orders")
    top = series.latest_n(orders, 8, F.desc("o_orderdate"), F.asc("o_orderkey"))
    return top.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_date"), "o_totalprice")


@query("""WITH p AS (SELECT l_extendedprice AS price, l_quantity AS quantity, l_extendedprice * 1e12 AS scaled_price,
  CASE WHEN l_discount = 0 THEN 'nan'::DOUBLE ELSE l_discount END AS discount FROM lineitem)
SELECT u.c AS column_name, CAST(count(*) FILTER (u.v IS NOT NULL AND (isnan(u.v) OR abs(u.v) >= 9e16)) AS BIGINT) AS n_unusable
FROM (SELECT unnest([{'c': 'price', 'v': price}, {'c': 'quantity', 'v': quantity}, {'c': 'scaled_price', 'v': scaled_price},
  {'c': 'discount', 'v': discount}]) AS u FROM p) GROUP BY u.c""")
def unusable_amounts(spark, sf):
    """Amounts that the exact sums leave out: of line items as they are, scaled beyond the range, and with NaN for no discount."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * 1e12).alias("scaled_price"),
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount")).alias("discount"))
    return q.unusable_amounts(lines, lines.columns)
