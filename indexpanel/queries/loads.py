"""Staged loads and long <-> wide."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexpanel.functions.numbers import from_minor_units, minor_units
from indexpanel.functions.periods import ordinal
from indexpanel.operators import quality, reshape
from indexpanel.plans.sales_panel import table
from indexpanel.queries.base import query
from indexpanel.sources import staged
from indexpanel.sources.records import records
from indexpanel.sources.staged import Pick

PICKS = [
    Pick("order_ref", 1, "bigint"), Pick("priority", 4), Pick("order_date", 2, "date", strict=False),
    Pick("order_year", 3, "int"), Pick("price", 5, "decimal(10,2)"),
]


def order_lines(spark, sf):
    """Orders as staged CSV lines. No price where the priority is not specified, no year for
    urgent pending orders, an unreadable date for the other pending ones."""
    return table(spark, sf, "orders").select(F.expr("""concat_ws(',',
      cast(o_orderkey as string),
      case when o_orderstatus = 'P' then 'unknown' else date_format(o_orderdate, 'yyyy-MM-dd') end,
      case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'pending'
           else cast(year(o_orderdate) as string) end,
      concat('"', o_orderpriority, ', ', o_orderstatus, '"'),
      case when o_orderpriority = '4-NOT SPECIFIED' then 'n/a'
           else cast(cast(o_totalprice as decimal(18,2)) as string) end)""").alias("line"))


BAD_YEAR = "(o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"
BAD_PRICE = "(o_orderpriority = '4-NOT SPECIFIED')"


@query(f"""SELECT o_orderkey AS order_ref, o_orderpriority || ', ' || o_orderstatus AS priority,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
  CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice AS price
FROM orders WHERE NOT {BAD_YEAR} AND NOT {BAD_PRICE}""")
def staged_load(spark, sf):
    return staged.staged_load(order_lines(spark, sf), PICKS).withColumns({
        "order_date": F.col("order_date").cast("string"), "price": F.col("price").cast("double"),
    })


@query(f"""SELECT o_orderkey AS order_ref, CASE WHEN {BAD_YEAR} THEN 'order_year' ELSE 'price' END AS failed_column
FROM orders WHERE {BAD_YEAR} OR {BAD_PRICE}""")
def load_rejects(spark, sf):
    bad = staged.rejects(staged.load_with_rejects(order_lines(spark, sf), PICKS))
    return bad.select(
        F.substring_index("line", ",", 1).cast("bigint").alias("order_ref"), "failed_column"
    )


@query(f"""SELECT CAST(count(*) AS BIGINT) AS rows_parsed,
  CAST(count(*) FILTER (NOT {BAD_YEAR} AND NOT {BAD_PRICE}) AS BIGINT) AS rows_loaded,
  CAST(count(*) FILTER ({BAD_YEAR} OR {BAD_PRICE}) AS BIGINT) AS errors_seen, CAST(0 AS BIGINT) AS n_malformed FROM orders""")
def load_metrics(spark, sf):
    return staged.load_metrics(staged.load_with_rejects(order_lines(spark, sf), PICKS))


@query(f"""WITH p AS (SELECT CAST(o_totalprice AS DECIMAL(10,2)) AS price FROM orders WHERE NOT {BAD_YEAR} AND NOT {BAD_PRICE})
SELECT CAST(count(price) AS BIGINT) AS n_values, CAST(count(*) FILTER (price <> floor(price)) AS BIGINT) AS n_fractional,
  CAST(max(price) AS DOUBLE) AS max_value,
  CAST(max(CASE WHEN CAST(price * 100 AS BIGINT) % 10 <> 0 THEN 2 WHEN price <> floor(price) THEN 1 ELSE 0 END) AS BIGINT) AS max_digits
FROM p""")
def decimal_scale(spark, sf):
    return quality.check_scale(staged.staged_load(order_lines(spark, sf), PICKS), "price")


KEYS = ["l_returnflag", "ordinal"]
QUARTERLY_SQL = """q AS (SELECT l_returnflag, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) AS INTEGER) AS ordinal,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS n, l_discount, l_tax FROM lineitem)"""


def _shipped(spark, sf):
    return table(spark, sf, "lineitem").withColumn("ordinal", ordinal(F.col("l_shipdate")))


@query(f"""WITH {QUARTERLY_SQL}, a AS (SELECT l_returnflag, ordinal, SUM(v) AS x, SUM(n) AS y, count(*) AS z FROM q GROUP BY 1, 2)
SELECT l_returnflag, ordinal, 'value' AS metric, CAST(x AS DOUBLE) AS value FROM a
UNION ALL SELECT l_returnflag, ordinal, 'quantity', CAST(y AS DOUBLE) FROM a
UNION ALL SELECT l_returnflag, ordinal, 'n_lines', CAST(z AS DOUBLE) FROM a""")
def unpivot_measures(spark, sf):
    wide = _shipped(spark, sf).groupBy(*KEYS).agg(
        from_minor_units(F.sum(minor_units(F.col("l_extendedprice")))).cast("double").alias("value"),
        from_minor_units(F.sum(minor_units(F.col("l_quantity")))).cast("double").alias("quantity"),
        F.count("*").cast("double").alias("n_lines"),
    ).withColumnRenamed("value", "v")
    long = reshape.unpivot(wide, KEYS, ["v", "quantity", "n_lines"])
    return long.withColumn("metric", F.when(F.col("metric") == "v", "value").otherwise(F.col("metric")))


@query("""WITH a AS (SELECT year(l_shipdate) * 4 + quarter(l_shipdate) AS ordinal,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS x FROM lineitem GROUP BY 1),
o AS (SELECT year(o_orderdate) * 4 + quarter(o_orderdate) AS ordinal, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
b AS (SELECT ordinal, SUM(p) AS x FROM o GROUP BY 1),
c AS (SELECT ordinal, SUM(p) AS x FROM o WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT CAST(a.ordinal AS INTEGER) AS ordinal, CAST(a.x AS DOUBLE) AS shipped, CAST(b.x AS DOUBLE) AS ordered,
  CAST(c.x AS DOUBLE) AS pending, CAST(1 AS BIGINT) AS n_rows FROM a LEFT JOIN b USING (ordinal) LEFT JOIN c USING (ordinal)""")
def merge_measures(spark, sf):
    def total(df, date, **cents):
        return df.groupBy(ordinal(F.col(date)).alias("ordinal")).agg(*[
            from_minor_units(F.sum(c)).cast("double").alias(name) for name, c in cents.items()
        ])

    price = minor_units(F.col("o_totalprice"))
    orders = total(table(spark, sf, "orders"), "o_orderdate", ordered=price,
                   pending=F.when(F.col("o_orderstatus") == "P", price))
    shipped = total(table(spark, sf, "lineitem"), "l_shipdate", shipped=minor_units(F.col("l_extendedprice")))
    # Both measures of the orders come from one aggregation, so they merge as one table.
    merged = reshape.merge_measures(
        shipped, {"both": orders.select("ordinal", F.struct("ordered", "pending").alias("both"))}, ["ordinal"], "shipped",
    )
    return merged.select("ordinal", "shipped", "both.*", F.greatest("n_shipped", "n_both").alias("n_rows"))


FLAGS = ("A", "N", "R")
ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("SELECT l_orderkey, " + ", ".join(
    f"arg_min(l_extendedprice, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_extendedprice)) "
    f"FILTER (l_returnflag = '{f}') AS price_{f}" for f in FLAGS
) + f", count(*) FILTER (l_extendedprice IS NOT NULL AND (l_returnflag IS NULL OR l_returnflag NOT IN {FLAGS})) AS n_other" + " FROM lineitem GROUP BY l_orderkey")
def pivot_first(spark, sf):
    wide = reshape.pivot_first(
        table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", "l_extendedprice", FLAGS, ORDER, other="n_other"
    )
    return reshape.rename(wide, {f: f"price_{f}" for f in FLAGS})


PART_DOCUMENTS, SPLIT_LINES = 500, 3


def document_lines(spark, sf):
    """Documents as lines of staged files of 500 rows with a header, the text quoted with its line breaks, in splits of three
    lines each, so that records cross their edges."""
    docs = table(spark, sf, "documents")
    part = F.floor(F.col("doc_id") / PART_DOCUMENTS)
    record = F.concat_ws(",", F.col("doc_id").cast("string"), F.concat(
        F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')), F.coalesce("lang", F.lit("")),
        F.concat(F.lit('"from\n'), F.coalesce("source", F.lit("")), F.lit('"')))
    body = docs.select(part.alias("file"), F.col("doc_id").alias("row"), F.posexplode(F.split(record, "\n")).alias("pos", "line"))
    header = docs.select(part.alias("file")).distinct().select(
        "file", F.lit(-1).alias("row"), F.lit(0).alias("pos"), F.lit("doc_id,text,lang,source").alias("line"))
    lines = body.unionByName(header)
    return lines.select("file", F.struct("row", F.floor(F.col("pos") / SPLIT_LINES).alias("block")).alias("split"),
                        F.col("pos").alias("at"), "line")


@query(r"""SELECT doc_id AS doc_ref, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256, lang,
  CAST(1 + length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS n_lines, 'from' || chr(10) || source AS origin,
  'loaded' AS status FROM documents""")
def staged_records(spark, sf):
    """Whole documents through staged files whose quoted fields hold line breaks."""
    rows = records(document_lines(spark, sf)).where("record > 0")
    loaded = staged.load_with_rejects(rows, [Pick("doc_ref", 1, "bigint"), Pick("body", 2), Pick("lang", 3), Pick("origin", 4)])
    body = F.coalesce("body", F.lit(""))
    return loaded.select(
        "doc_ref", F.char_length(body).cast("bigint").alias("n_chars"), F.sha2(body, 256).alias("text_sha256"), "lang",
        (F.size(F.split(body, "\n"))).cast("bigint").alias("n_lines"), "origin", "status")
