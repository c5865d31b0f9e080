"""Queries of projection and shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.tools import rounded
from marketframe.operators import jsonq, shape
from marketframe.sources import adapters as A


@query("format_long", "SELECT ticker, field, CAST(value AS DOUBLE) AS value FROM ref_long WHERE field = 'OPEN_INT'")
def format_long(spark, path):
    return shape.format_long(A.ref_long(spark, path).where("field = 'OPEN_INT'"), {"OPEN_INT": "int64"})


@query("format_long_typed", """
SELECT ticker, field, CAST(NULL AS DOUBLE) AS value_f64, CASE WHEN field = 'OPEN_INT' THEN CAST(value AS BIGINT) END AS value_i64,
  CASE WHEN field <> 'OPEN_INT' THEN value END AS value_str, CAST(NULL AS BOOLEAN) AS value_bool, CAST(NULL AS DATE) AS value_date,
  CAST(NULL AS TIMESTAMP) AS value_ts FROM (SELECT * FROM ref_long WHERE field IN ('NAME', 'CRNCY', 'SECTOR', 'OPEN_INT')) r""")
def format_long_typed(spark, path):
    return shape.format_long_typed(A.ref_long(spark, path))


@query("format_long_metadata", """
SELECT ticker, field, value, CASE WHEN field = 'OPEN_INT' THEN 'int64' ELSE 'string' END AS dtype FROM ref_long""")
def format_long_metadata(spark, path):
    return shape.format_long_metadata(A.ref_long(spark, path))


@query("format_semi_long", """
SELECT ticker, date, round(max(CASE WHEN field = 'PX_LAST' THEN value END), 6) AS "PX_LAST",
  round(max(CASE WHEN field = 'TURNOVER' THEN value END), 6) AS "TURNOVER" FROM hist_long GROUP BY ticker, date""")
def format_semi_long(spark, path):
    out = shape.format_semi_long(A.hist_long(spark, path), ["ticker", "date"], ["PX_LAST", "TURNOVER"])
    return rounded(out, "PX_LAST", "TURNOVER")


def _positioned(spark, path):
    """Order lines as snapshot rows: many rows per cell, the position tells the last."""
    li = A.table(spark, path, "lineitem")
    return li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" US Equity")).alias("ticker"),
        F.concat(F.lit("F"), F.col("l_linenumber").cast("string")).alias("field"),
        F.when(F.col("l_returnflag") != "A", F.col("l_suppkey").cast("string")).alias("value"),
        (F.col("l_orderkey") * 1000 + F.col("l_suppkey")).alias("pos"),
    )


POSITIONED = """(SELECT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker, concat('F', CAST(l_linenumber AS VARCHAR)) AS field,
  CASE WHEN l_returnflag <> 'A' THEN CAST(l_suppkey AS VARCHAR) END AS value, l_orderkey * 1000 + l_suppkey AS pos FROM lineitem)"""


@query("pivot_to_wide", f"""
WITH lastrow AS (SELECT ticker, field, value FROM {POSITIONED} p
  QUALIFY row_number() OVER (PARTITION BY ticker, field ORDER BY pos DESC) = 1)
SELECT ticker, """ + ", ".join(
    f"max(CASE WHEN field = 'F{i}' THEN value END) AS \"F{i}\"" for i in range(1, 8)) + " FROM lastrow GROUP BY ticker")
def pivot_to_wide(spark, path):
    return shape.pivot_to_wide(_positioned(spark, path), [f"F{i}" for i in range(1, 8)])


@query("melt_snapshot", """
SELECT ticker, 'BRAND' AS field, p_brand AS value FROM (SELECT *, concat('P', CAST(p_partkey AS VARCHAR), ' US Equity') AS ticker FROM part) a
UNION ALL SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity'), 'SIZE', CAST(p_size AS VARCHAR) FROM part""")
def melt_snapshot(spark, path):
    p = A.table(spark, path, "part")
    fields = F.create_map(F.lit("BRAND"), F.col("p_brand"), F.lit("SIZE"), F.col("p_size").cast("string"))
    ticker = F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(" US Equity"))
    return shape.melt_snapshot(p.select(ticker.alias("ticker"), fields.alias("fields")))


@query("melt_history", """
SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS ticker, CAST(o_orderdate AS DATE) AS date, 'CUST' AS field, CAST(o_custkey AS VARCHAR) AS value FROM orders
UNION ALL SELECT concat('O', CAST(o_orderkey AS VARCHAR)), CAST(o_orderdate AS DATE) + 1, 'PRIO', o_orderpriority FROM orders""")
def melt_history(spark, path):
    o = A.table(spark, path, "orders")
    day = F.col("o_orderdate").cast("date")
    days = F.create_map(
        day, F.create_map(F.lit("CUST"), F.col("o_custkey").cast("string")),
        F.date_add(day, 1), F.create_map(F.lit("PRIO"), F.col("o_orderpriority")),
    )
    return shape.melt_history(o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("ticker"), days.alias("days")))


PANEL = "(SELECT CAST(l_shipdate AS DATE) AS date, l_partkey % 5 AS k, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)"


@query("melt_wide_panel", f"""
SELECT d.date, concat('K', CAST(g.k AS VARCHAR), ' US Equity') AS ticker, 'VOLUME' AS field, p.v AS value
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) d CROSS JOIN generate_series(0, 4) g(k)
LEFT JOIN {PANEL} p ON p.date = d.date AND p.k = g.k""")
def melt_wide_panel(spark, path):
    return shape.melt_wide_panel(A.wide_panel(spark, path))


@query("rename_dividend_columns", """SELECT ticker, field, dec_date, ex_date, pay_date, dvd_amt, dvd_type FROM dividends""")
def rename_dividend_columns(spark, path):
    bulk = A.dividends(spark, path)
    return shape.rename_dividend_columns(bulk.select("ticker", "field", F.inline("rows")))


@query("rename_etf_columns", """SELECT fund, portfolio, holding, id_isin, weights, position, sector, asset_class FROM holdings""")
def rename_etf_columns(spark, path):
    return shape.rename_etf_columns(A.holdings(spark, path))


@query("apply_column_renames", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal AS balance FROM supplier")
def apply_column_renames(spark, path):
    pairs = {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance", "absent": "x"}
    return shape.apply_column_renames(A.table(spark, path, "supplier"), pairs)


@query("order_columns", "SELECT ticker, time, type, value, size, event_id FROM ticks")
def order_columns(spark, path):
    return shape.order_columns(A.ticks(spark, path).select("event_id", "size", "value", "type", "time", "ticker"))


@query("earning_header_rename", "SELECT ticker, pos, level, fy2024 FROM segments")
def earning_header_rename(spark, path):
    data = A.segments(spark, path).withColumnRenamed("fy2024", "Period 1 Value")
    return shape.earning_header_rename(data, _header(spark, path))


def _header(spark, path):
    """One header row; the period follows the last order date."""
    last = A.table(spark, path, "orders").agg(F.max(F.year("o_orderdate")).alias("y"))
    return last.select(F.concat(F.lit("FY "), F.when(F.col("y") > 0, F.lit("2024"))).alias("Period 1 Header"))


@query("insert_after", "SELECT p_partkey, p_size, p_size * 2 AS double_size, p_brand FROM part")
def insert_after(spark, path):
    p = A.table(spark, path, "part").select("p_partkey", "p_size", "p_brand")
    return shape.insert_after(p, "p_size", "double_size", F.col("p_size") * 2)


@query("explode_columns", """
SELECT o_orderkey, a, b FROM orders, (SELECT 1)
, LATERAL (SELECT unnest(range(o_custkey % 3)) AS a UNION ALL SELECT NULL WHERE o_custkey % 3 = 0) x
, LATERAL (SELECT unnest(['x', o_orderpriority]) AS b) y""")
def explode_columns(spark, path):
    o = A.table(spark, path, "orders")
    n = F.col("o_custkey") % 3
    a = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("bigint"), n - 1))
    lists = o.select("o_orderkey", a.alias("a"), F.array(F.lit("x"), "o_orderpriority").alias("b"))
    return shape.explode_columns(lists, ["a", "b"])


@query("reshape_flat_quotes", """
SELECT event_id AS doc_id, CAST(0 AS BIGINT) AS idx, event_type AS type, regexp_extract(props, '[0-9]+', 0) AS size,
  CAST(NULL AS VARCHAR) AS "brokerBuyCode" FROM events
UNION ALL SELECT event_id, 1, 'BID', NULL, concat('B', CAST(event_id AS VARCHAR)) FROM events""")
def reshape_flat_quotes(spark, path):
    flat = jsonq.flatten_tree(A.tree_documents(spark, path), "json", ["doc_id"])
    return shape.reshape_flat_quotes(flat, ["doc_id"], ["type", "size", "brokerBuyCode"])


VENDOR_SQL = """CASE lower(trim(coalesce(c.type, ''))) WHEN 'double' THEN 'float64' WHEN 'real' THEN 'float64' WHEN 'price' THEN 'float64'
  WHEN 'int32' THEN 'int64' WHEN 'date' THEN 'date32' WHEN 'boolean' THEN 'bool' WHEN 'time' THEN 'timestamp' ELSE 'string' END"""


@query("resolve_field_types", f"""
SELECT f.field, CASE WHEN upper(f.field) = 'F5' THEN 'date32' WHEN c.field IS NOT NULL THEN {VENDOR_SQL} ELSE 'float64' END AS type
FROM (SELECT lower(field) AS field FROM catalog_fields UNION SELECT concat('unknown_', CAST(p_partkey AS VARCHAR)) FROM part) f
LEFT JOIN catalog_fields c ON upper(c.field) = upper(f.field)""")
def resolve_field_types(spark, path):
    from marketframe.operators.scan import field_catalog

    catalog = field_catalog(A.field_info(spark, path))
    extra = A.table(spark, path, "part").select(F.concat(F.lit("unknown_"), F.col("p_partkey").cast("string")).alias("field"))
    fields = catalog.select(F.lower("field").alias("field")).union(extra)
    return shape.resolve_field_types(fields, {"f5": "date32"}, catalog, "float64")


@query("vendor_type_map", f"SELECT c.field, c.type, {VENDOR_SQL} AS engine_type FROM catalog_fields c")
def vendor_type_map(spark, path):
    from marketframe.functions.values import engine_type
    from marketframe.operators.scan import field_catalog

    return field_catalog(A.field_info(spark, path)).select("field", "type", engine_type(F.col("type")).alias("engine_type"))


@query("coerce", """
SELECT o_orderkey, CAST(NULL AS DOUBLE) AS text_to_float, CAST(o_orderkey % 2 = 0 AS DOUBLE) AS bool_to_float,
  CAST(o_orderkey AS INTEGER) AS long_to_int, CAST(o_orderdate AS DATE) AS time_to_date,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date_to_time, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS time_to_text
FROM orders""")
def coerce(spark, path):
    from marketframe.functions.values import coerce as to

    o = A.table(spark, path, "orders")
    stamp = F.col("o_orderdate").cast("timestamp")
    return o.select(
        "o_orderkey", to(F.col("o_orderpriority"), "string", "float64").alias("text_to_float"),
        to(F.col("o_orderkey") % 2 == 0, "bool", "float64").alias("bool_to_float"),
        to(F.col("o_orderkey"), "int64", "int32").alias("long_to_int"),
        to(stamp, "timestamp", "date32").alias("time_to_date"),
        to(F.to_date(stamp), "date32", "timestamp").alias("date_to_time"),
        to(stamp, "timestamp", "string").alias("time_to_text"),
    )
