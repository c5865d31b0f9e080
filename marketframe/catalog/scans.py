"""Queries of the scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.tools import rounded
from marketframe.operators import aggregate, scan, shape
from marketframe.session import work_dir
from marketframe.sources import adapters as A
from marketframe.sources import store


def _wanted(spark, path):
    """Every traded ticker is requested; some the snapshot does not know."""
    li = A.table(spark, path, "lineitem")
    known = F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" US Equity"))
    unknown = F.concat(F.lit("Q"), F.col("l_suppkey").cast("string"), F.lit(" US Equity"))
    return li.select(F.explode(F.array(known, unknown)).alias("ticker")).distinct()


WANTED = """(SELECT DISTINCT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker FROM lineitem
  UNION SELECT DISTINCT concat('Q', CAST(l_suppkey AS VARCHAR), ' US Equity') FROM lineitem)"""


@query("ref_scan", f"""
SELECT w.ticker, f.field, r.value FROM (SELECT ticker FROM {WANTED} x WHERE ticker IN (SELECT ticker FROM ref_long)) w
CROSS JOIN (VALUES ('NAME'), ('SECTOR'), ('OPEN_INT'), ('NO_SUCH_FIELD')) f(field)
LEFT JOIN ref_long r ON r.ticker = w.ticker AND r.field = f.field
UNION ALL
SELECT ticker, '__SECURITY_ERROR__', 'Unknown security' FROM {WANTED} y WHERE ticker NOT IN (SELECT ticker FROM ref_long)""")
def ref_scan(spark, path):
    return scan.ref_scan(
        A.ref_long(spark, path), _wanted(spark, path), ["NAME", "SECTOR", "OPEN_INT", "NO_SUCH_FIELD"], include_errors=True
    )


@query("hist_scan", """
SELECT k.ticker, k.date, f.field, round(h.value, 6) AS value
FROM (SELECT DISTINCT ticker, date FROM hist_long WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31') k
CROSS JOIN (VALUES ('PX_LAST'), ('TURNOVER'), ('NO_SUCH_FIELD')) f(field)
LEFT JOIN hist_long h ON h.ticker = k.ticker AND h.date = k.date AND h.field = f.field""")
def hist_scan(spark, path):
    out = scan.hist_scan(
        A.hist_long(spark, path), None, ["PX_LAST", "TURNOVER", "NO_SUCH_FIELD"], "1997-01-01", "1999-12-31"
    )
    return rounded(out, "value")


def _actions(spark, path):
    """Corporate actions: a split or cash factor per part and year-end shipment."""
    li = A.table(spark, path, "lineitem")
    day = F.col("l_shipdate").cast("date")
    return li.groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(F.max(day).alias("date")).select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" US Equity")).alias("ticker"), "date",
        F.when(F.col("y") % 2 == 0, F.lit("split")).otherwise(F.lit("cash")).alias("kind"),
        F.when(F.col("y") % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.98)).alias("factor"),
    )


@query("hist_adjust", """
WITH acts AS (SELECT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker, max(CAST(l_shipdate AS DATE)) AS date,
  CASE WHEN year(l_shipdate) % 2 = 0 THEN 0.5::DOUBLE ELSE 0.98::DOUBLE END AS factor
  FROM lineitem GROUP BY l_partkey, year(l_shipdate))
SELECT h.ticker, h.date, round(max(h.px_last) * coalesce(product(a.factor), 1), 6) AS value
FROM hist_wide h LEFT JOIN acts a ON a.ticker = h.ticker AND a.date > h.date GROUP BY h.ticker, h.date""")
def hist_adjust(spark, path):
    prices = A.hist_wide(spark, path).select("ticker", "date", F.col("px_last").alias("value"))
    return rounded(scan.hist_adjust(prices, _actions(spark, path), "all"), "value")


@query("hist_adjust_split", """
WITH acts AS (SELECT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker, max(CAST(l_shipdate AS DATE)) AS date, 0.5::DOUBLE AS factor
  FROM lineitem GROUP BY l_partkey, year(l_shipdate) HAVING year(l_shipdate) % 2 = 0)
SELECT h.ticker, h.date, round(max(h.px_last) * coalesce(product(a.factor), 1), 6) AS value
FROM hist_wide h LEFT JOIN acts a ON a.ticker = h.ticker AND a.date > h.date GROUP BY h.ticker, h.date""")
def hist_adjust_split(spark, path):
    prices = A.hist_wide(spark, path).select("ticker", "date", F.col("px_last").alias("value"))
    return rounded(scan.hist_adjust(prices, _actions(spark, path), "split"), "value")


@query("bulk_scan", "SELECT ticker, field, payment_date, coupon, principal FROM cashflows WHERE field = 'DES_CASH_FLOW'")
def bulk_scan(spark, path):
    return scan.bulk_scan(A.cashflows(spark, path), None, "des_cash_flow")


BARS = """(SELECT ticker, time_bucket(INTERVAL '5 minutes', time) AS time, arg_min(value, {'t': time, 'e': event_id}) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, {'t': time, 'e': event_id}) AS close,
  CAST(sum(size) AS DOUBLE) AS volume, CAST(count(*) AS INTEGER) AS "numEvents"
  FROM ticks WHERE type = 'TRADE' GROUP BY ALL)"""


@query("bars_scan", f"""SELECT * FROM {BARS} WHERE time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'""")
def bars_scan(spark, path):
    bars = aggregate.bars_from_ticks(A.ticks(spark, path), 5)
    return scan.bars_scan(bars, None, start="2024-01-05 00:00:00", end="2024-01-20 23:59:59")


@query("bars_scan_day", f"""SELECT * FROM {BARS} WHERE time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 23:59:59'""")
def bars_scan_day(spark, path):
    return scan.bars_scan(aggregate.bars_from_ticks(A.ticks(spark, path), 5), None, dt="2024-01-10")


@query("ticks_scan", """SELECT * FROM ticks WHERE type IN ('TRADE', 'BID')
AND time BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00'""")
def ticks_scan(spark, path):
    return scan.ticks_scan(A.ticks(spark, path), None, "2024-01-03 00:00:00", "2024-01-25 12:00:00", ["TRADE", "BID"])


@query("quotes_scan", """SELECT ticker, time, type, value, size, event_id, CAST(NULL AS VARCHAR) AS "brokerBuyCode" FROM ticks
WHERE type IN ('BID', 'ASK') AND time BETWEEN TIMESTAMP '2024-01-18 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'""")
def quotes_scan(spark, path):
    return scan.quotes_scan(
        A.ticks(spark, path), None, as_of="2024-01-25 00:00:00", date_offset="-1w", extras=["event_id", "brokerBuyCode"]
    )


@query("field_catalog", "SELECT field, type, description, category FROM catalog_fields")
def field_catalog(spark, path):
    return scan.field_catalog(A.field_info(spark, path))


@query("portfolio_scan", "SELECT portfolio, holding AS \"ID\", weights FROM holdings WHERE portfolio = 'PF7'")
def portfolio_scan(spark, path):
    return scan.portfolio_scan(A.holdings(spark, path), "PF7", ["ID", "weights"])


@query("generic_request", """SELECT ticker, date, round(value, 6) AS value FROM hist_long
WHERE field IN ('PX_LAST', 'VOLUME') AND value > 1000""")
def generic_request(spark, path):
    out = scan.generic_request(
        A.hist_long(spark, path), {"field": ["PX_LAST", "VOLUME"]}, ["ticker", "date", "value"], F.col("value") > 1000
    )
    return rounded(out, "value")


@query("raw_json", """SELECT concat('{"p_partkey":', CAST(p_partkey AS VARCHAR), ',"p_name":"', p_name, '","p_size":', CAST(p_size AS VARCHAR), '}') AS json FROM part""")
def raw_json(spark, path):
    return shape.raw_json(A.table(spark, path, "part").select("p_partkey", "p_name", "p_size"))


@query("preview_json", """SELECT concat('{"o_orderkey":', CAST(o_orderkey AS VARCHAR), ',"o_orderpriority":"',
  CASE WHEN length(o_orderpriority) > 5 THEN concat(left(o_orderpriority, 5), '…') ELSE o_orderpriority END, '"}') AS json,
  length(o_orderpriority) > 5 AS truncated FROM orders ORDER BY o_orderkey LIMIT 50""")
def preview_json(spark, path):
    rows = A.table(spark, path, "orders").select("o_orderkey", "o_orderpriority")
    return shape.preview_json(rows, 50, 5, [F.col("o_orderkey")])


@query("bar_cache", f"""SELECT * FROM {BARS} WHERE time < TIMESTAMP '2024-01-20 00:00:00'""")
def bar_cache(spark, path):
    folder = work_dir(spark, "bar-cache")
    bars = aggregate.bars_from_ticks(A.ticks(spark, path), 5)
    store.bar_cache_write(bars, folder, "TRADE", "5m", as_of="2024-01-20 09:30:00")
    return store.bar_cache_read(spark, folder, "TRADE", "5m")
