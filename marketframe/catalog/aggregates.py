"""Queries of aggregates, windows, orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.scans import BARS
from marketframe.catalog.shapes import POSITIONED, _positioned, _header
from marketframe.catalog.tools import rounded
from marketframe.operators import aggregate, joins
from marketframe.plans import recipes
from marketframe.sources import adapters as A


@query("bars_from_ticks", f"SELECT * FROM {BARS}")
def bars_from_ticks(spark, path):
    return aggregate.bars_from_ticks(A.ticks(spark, path), 5)


@query("bars_from_ticks_seconds", f"SELECT * FROM {BARS.replace('5 minutes', '90 seconds')}")
def bars_from_ticks_seconds(spark, path):
    return aggregate.bars_from_ticks(A.ticks(spark, path), 90, seconds=True)


@query("vwap", """SELECT ticker, round(sum(value * size) / nullif(sum(size), 0), 6) AS vwap, CAST(sum(size) AS BIGINT) AS volume,
round(sum(value * size), 6) AS turnover FROM ticks WHERE type = 'TRADE' AND CAST(time AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:00:00' GROUP BY ticker""")
def vwap(spark, path):
    return rounded(aggregate.vwap(A.ticks(spark, path), "09:30", "16:00"), "vwap", "turnover")


TURNOVER = """
WITH direct AS (SELECT ticker, date, value FROM hist_long WHERE field = 'TURNOVER'{where}),
fallback AS (SELECT a.ticker, a.date, a.value * b.value AS value FROM hist_long a JOIN hist_long b ON a.ticker = b.ticker AND a.date = b.date
  WHERE a.field = 'EQY_WEIGHTED_AVG_PX' AND b.field = 'VOLUME' AND a.ticker NOT IN (SELECT ticker FROM direct){where2}),
u AS (SELECT * FROM direct UNION ALL SELECT * FROM fallback)
SELECT u.ticker, u.date, 'TURNOVER' AS field, round((CASE WHEN f.value IS NOT NULL AND f.value <> 0 THEN u.value / (f.value * t.factor) ELSE u.value END) / 1000000, 6) AS value
FROM u LEFT JOIN terms t ON t.ticker = u.ticker LEFT JOIN fx_long f ON f.ticker = t.pair AND f.date = u.date"""


@query("turnover", TURNOVER.format(where="", where2=""))
def turnover(spark, path):
    return rounded(recipes.turnover(A.hist_long(spark, path), A.ref_long(spark, path), A.fx_long(spark, path)), "value")


@query("turnover_recent", TURNOVER.format(
    where=" AND date BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'", where2=" AND a.date BETWEEN DATE '1998-05-01' AND DATE '1998-05-31'"))
def turnover_recent(spark, path):
    out = recipes.turnover(
        A.hist_long(spark, path), A.ref_long(spark, path), A.fx_long(spark, path), as_of="1998-06-01")
    return rounded(out, "value")


LEVELS = """
WITH g AS (SELECT *, sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY pos) AS gid FROM segments),
s AS (SELECT *, sum(CASE WHEN level = 1 THEN fy2024 END) OVER (PARTITION BY ticker) AS s1,
  sum(CASE WHEN level = 2 THEN fy2024 END) OVER (PARTITION BY ticker, gid) AS s2 FROM g)
SELECT ticker, pos, level, fy2024, round(CASE WHEN level = 1 THEN 100 * fy2024 / nullif(s1, 0)
  WHEN level = 2 AND gid > 0 THEN 100 * fy2024 / nullif(s2, 0) END, 6) AS fy2024_pct FROM s"""


@query("level_percentages", LEVELS)
def level_percentages(spark, path):
    return rounded(aggregate.level_percentages(A.segments(spark, path), "fy2024"), "fy2024_pct")


@query("level_group_id", """SELECT ticker, pos, level, fy2024, CAST(sum(CASE WHEN level = 1 THEN 1 ELSE 0 END)
OVER (PARTITION BY ticker ORDER BY pos) AS BIGINT) AS gid FROM segments""")
def level_group_id(spark, path):
    return aggregate.level_group_id(A.segments(spark, path))


@query("earnings", LEVELS)
def earnings(spark, path):
    data = A.segments(spark, path).withColumnRenamed("fy2024", "Period 1 Value")
    return rounded(recipes.earnings(data, _header(spark, path)), "fy2024_pct")


@query("last_write_wins", f"""SELECT ticker, field, value FROM {POSITIONED} p
QUALIFY row_number() OVER (PARTITION BY ticker, field ORDER BY pos DESC) = 1""")
def last_write_wins(spark, path):
    return aggregate.last_write_wins(_positioned(spark, path), ["ticker", "field"], "pos")


@query("latest_point", """SELECT ticker, date, round(value, 6) AS value FROM hist_long WHERE field = 'PX_LAST' AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def latest_point(spark, path):
    out = aggregate.latest_point(A.hist_long(spark, path), "px_last", F.lit("1998-12-31").cast("date"), 364)
    return rounded(out, "value")


@query("latest_points", """WITH pts AS (SELECT DISTINCT ticker, last_day(date + 60) AS dt FROM hist_long WHERE field = 'VOLUME')
SELECT p.ticker, p.dt, CASE WHEN v.date >= p.dt - 120 THEN v.date END AS date, CASE WHEN v.date >= p.dt - 120 THEN round(v.value, 6) END AS value
FROM pts p ASOF LEFT JOIN (SELECT * FROM hist_long WHERE field = 'PX_LAST') v ON v.ticker = p.ticker AND p.dt >= v.date""")
def latest_points(spark, path):
    hist = A.hist_long(spark, path)
    points = hist.where("field = 'VOLUME'").select("ticker", F.last_day(F.date_add("date", 60)).alias("dt")).distinct()
    return rounded(aggregate.latest_points(points, hist, "px_last", 120), "value")


@query("first_seen_distinct", f"SELECT field, min(pos) AS first_pos FROM {POSITIONED} p GROUP BY field")
def first_seen_distinct(spark, path):
    return aggregate.first_seen_distinct(_positioned(spark, path), "field", "pos")


@query("date_span", "SELECT min(date) AS start, max(date) AS end FROM hist_wide")
def date_span(spark, path):
    return aggregate.date_span(A.hist_wide(spark, path), "1990-01-01", "2030-01-01")


@query("periodicity", """SELECT ticker, field, CAST(date_trunc('quarter', date) AS DATE) AS period, date, round(value, 6) AS value FROM hist_long
QUALIFY row_number() OVER (PARTITION BY ticker, field, date_trunc('quarter', date) ORDER BY date DESC) = 1""")
def periodicity(spark, path):
    return rounded(aggregate.periodicity(A.hist_long(spark, path), "Q"), "value")


@query("periodicity_weekly", """SELECT ticker, CAST(date_trunc('week', date) AS DATE) AS period, date, round(px_last, 6) AS px_last, volume FROM hist_wide
QUALIFY row_number() OVER (PARTITION BY ticker, date_trunc('week', date) ORDER BY date DESC) = 1""")
def periodicity_weekly(spark, path):
    h = A.hist_wide(spark, path).select("ticker", "date", "px_last", "volume")
    return rounded(aggregate.periodicity(h, "W"), "px_last")


FILLED = """
WITH p AS (SELECT ticker, date, px_last, lead(date) OVER (PARTITION BY ticker ORDER BY date) AS nxt FROM hist_wide),
f AS (SELECT ticker, CAST(day AS DATE) AS date, CASE WHEN {keep} THEN px_last END AS value
  FROM (SELECT ticker, px_last, date, unnest(range(date, coalesce(nxt, date + 1)::DATE, INTERVAL 1 DAY)) AS day FROM p))"""


@query("fill_forward", FILLED.format(keep="true") + """
SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS period, max(date) AS date, round(max_by(value, date), 6) AS value
FROM f GROUP BY ticker, date_trunc('month', date)""")
def fill_forward(spark, path):
    """Every calendar day filled, then sampled at month ends."""
    h = A.hist_wide(spark, path).select("ticker", "date", F.col("px_last").alias("value"))
    return rounded(aggregate.periodicity(aggregate.fill_forward(h, keys=["ticker"]), "M"), "value")


@query("fill_forward_weekdays", FILLED.format(keep="CAST(day AS DATE) = date") + """
SELECT ticker, CAST(year(date) AS INTEGER) AS year, count(*) AS days, count(value) AS points FROM f WHERE isodow(date) < 6 GROUP BY ticker, year(date)""")
def fill_forward_weekdays(spark, path):
    """Weekdays per ticker and year, and how many of them have a point of their own."""
    h = A.hist_wide(spark, path).select("ticker", "date", F.col("px_last").alias("value"))
    filled = aggregate.fill_forward(h, days="W", fill="N", keys=["ticker"])
    return filled.groupBy("ticker", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("days"), F.count("value").alias("points"))


@query("group_sum", "SELECT underlying, put_call, CAST(sum(open_int) AS BIGINT) AS sum_open_int FROM options WHERE moneyness <= 1 GROUP BY underlying, put_call")
def group_sum(spark, path):
    return aggregate.group_sum(A.options(spark, path).where("moneyness <= 1"), ["underlying", "put_call"], "open_int")


@query("sort_by_maturity", "SELECT contract, last_trade_date, gen_ticker FROM chain ORDER BY last_trade_date, contract")
def sort_by_maturity(spark, path):
    return aggregate.sort_by_maturity(A.chain(spark, path).select("contract", "last_trade_date", "gen_ticker"), "last_trade_date", "contract")


@query("latest_first", """SELECT ticker, date, round(px_last, 6) AS px_last, volume FROM hist_wide QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1""")
def latest_first(spark, path):
    h = A.hist_wide(spark, path).select("ticker", "date", "px_last", "volume")
    return rounded(aggregate.latest_first(h, ["ticker"]), "px_last")


@query("argmax_volume", """
WITH v AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS f, sum(CASE WHEN l_returnflag = 'N' AND l_suppkey % 9 <> 0 THEN l_quantity END) AS s
  FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, CASE WHEN s > f OR (f IS NULL AND s IS NOT NULL) THEN 'second' ELSE 'front' END AS contract FROM v""")
def argmax_volume(spark, path):
    li = A.table(spark, path, "lineitem")
    q, flag = F.col("l_quantity"), F.col("l_returnflag")
    v = li.groupBy("l_suppkey").agg(
        F.sum(F.when(flag == "A", q)).alias("f"), F.sum(F.when((flag == "N") & (F.col("l_suppkey") % 9 != 0), q)).alias("s"))
    return v.select("l_suppkey", aggregate.argmax_volume(F.lit("front"), F.lit("second"), F.col("f"), F.col("s")).alias("contract"))


@query("max_results", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def max_results(spark, path):
    e = A.table(spark, path, "events").select("event_id", "value")
    return aggregate.max_results(e, [F.col("value").desc(), F.col("event_id")], 100)


@query("row_cap", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def row_cap(spark, path):
    o = A.table(spark, path, "orders").select("o_orderkey", "o_totalprice")
    return aggregate.max_results(o, [F.col("o_orderkey")], 25)


@query("append_rows", """SELECT ticker, field, value FROM ref_long UNION ALL SELECT ticker, field, value FROM cdx_ref""")
def append_rows(spark, path):
    return aggregate.append_rows(A.ref_long(spark, path), A.cdx_ref(spark, path))


@query("topics_add", "SELECT DISTINCT concat('U', CAST(user_id AS VARCHAR)) AS topic FROM events WHERE event_type IN ('click', 'view')")
def topics_add(spark, path):
    e = A.payload_messages(spark, path).join(A.table(spark, path, "events").select("event_id", "event_type"), "event_id")
    return aggregate.topics_add(e.where("event_type = 'click'"), e.where("event_type = 'view'"))


@query("topics_remove", """SELECT DISTINCT concat('C', CAST(c_custkey AS VARCHAR)) AS topic FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def topics_remove(spark, path):
    active = A.table(spark, path, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("topic"))
    gone = A.table(spark, path, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("topic"))
    return aggregate.topics_remove(active, gone)


@query("dividend", """SELECT ticker, field, dec_date, ex_date, pay_date, dvd_amt, dvd_type FROM dividends WHERE field = 'DVD_Hist_All'
AND contains(ticker, 'Equity') AND NOT contains(ticker, '=') AND ex_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def dividend(spark, path):
    return recipes.dividend(A.dividends(spark, path), None, "all", "1996-01-01", "1999-12-31")


@query("etf_holdings", "SELECT fund, holding, id_isin, weights, position, sector FROM holdings")
def etf_holdings(spark, path):
    return recipes.etf_holdings(A.holdings(spark, path), None, ["Sector"])


@query("yas", """SELECT DISTINCT concat('B', CAST(c_custkey AS VARCHAR), ' Corp') AS ticker, 'YAS_BOND_YLD' AS field, CAST(c_nationkey AS VARCHAR) AS value
FROM customer WHERE c_custkey % 9 + 1 = 5""")
def yas(spark, path):
    c = A.table(spark, path, "customer")
    ref = c.select(
        F.concat(F.lit("B"), F.col("c_custkey").cast("string"), F.lit(" Corp")).alias("ticker"), F.lit("YAS_BOND_YLD").alias("field"),
        F.col("c_nationkey").cast("string").alias("value"), (F.col("c_custkey") % 9 + 1).cast("string").alias("YAS_YLD_FLAG"))
    return recipes.yas(ref, c.select(F.concat(F.lit("B"), F.col("c_custkey").cast("string"), F.lit(" Corp")).alias("ticker")), yield_type=5)
