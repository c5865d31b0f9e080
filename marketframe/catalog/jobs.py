"""Queries of the whole-table jobs over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.screens import TICKERS
from marketframe.functions import contracts, currency, dates, values
from marketframe.operators import calendars, joins
from marketframe.plans import jobs
from marketframe.sources import adapters as A

UNIVERSE = f"""
SELECT row_id, ticker, CASE k WHEN 0 THEN 'Index' WHEN 1 THEN 'Index' WHEN 2 THEN 'Equity' WHEN 5 THEN 'Comdty' WHEN 7 THEN ticker ELSE 'Corp' END AS asset,
  CASE k WHEN 0 THEN 'ES' WHEN 1 THEN 'ES' WHEN 2 THEN 'SPY' WHEN 5 THEN 'UX' WHEN 3 THEN regexp_extract(ticker, '^(.+)[0-9]Y', 1)
    WHEN 6 THEN 'CDX EM CDSI GEN ' END AS prefix,
  CASE WHEN k IN (0, 2) THEN CAST(n AS BIGINT) WHEN k IN (3, 6) THEN 5 END AS index,
  CASE WHEN k = 2 THEN 'US' END AS exchange, k IN (1, 5) AS is_specific,
  CASE WHEN k IN (1, 5) THEN o_custkey % 12 + 1 END AS month, CASE k WHEN 1 THEN o_custkey % 100 WHEN 5 THEN CAST(n AS BIGINT) END AS year,
  CASE k WHEN 3 THEN 'CDX IG CDSI' WHEN 4 THEN 'CDX HY CDSI' WHEN 6 THEN 'CDX EM CDSI' END AS cdx_index,
  CASE WHEN k IN (3, 4) THEN concat('S', CAST(o_custkey % 50 + 1 AS VARCHAR)) WHEN k = 6 THEN 'GEN' END AS cdx_series,
  CASE WHEN k = 4 THEN CAST(n AS BIGINT) END AS cdx_version, CASE WHEN k IN (3, 6) THEN '5Y' WHEN k = 4 THEN '10Y' END AS cdx_tenor,
  k = 2 AS is_equity, CASE WHEN k = 7 THEN 'ticker does not parse' END AS reason
FROM (SELECT *, row_id % 8 AS k FROM {TICKERS} t)"""


@query("normalize_universe", f"""SELECT ticker, asset, prefix, index, exchange, is_specific, month, year, cdx_index, cdx_series, cdx_version,
cdx_tenor, is_equity FROM ({UNIVERSE}) WHERE reason IS NULL""")
def normalize_universe(spark, path):
    return jobs.accepted(jobs.normalize_universe(A.raw_instruments(spark, path)))


@query("normalize_universe_rejects", f"SELECT ticker, reason FROM ({UNIVERSE}) WHERE reason IS NOT NULL")
def normalize_universe_rejects(spark, path):
    return jobs.rejects(jobs.normalize_universe(A.raw_instruments(spark, path)), ["ticker"])


DATES = """
WITH r AS (SELECT o_orderkey AS row_id, o_orderkey % 11 AS k, o_custkey % 24 AS n, CAST(o_orderdate AS DATE) AS d,
  CASE o_orderkey % 11 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
    WHEN 6 THEN concat('-', CAST(o_custkey % 24 AS VARCHAR), 'd') WHEN 7 THEN concat(CAST(o_custkey % 24 AS VARCHAR), ':05')
    WHEN 8 THEN concat(lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0'), '30') WHEN 9 THEN '09:30-16:00' ELSE concat('2024-13-', CAST(o_custkey % 24 AS VARCHAR)) END AS text FROM orders)
SELECT row_id, text, CASE WHEN k < 6 THEN d END AS date, CASE WHEN k < 6 THEN strftime(d, '%Y%m%d') END AS compact,
  CASE WHEN k = 6 THEN TIMESTAMP '2024-06-01 12:00:00' - to_days(CAST(n AS INT)) END AS moved,
  CASE k WHEN 7 THEN concat(lpad(CAST(n AS VARCHAR), 2, '0'), ':05') WHEN 8 THEN concat(lpad(CAST(n AS VARCHAR), 2, '0'), ':30') END AS clock,
  CASE WHEN k = 9 THEN '09:30' END AS hours_start, CASE WHEN k = 9 THEN '16:00' END AS hours_end,
  CASE WHEN k = 10 THEN 'no date, offset or time' END AS reason FROM r"""


@query("normalize_dates", DATES)
def normalize_dates(spark, path):
    return jobs.normalize_dates(A.raw_dates(spark, path), "2024-06-01 12:00:00")


CLEAN = """
WITH r AS (SELECT o_orderkey AS row_id, 'F' AS field, o_orderkey % 8 AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p,
  CASE o_orderkey % 8 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN concat(' ', CAST(o_custkey AS VARCHAR), ',000') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 3 THEN 'Y' WHEN 4 THEN ' NaN ' WHEN 5 THEN concat(CAST(o_custkey AS VARCHAR), '.50') WHEN 6 THEN '  ' ELSE o_orderpriority END AS value FROM orders)
SELECT row_id, field, value, CASE k WHEN 0 THEN 'int64' WHEN 2 THEN 'date32' WHEN 3 THEN 'bool' WHEN 4 THEN 'null' WHEN 5 THEN 'float64' WHEN 6 THEN 'null' ELSE 'string' END AS dtype,
  CASE WHEN k NOT IN (4, 6) THEN trim(value) END AS cleaned,
  CASE k WHEN 0 THEN CAST(c AS DOUBLE) WHEN 1 THEN CAST(c * 1000 AS DOUBLE) WHEN 4 THEN 'nan'::DOUBLE WHEN 5 THEN c + 0.5::DOUBLE END AS amount,
  CASE WHEN k = 0 THEN c END AS whole, CASE WHEN k = 2 THEN d END AS as_date, CASE WHEN k = 3 THEN true END AS as_bool,
  CASE WHEN k IN (4, 6) THEN 'blank' END AS reason FROM r"""


@query("clean_values", f"SELECT row_id, field, value, dtype, cleaned, amount, whole, as_date, as_bool FROM ({CLEAN}) WHERE reason IS NULL")
def clean_values(spark, path):
    return jobs.accepted(jobs.clean_values(A.raw_values(spark, path)))


@query("clean_values_rejects", f"SELECT row_id, value, reason FROM ({CLEAN}) WHERE reason IS NOT NULL")
def clean_values_rejects(spark, path):
    return jobs.rejects(jobs.clean_values(A.raw_values(spark, path)), ["row_id", "value"])


@query("fx_terms", "SELECT ticker, crncy, pair, factor, needs_conversion FROM terms")
def fx_terms(spark, path):
    return jobs.fx_terms(A.ref_long(spark, path), "USD")


@query("trading_calendar", """
SELECT d.exchange, d.date, w.session,
  (CAST(concat(strftime(d.date, '%Y-%m-%d'), ' ', w.start_time, ':00') AS TIMESTAMP) AT TIME ZONE z.timezone) AT TIME ZONE 'UTC' AS start_utc,
  (CAST(concat(strftime(d.date, '%Y-%m-%d'), ' ', w.end_time, ':00') AS TIMESTAMP) AT TIME ZONE z.timezone) AT TIME ZONE 'UTC' AS end_utc,
  epoch(d.date + INTERVAL 12 HOUR) - epoch(((d.date + INTERVAL 12 HOUR) AT TIME ZONE z.timezone) AT TIME ZONE 'UTC')
    > least(epoch(make_timestamp(year(d.date), 1, 1, 12, 0, 0)) - epoch((make_timestamp(year(d.date), 1, 1, 12, 0, 0) AT TIME ZONE z.timezone) AT TIME ZONE 'UTC'),
            epoch(make_timestamp(year(d.date), 7, 1, 12, 0, 0)) - epoch((make_timestamp(year(d.date), 7, 1, 12, 0, 0) AT TIME ZONE z.timezone) AT TIME ZONE 'UTC')) AS is_dst
FROM exchange_days d JOIN zoned z ON z.exchange = d.exchange JOIN session_windows w ON w.exchange = d.exchange""")
def trading_calendar(spark, path):
    ex = calendars.with_sessions(joins.timezone_join(A.exchanges(spark, path)))
    return jobs.trading_calendar(ex, A.exchange_days(spark, path))


@query("wall_to_utc", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN concat(strftime(o_orderdate, '%Y-%m-%d'), 'T', h, ':30:00') ELSE concat(strftime(o_orderdate, '%Y-%m-%d'), 'T', h, ':30:00+02:00') END AS text,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate + to_minutes(CAST(o_custkey % 24 * 60 + 30 - 120 AS INT))
    WHEN u + g = l AND NOT (((u + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' = l) AND NOT (((u - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' = l) THEN u END AS utc
FROM (SELECT *, (l AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS u,
    ((l AT TIME ZONE 'America/New_York') AT TIME ZONE 'America/New_York') - ((l AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') AS g
  FROM (SELECT *, lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') AS h, o_orderdate + to_minutes(CAST(o_custkey % 24 * 60 + 30 AS INT)) AS l FROM orders))""")
def wall_to_utc(spark, path):
    o = A.table(spark, path, "orders")
    hour = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    zone = F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.lit("+02:00"))
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":30:00"), zone)
    rows = o.select("o_orderkey", text.alias("text"))
    return rows.withColumn("utc", dates.wall_to_utc(F.col("text"), F.lit("America/New_York")))


@query("add_minutes", """SELECT o_orderkey, printf('%02d:%02d', (o_custkey % 24), o_orderkey % 60) AS hhmm,
printf('%02d:%02d', ((o_custkey % 24 * 60 + o_orderkey % 60 - 330 + 1440) % 1440) // 60, (o_custkey % 24 * 60 + o_orderkey % 60 - 330 + 1440) % 60) AS moved FROM orders""")
def add_minutes(spark, path):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    o = A.table(spark, path, "orders")
    rows = o.select("o_orderkey", F.concat(two(F.col("o_custkey") % 24), F.lit(":"), two(F.col("o_orderkey") % 60)).alias("hhmm"))
    return rows.withColumn("moved", dates.add_minutes(F.col("hhmm"), -330))


@query("currency_pairs", """
SELECT l.ticker, l.crncy, CASE WHEN upper(l.crncy) = 'GBP' THEN '' ELSE concat('GBP', upper(l.crncy), ' Curncy') END AS pair,
  CASE WHEN upper(l.crncy) = 'GBP' THEN (CASE WHEN l.crncy = 'GBp' THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END) / 100 ELSE 1.0::DOUBLE END AS factor, 1.0::DOUBLE AS power FROM crncy l""")
def currency_pairs(spark, path):
    rows = joins.currency_lookup(A.ref_long(spark, path))
    p = currency.ccy_pair(F.col("crncy"), F.lit("GBp"))
    return rows.select("ticker", "crncy", p["ticker"].alias("pair"), p["factor"].alias("factor"), p["power"].alias("power"))


@query("dividend_type", """SELECT DISTINCT o_orderpriority AS kind, o_orderpriority AS field FROM orders
UNION SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'split' WHEN 'O' THEN 'all' ELSE 'gross' END,
CASE o_orderstatus WHEN 'F' THEN 'Eqy_DVD_Hist_Splits' WHEN 'O' THEN 'DVD_Hist_All' ELSE 'Eqy_DVD_Hist_Gross' END FROM orders""")
def dividend_type(spark, path):
    o = A.table(spark, path, "orders")
    status = F.when(F.col("o_orderstatus") == "F", F.lit("split")).when(F.col("o_orderstatus") == "O", F.lit("all")).otherwise(F.lit("gross"))
    rows = o.select(F.explode(F.array("o_orderpriority", status)).alias("kind")).distinct()
    return rows.withColumn("field", values.dividend_field(F.col("kind")))


@query("yield_type", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'ytw' WHEN 1 THEN 'Yield to Call' WHEN 2 THEN CAST(o_custkey % 12 AS VARCHAR) ELSE o_orderpriority END AS text,
CAST(CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN CASE WHEN o_custkey % 12 BETWEEN 1 AND 9 THEN o_custkey % 12 END END AS INTEGER) AS flag FROM orders""")
def yield_type(spark, path):
    o = A.table(spark, path, "orders")
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.lit("ytw")).when(k == 1, F.lit("Yield to Call")).when(k == 2, (F.col("o_custkey") % 12).cast("string")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", text.alias("text")).withColumn("flag", values.yield_flag(F.col("text")))


@query("replace_tenor", """SELECT o_orderkey, concat('CDX ', o_orderstatus, ' CDSI GEN ', t, ' Corp') AS ticker FROM orders, (VALUES ('3Y'), ('5Y'), ('7Y'), ('10Y')) x(t)
WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, concat('CDX ', o_orderstatus, ' CDSI GEN 6Y Corp') FROM orders WHERE o_orderkey % 3 = 0""")
def replace_tenor(spark, path):
    from marketframe import refdata

    tenor = F.when(F.col("o_orderkey") % 3 == 0, F.lit("6Y")).otherwise(F.lit("15Y"))
    t = F.concat(F.lit("CDX "), "o_orderstatus", F.lit(" CDSI GEN "), tenor, F.lit(" Corp"))
    return A.table(spark, path, "orders").select("o_orderkey", F.explode(contracts.tenor_tickers(t, refdata.CDX_CURVE_TENORS)).alias("ticker"))
