"""Queries of filters, screens and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.tools import rounded
from marketframe.operators import calendars, joins, predicates, scan
from marketframe.sources import adapters as A


@query("filter_tickers", """SELECT ticker, date, field, round(value, 6) AS value FROM hist_long
WHERE ticker IN (SELECT ticker FROM ref_long WHERE field = 'SECTOR')""")
def filter_tickers(spark, path):
    with_sector = A.ref_long(spark, path).where("field = 'SECTOR'")
    return rounded(predicates.filter_tickers(A.hist_long(spark, path), with_sector), "value")


@query("filter_fields", "SELECT ticker, field, value FROM ref_long WHERE field IN ('CRNCY', 'SECTOR')")
def filter_fields(spark, path):
    return predicates.filter_fields(A.ref_long(spark, path), ["crncy", "Sector"])


@query("date_range", "SELECT ticker, date, round(px_last, 6) AS px_last FROM hist_wide WHERE date BETWEEN DATE '1996-02-01' AND DATE '2000-02-29'")
def date_range(spark, path):
    h = A.hist_wide(spark, path).select("ticker", "date", "px_last")
    return rounded(scan.date_range(h, "1996-02-01", "2000-02-29"), "px_last")


def _ticker_exchange(spark, path):
    """Each quoted user trades on the exchange of the supplier with the same number."""
    ex = calendars.with_sessions(joins.timezone_join(A.exchanges(spark, path)))
    users = A.ticks(spark, path).select("ticker").distinct()
    number = F.regexp_extract("ticker", r"[0-9]+", 0).cast("bigint") % 100
    return users.withColumn("exchange", F.concat(F.lit("X"), number.cast("string"))).join(
        ex.select("exchange", "timezone", "sessions"), "exchange"
    ).select("ticker", "timezone", "sessions")


SESSION_SQL = """
WITH b AS (SELECT z.exchange, z.timezone, {a} AS a, {b} AS b FROM zoned z JOIN (SELECT exchange,
    (a + 1440) % 1440 AS a, (b + 1440) % 1440 AS b FROM session_minutes WHERE session = '{session}') w USING (exchange)),
loc AS (SELECT t.*, b.a, b.b, (t.time AT TIME ZONE 'UTC') AT TIME ZONE b.timezone AS l FROM ticks t
  JOIN b ON b.exchange = concat('X', CAST(CAST(regexp_extract(t.ticker, '[0-9]+', 0) AS BIGINT) % 100 AS VARCHAR))),
m AS (SELECT *, hour(l) * 60 + minute(l) + second(l) / 60 AS minute FROM loc)
SELECT ticker, time, type, value, size, event_id FROM m
WHERE CASE WHEN a <= b THEN minute BETWEEN a AND b ELSE minute >= a OR minute <= b END"""


@query("session_filter", SESSION_SQL.format(session="day", a="w.a", b="w.b"))
def session_filter(spark, path):
    return predicates.session_filter(A.ticks(spark, path), "day", _ticker_exchange(spark, path))


@query("session_filter_open", SESSION_SQL.format(session="allday", a="w.a", b="(w.a + 90) % 1440"))
def session_filter_open(spark, path):
    return predicates.session_filter(A.ticks(spark, path), "allday_open_90", _ticker_exchange(spark, path))


@query("session_filter_normal", SESSION_SQL.format(session="day", a="(w.a + 30) % 1440", b="(w.b - 20 + 1440) % 1440"))
def session_filter_normal(spark, path):
    return predicates.session_filter(A.ticks(spark, path), "day_normal_30_20", _ticker_exchange(spark, path))


@query("session_filter_close", SESSION_SQL.format(session="am", a="(w.b - 60 + 1440) % 1440", b="w.b"))
def session_filter_close(spark, path):
    return predicates.session_filter(A.ticks(spark, path), "am_close_60", _ticker_exchange(spark, path))


@query("session_filter_exact", SESSION_SQL.format(session="allday", a="1290", b="150"))
def session_filter_exact(spark, path):
    return predicates.session_filter(A.ticks(spark, path), "allday_exact_2130_0230", _ticker_exchange(spark, path))


@query("equity_filter", """SELECT DISTINCT ticker FROM dividends WHERE contains(ticker, 'Equity') AND NOT contains(ticker, '=')""")
def equity_filter(spark, path):
    return predicates.equity_filter(A.dividends(spark, path)).select("ticker").distinct()


@query("valid_contracts", """SELECT ticker, maturity, CAST(TRY_CAST(maturity AS DATE) AS DATE) AS expiry FROM maturities
WHERE TRY_CAST(maturity AS DATE) > DATE '1998-06-15'""")
def valid_contracts(spark, path):
    return predicates.valid_contracts(A.maturities(spark, path), F.lit("1998-06-15").cast("date"))


@query("cycle_filter", "SELECT contract, last_trade_date, CAST(month(last_trade_date) AS INTEGER) AS month FROM chain WHERE month(last_trade_date) IN (3, 6, 9, 12)")
def cycle_filter(spark, path):
    c = A.chain(spark, path).select("contract", "last_trade_date", F.month("last_trade_date").alias("month"))
    return predicates.cycle_filter(c, "hmuz")


TICKERS = """(SELECT o_orderkey AS row_id, o_custkey, CASE o_orderkey % 8 WHEN 0 THEN concat('ES', n, ' Index')
  WHEN 1 THEN concat('ES', code, lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0'), ' Index') WHEN 2 THEN concat('SPY', n, ' US Equity')
  WHEN 3 THEN concat('CDX IG CDSI S', CAST(o_custkey % 50 + 1 AS VARCHAR), ' 5Y Corp')
  WHEN 4 THEN concat('CDX HY CDSI S', CAST(o_custkey % 50 + 1 AS VARCHAR), ' V', n, ' 10Y Corp')
  WHEN 5 THEN concat('UX', code, n, ' Comdty') WHEN 6 THEN 'CDX EM CDSI GEN 5Y Corp'
  ELSE concat('JUNK=', CAST(o_custkey AS VARCHAR)) END AS ticker, code, n
  FROM (SELECT *, substr('FGHJKMNQUVXZ', CAST(o_custkey % 12 + 1 AS INT), 1) AS code, CAST(o_custkey % 9 + 1 AS VARCHAR) AS n FROM orders))"""


@query("is_specific_contract", f"SELECT row_id, ticker, row_id % 8 IN (1, 5) AS is_specific FROM {TICKERS} t")
def is_specific_contract(spark, path):
    return predicates.is_specific_contract(A.raw_instruments(spark, path))


@query("validate_generic", f"""SELECT row_id, ticker, CASE WHEN row_id % 8 IN (1, 5)
THEN concat('''', ticker, ''' is a specific contract; a generic ticker is required') END AS error FROM {TICKERS} t""")
def validate_generic(spark, path):
    return predicates.validate_generic(A.raw_instruments(spark, path))


@query("option_screen_filter", """SELECT id, strike_px, expire_dt, ivol, delta, open_int, px_last, px_bid, px_ask FROM options
WHERE put_call = 'Call' AND expire_dt BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND strike_px >= 100 AND strike_px <= 400
AND delta >= 0.1 AND ivol <= 0.08 AND moneyness <= 1.5 AND open_int >= 10 AND px_volume >= 1 AND px_bid >= 100 AND px_ask <= 50000
AND exch_code = 'LN' AND exercise_type = 'European' AND vega > 0.11""")
def option_screen_filter(spark, path):
    return predicates.option_screen_filter(
        A.options(spark, path), put_call="C", expiry=(F.lit("1996-01-01").cast("date"), F.lit("2000-12-31").cast("date")),
        strike_px=(100, 400), delta=(0.1, None), ivol=(None, 0.08), moneyness=(None, 1.5), min_open_int=10, min_volume=1,
        min_bid=100, max_ask=50000, exch_code="LN", exercise_type="European", extra="vega > 0.11",
    )


@query("option_chain_atm", """SELECT DISTINCT id, underlying, expire_dt, put_call, strike_px FROM (SELECT DISTINCT id, underlying, expire_dt, put_call, strike_px, undl_px FROM options) o
QUALIFY row_number() OVER (PARTITION BY underlying, expire_dt, put_call ORDER BY abs(strike_px - undl_px), strike_px, id) <= 2""")
def option_chain_atm(spark, path):
    cols = ["id", "underlying", "expire_dt", "put_call", "strike_px"]
    opts = A.options(spark, path).select(*cols, "undl_px").distinct()
    return predicates.option_chain(opts, strike="ATM", points=2).select(*cols)


@query("option_chain_closest", """WITH near AS (SELECT underlying, arg_min(expire_dt, {'d': abs(expire_dt - DATE '1998-03-20'), 'e': expire_dt}) AS n
  FROM options WHERE put_call = 'Put' GROUP BY underlying)
SELECT o.id, o.underlying, o.expire_dt, o.strike_px FROM options o JOIN near ON near.underlying = o.underlying AND o.expire_dt = near.n
WHERE o.put_call = 'Put'""")
def option_chain_closest(spark, path):
    out = predicates.option_chain(A.options(spark, path), put_call="P", expiry="1998-03-20", expiry_match="C")
    return out.select("id", "underlying", "expire_dt", "strike_px")


@query("option_chain_monthly", """SELECT id, underlying, expire_dt, strike_px FROM options
WHERE isodow(expire_dt) = 5 AND day(expire_dt) BETWEEN 15 AND 21 AND exercise_type = 'American'""")
def option_chain_monthly(spark, path):
    out = predicates.option_chain(A.options(spark, path), periodicity="M", exercise="American")
    return out.select("id", "underlying", "expire_dt", "strike_px")


@query("preferreds", """SELECT id, name, crncy FROM bonds WHERE issuer = 'BUILDING US Equity' AND asset_class = 'Preferreds'
QUALIFY row_number() OVER (PARTITION BY consolidated_id ORDER BY id) = 1""")
def preferreds(spark, path):
    return predicates.preferreds(A.bonds(spark, path), "BUILDING", ["crncy", "NAME"])


@query("corporate_bonds", """SELECT id, name, maturity FROM bonds WHERE issuer = 'MACHINERY US Equity' AND asset_class = 'Corporates'
AND crncy = 'USD' AND maturity > DATE '2001-06-30'""")
def corporate_bonds(spark, path):
    return predicates.corporate_bonds(
        A.bonds(spark, path), "MACHINERY US Equity", fields=["maturity"], active_only=True, as_of="2001-06-30"
    )


@query("instrument_search", """SELECT ticker, name, score FROM (SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity') AS ticker, p_name AS name,
  CASE WHEN starts_with(lower(concat('P', CAST(p_partkey AS VARCHAR), ' US Equity')), 'red') THEN 0 WHEN starts_with(p_name, 'red') THEN 1 ELSE 2 END AS score
  FROM part WHERE contains(lower(p_name), 'red') OR contains(lower(concat('P', CAST(p_partkey AS VARCHAR), ' US Equity')), 'red'))
ORDER BY score, ticker LIMIT 20""")
def instrument_search(spark, path):
    instruments = A.table(spark, path, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(" US Equity")).alias("ticker"), F.col("p_name").alias("name"))
    return predicates.instrument_search(instruments, "RED", "Equity")


def _curves(spark, path):
    c = A.table(spark, path, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("YC"), key.cast("string")).alias("curveid"), F.col("c_mktsegment").alias("type"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("country"),
        F.when(key % 2 == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("currency"),
    )


@query("curve_search", """SELECT concat('YC', CAST(c_custkey AS VARCHAR)) AS curveid, c_mktsegment AS type, concat('C', CAST(c_nationkey AS VARCHAR)) AS country,
  'USD' AS currency FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING'""")
def curve_search(spark, path):
    return predicates.curve_search(_curves(spark, path), currency="USD", type="BUILDING", country=None)


@query("govt_search", """SELECT concat('T', CAST(c_custkey AS VARCHAR), ' Govt') AS ticker, c_name AS name FROM customer
WHERE starts_with(concat('T', CAST(c_custkey AS VARCHAR), ' Govt'), 'T12')""")
def govt_search(spark, path):
    govts = A.table(spark, path, "customer").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string"), F.lit(" Govt")).alias("ticker"), F.col("c_name").alias("name"))
    return predicates.govt_search(govts, "t12")


@query("govt_search_exact", """SELECT concat('T', CAST(c_custkey AS VARCHAR), ' Govt') AS ticker, c_name AS name FROM customer WHERE c_custkey = 12""")
def govt_search_exact(spark, path):
    govts = A.table(spark, path, "customer").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string"), F.lit(" Govt")).alias("ticker"), F.col("c_name").alias("name"))
    return predicates.govt_search(govts, "t12 govt", partial=False)


def _screens():
    s = predicates.Screens()
    s.save("Cheap and liquid", "px_last < 3000 AND volume > 10")
    s.save("FI:MATURING", "crncy = :ccy AND maturity < date'2002-01-01'", "Search")
    return s


@query("screen", "SELECT ticker, date, round(px_last, 6) AS px_last, volume FROM hist_wide WHERE date = DATE '1998-05-08' AND px_last < 3000 AND volume > 10")
def screen(spark, path):
    h = A.hist_wide(spark, path).select("ticker", "date", "px_last", "volume")
    return rounded(predicates.screen(h, _screens(), "Cheap and liquid", as_of="1998-05-08"), "px_last")


@query("search", "SELECT id, name, crncy, maturity FROM bonds WHERE crncy = 'EUR' AND maturity < DATE '2002-01-01'")
def search(spark, path):
    return predicates.search(A.bonds(spark, path), _screens(), "FI:MATURING", ccy="EUR").select("id", "name", "crncy", "maturity")


@query("field_search", """SELECT field, type, description, category FROM catalog_fields
WHERE contains(lower(field), 'bolt') OR contains(lower(description), 'bolt')""")
def field_search(spark, path):
    return predicates.field_search(scan.field_catalog(A.field_info(spark, path)), "Bolt")
