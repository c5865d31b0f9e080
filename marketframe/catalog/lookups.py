"""Queries of the lookups: currencies, rates, rules, zones, exchange facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.tools import half_up, rounded
from marketframe.operators import calendars, joins, scan
from marketframe.plans import recipes
from marketframe.sources import adapters as A


@query("security_field_scaffold", """
SELECT t.ticker, f.field, CAST(f.pos AS INTEGER) AS pos, r.value
FROM (SELECT DISTINCT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker FROM lineitem) t
CROSS JOIN (VALUES (0, 'SECTOR'), (1, 'NAME')) f(pos, field) LEFT JOIN ref_long r ON r.ticker = t.ticker AND r.field = f.field""")
def security_field_scaffold(spark, path):
    tickers = A.hist_wide(spark, path).select("ticker").distinct()
    return joins.security_field_scaffold(A.ref_long(spark, path), tickers, ["SECTOR", "NAME"])


@query("currency_lookup", "SELECT ticker, crncy FROM crncy")
def currency_lookup(spark, path):
    return joins.currency_lookup(A.ref_long(spark, path))


FX_LONG = """
SELECT h.ticker, h.date, h.field, round({value}, 6) AS value FROM hist_long h LEFT JOIN terms t ON t.ticker = h.ticker
LEFT JOIN fx_long f ON f.ticker = t.pair AND f.date = h.date"""


@query("fx_join_long", FX_LONG.format(
    value="CASE WHEN f.value IS NOT NULL AND f.value <> 0 THEN h.value / (f.value * t.factor) ELSE h.value END"))
def fx_join_long(spark, path):
    out = joins.fx_join_long(A.hist_long(spark, path), A.ref_long(spark, path), A.fx_long(spark, path), "USD")
    return rounded(out, "value")


@query("fx_join_long_null", FX_LONG.format(
    value="CASE WHEN f.value IS NOT NULL AND f.value <> 0 THEN h.value / (f.value * t.factor) WHEN t.pair IS NULL THEN h.value END"))
def fx_join_long_null(spark, path):
    out = joins.fx_join_long(A.hist_long(spark, path), A.ref_long(spark, path), A.fx_long(spark, path), "USD", "null")
    return rounded(out, "value")


@query("fx_join_wide", """
SELECT CAST(l_shipdate AS DATE) AS date, round(sum(CASE WHEN l_partkey % 5 = 0 THEN l_quantity END), 6) AS "K0 US Equity|VOLUME",
  round(sum(CASE WHEN l_partkey % 5 = 1 THEN l_quantity END) / max(g.value), 6) AS "K1 US Equity|VOLUME",
  round(sum(CASE WHEN l_partkey % 5 = 2 THEN l_quantity END) / (max(g.value) * 100), 6) AS "K2 US Equity|VOLUME",
  round(sum(CASE WHEN l_partkey % 5 = 3 THEN l_quantity END), 6) AS "K3 US Equity|VOLUME",
  round(sum(CASE WHEN l_partkey % 5 = 4 THEN l_quantity END) / max(j.value), 6) AS "K4 US Equity|VOLUME", count(*) AS value
FROM lineitem
LEFT JOIN fx_long g ON g.ticker = 'USDGBP Curncy' AND g.date = CAST(l_shipdate AS DATE) AND g.value <> 0
LEFT JOIN fx_long j ON j.ticker = 'USDJPY Curncy' AND j.date = CAST(l_shipdate AS DATE) AND j.value <> 0
GROUP BY CAST(l_shipdate AS DATE)""")
def fx_join_wide(spark, path):
    out = joins.fx_join_wide(A.wide_panel(spark, path), A.panel_ref(spark, path), A.fx_long(spark, path), "USD")
    return out.select("date", *[half_up(F.col(f"`K{i} US Equity|VOLUME`"), 6).alias(f"K{i} US Equity|VOLUME") for i in range(5)], "value")


@query("currency_series", """
SELECT h.ticker, h.date, h.field, round(CASE WHEN f.value <> 0 THEN h.value / (f.value * t.factor) ELSE h.value END, 6) AS value
FROM hist_long h JOIN terms t ON t.ticker = h.ticker LEFT JOIN fx_long f ON f.ticker = t.pair AND f.date = h.date
WHERE h.ticker = 'P7 US Equity'""")
def currency_series(spark, path):
    out = joins.currency_series(
        A.hist_long(spark, path), A.ref_long(spark, path), A.fx_long(spark, path), "P7 US Equity", "USD")
    return rounded(out, "value")


@query("missing_tickers", """SELECT DISTINCT ticker FROM ref_long WHERE ticker NOT IN (SELECT ticker FROM hist_long WHERE field = 'TURNOVER')""")
def missing_tickers(spark, path):
    wanted = A.ref_long(spark, path).select("ticker").distinct()
    return joins.missing_tickers(wanted, A.hist_long(spark, path).where("field = 'TURNOVER'"))


@query("validate_fields", """SELECT concat('F', CAST(p_partkey AS VARCHAR)) AS field FROM part
WHERE concat('F', CAST(p_partkey AS VARCHAR)) NOT IN (SELECT upper(field) FROM catalog_fields)""")
def validate_fields(spark, path):
    asked = A.table(spark, path, "part").select(F.concat(F.lit("F"), F.col("p_partkey").cast("string")).alias("field"))
    return joins.validate_fields(asked, scan.field_catalog(A.field_info(spark, path)), "lenient")


@query("vwap_volume_self_join", """SELECT a.ticker, a.date, round(a.value, 6) AS vwap, b.value AS volume
FROM hist_long a JOIN hist_long b ON a.ticker = b.ticker AND a.date = b.date
WHERE a.field = 'EQY_WEIGHTED_AVG_PX' AND b.field = 'VOLUME'""")
def vwap_volume_self_join(spark, path):
    return rounded(joins.vwap_volume_self_join(A.hist_long(spark, path)), "vwap")


@query("market_rule_join", """SELECT exchange, CAST(pre AS INTEGER) AS pre_minutes, CAST(post AS INTEGER) AS post_minutes, l1 AS lunch_start_min,
  l2 AS lunch_end_min, cont AS is_continuous FROM ruled""")
def market_rule_join(spark, path):
    return joins.market_rule_join(A.exchanges(spark, path)).select(
        "exchange", *[F.col(f"rule.{c}").alias(c) for c in (
            "pre_minutes", "post_minutes", "lunch_start_min", "lunch_end_min", "is_continuous")])


@query("timezone_join", "SELECT exchange, timezone, tz_source FROM zoned")
def timezone_join(spark, path):
    return joins.timezone_join(A.exchanges(spark, path)).select("exchange", "timezone", "tz_source")


@query("infer_timezone", """SELECT exchange, country, (SELECT zone FROM country_zones z WHERE z.country = e.country) AS zone FROM exchanges e""")
def infer_timezone(spark, path):
    return A.exchanges(spark, path).select("exchange", "country", joins.infer_timezone(F.lower("country")).alias("zone"))


def _layers(spark, path):
    c = A.table(spark, path, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"), "c_custkey",
        F.concat(F.lit("Z"), F.col("c_nationkey").cast("string")).alias("timezone"), F.col("c_mktsegment").alias("mic"))
    over = c.where("c_custkey % 5 = 0").withColumn("timezone", F.lit(None).cast("string")).withColumn("mic", F.lit("OVER"))
    cached = c.where("c_custkey % 3 = 0").withColumn("mic", F.lit("CACHE"))
    source = c.where("c_custkey % 2 = 0")
    return c.select("ticker"), over, cached, source


@query("exchange_resolve", """
SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS ticker,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN concat('Z', CAST(c_nationkey AS VARCHAR)) END AS timezone,
  CASE WHEN c_custkey % 5 = 0 THEN 'OVER' WHEN c_custkey % 3 = 0 THEN 'CACHE' WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS mic,
  CASE WHEN c_custkey % 5 = 0 THEN 'override' WHEN c_custkey % 3 = 0 THEN 'cache' WHEN c_custkey % 2 = 0 THEN 'source' ELSE 'fallback' END AS source
FROM customer""")
def exchange_resolve(spark, path):
    tickers, over, cached, source = _layers(spark, path)
    return joins.exchange_resolve(tickers, over, cached, source, ["timezone", "mic"])


@query("override_patch", """
WITH log AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN ' ' ELSE concat('C', CAST(o_custkey AS VARCHAR)) END AS ticker, o_orderkey AS seq,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS timezone, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS mic FROM orders)
SELECT ticker, max_by(timezone, seq) FILTER (WHERE timezone IS NOT NULL) AS timezone, max_by(mic, seq) FILTER (WHERE mic IS NOT NULL) AS mic
FROM log WHERE trim(ticker) <> '' AND (timezone IS NOT NULL OR mic IS NOT NULL) GROUP BY ticker""")
def override_patch(spark, path):
    o = A.table(spark, path, "orders")
    key = F.col("o_orderkey")
    log = o.select(
        F.when(F.col("o_custkey") % 50 == 0, F.lit(" ")).otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("ticker"),
        key.alias("seq"), F.when(key % 3 == 0, F.col("o_orderpriority")).alias("timezone"),
        F.when(key % 4 == 0, F.col("o_orderstatus")).alias("mic"))
    return joins.override_patch(log, ["timezone", "mic"])


@query("zip_columns", """
SELECT o_orderkey, CAST(i AS INTEGER) AS pos, CASE WHEN i <= o_custkey % 3 THEN i END AS id, CASE WHEN i <= o_orderkey % 4 THEN i * 10 END AS value
FROM orders, generate_series(0, 3) g(i) WHERE i <= greatest(o_custkey % 3, o_orderkey % 4)""")
def zip_columns(spark, path):
    zero = F.lit(0).cast("bigint")
    lists = A.table(spark, path, "orders").select(
        "o_orderkey", F.sequence(zero, F.col("o_custkey") % 3).alias("ids"),
        F.transform(F.sequence(zero, F.col("o_orderkey") % 4), lambda x: x * 10).alias("vals"))
    return joins.zip_columns(lists, "ids", "vals", ["o_orderkey"])


@query("fx_requirements", "SELECT DISTINCT pair FROM terms WHERE needs_conversion")
def fx_requirements(spark, path):
    return joins.fx_requirements(A.ref_long(spark, path), "USD")


@query("currencies_needing_conversion", "SELECT DISTINCT crncy FROM crncy WHERE upper(crncy) <> 'GBP'")
def currencies_needing_conversion(spark, path):
    return joins.currencies_needing_conversion(joins.currency_lookup(A.ref_long(spark, path)), "gbp")


@query("derive_sessions", """SELECT e.exchange, """ + ", ".join(
    f"max(CASE WHEN w.session = '{n}' THEN concat(start_time, '-', end_time) END) AS \"{n}\"" for n in calendars.SESSION_NAMES
) + " FROM exchanges e LEFT JOIN session_windows w ON w.exchange = e.exchange GROUP BY e.exchange")
def derive_sessions(spark, path):
    ex = calendars.with_sessions(A.exchanges(spark, path))
    text = lambda n: F.concat_ws("-", f"sessions.{n}.start", f"sessions.{n}.end")
    return ex.select("exchange", *[
        F.when(F.col(f"sessions.{n}").isNotNull(), text(n)).alias(n) for n in calendars.SESSION_NAMES])


TIMING = """
SELECT d.exchange, d.date, concat(strftime(d.date, '%Y-%m-%d'), ' ', w1.start_time) AS bod, concat(strftime(d.date, '%Y-%m-%d'), ' ', w1.end_time) AS eod,
  concat(strftime(d.date, '%Y-%m-%d'), ' ', w2.end_time) AS finished,
  strftime(((CAST(concat(strftime(d.date, '%Y-%m-%d'), ' ', w1.end_time, ':00') AS TIMESTAMP) AT TIME ZONE z.timezone) AT TIME ZONE 'Asia/Tokyo'), '%Y-%m-%d %H:%M:%S+09:00') AS eod_tokyo
FROM exchange_days d JOIN zoned z ON z.exchange = d.exchange JOIN session_windows w1 ON w1.exchange = d.exchange AND w1.session = 'day'
JOIN session_windows w2 ON w2.exchange = d.exchange AND w2.session = 'allday'"""


@query("market_timing", TIMING)
def market_timing(spark, path):
    ex = calendars.with_sessions(joins.timezone_join(A.exchanges(spark, path))).where("sessions.day is not null")
    rows = A.exchange_days(spark, path).join(ex, "exchange")
    for out, timing, target in (
        ("bod", "BOD", "local"), ("eod", "EOD", "local"), ("finished", "FINISHED", "local"), ("eod_tokyo", "EOD", "Asia/Tokyo")
    ):
        rows = calendars.market_timing(rows, out, timing, target)
    return rows.select("exchange", "date", "bod", "eod", "finished", "eod_tokyo")


@query("relabel_output_tz", """SELECT event_id, time, (time AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_time FROM ticks""")
def relabel_output_tz(spark, path):
    return calendars.relabel_output_tz(A.ticks(spark, path).select("event_id", "time"), "America/New_York")


@query("est_to_local", """
SELECT z.exchange, d.date, strftime((CAST(concat(strftime(d.date, '%Y-%m-%d'), ' ', w.start_time, ':00') AS TIMESTAMP) AT TIME ZONE 'America/New_York') AT TIME ZONE z.timezone, '%H:%M') AS day_start,
  strftime((CAST(concat(strftime(d.date, '%Y-%m-%d'), ' ', w.end_time, ':00') AS TIMESTAMP) AT TIME ZONE 'America/New_York') AT TIME ZONE z.timezone, '%H:%M') AS day_end
FROM exchange_days d JOIN zoned z ON z.exchange = d.exchange JOIN session_windows w ON w.exchange = z.exchange AND w.session = 'day'""")
def est_to_local(spark, path):
    ex = joins.timezone_join(A.exchanges(spark, path)).where("day_start <> '25:00'")
    rows = A.exchange_days(spark, path).join(ex, "exchange")
    return calendars.hours_to_local(rows, F.col("date")).select("exchange", "date", "day_start", "day_end")


VENUE = """
SELECT ticker, CASE WHEN starts_with(ticker, 'CDX') THEN 'US' ELSE exch END AS exch, CASE WHEN starts_with(ticker, 'CDX') THEN 'America/New_York' ELSE tz END AS tz,
  CASE WHEN generic THEN 'HMUZ' END AS freq, CASE WHEN NOT starts_with(ticker, 'CDX') THEN generic END AS is_fut
FROM (SELECT ticker, row_id % 8 IN (0, 5) AS generic,
  CASE WHEN row_id % 3 = 0 THEN 'US' WHEN row_id % 3 = 1 THEN 'XNYS' END AS exch, CASE WHEN row_id % 2 = 0 THEN 'Asia/Tokyo' END AS tz
  FROM (SELECT o_orderkey AS row_id, CASE o_orderkey % 8 WHEN 0 THEN concat('ES', n, ' Index')
  WHEN 1 THEN concat('ES', code, lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0'), ' Index') WHEN 2 THEN concat('SPY', n, ' US Equity')
  WHEN 3 THEN concat('CDX IG CDSI S', CAST(o_custkey % 50 + 1 AS VARCHAR), ' 5Y Corp')
  WHEN 4 THEN concat('CDX HY CDSI S', CAST(o_custkey % 50 + 1 AS VARCHAR), ' V', n, ' 10Y Corp')
  WHEN 5 THEN concat('UX', code, n, ' Comdty') WHEN 6 THEN 'CDX EM CDSI GEN 5Y Corp' END AS ticker
  FROM (SELECT *, substr('FGHJKMNQUVXZ', CAST(o_custkey % 12 + 1 AS INT), 1) AS code, CAST(o_custkey % 9 + 1 AS VARCHAR) AS n FROM orders)
  WHERE o_orderkey % 8 <> 7))"""


@query("infer_venue", VENUE)
def infer_venue(spark, path):
    k = F.col("row_id")
    facts = A.raw_instruments(spark, path).select(
        "ticker", F.when(k % 3 == 0, F.lit("US")).otherwise(F.lit(" ")).alias("EXCH_CODE"),
        F.when(k % 3 != 2, F.lit("XNYS")).alias("ID_MIC_PRIM_EXCH"),
        F.when(k % 2 == 0, F.lit("Asia/Tokyo")).otherwise(F.lit("nan")).alias("IANA_TIME_ZONE"), F.lit("HMUZ").alias("FUT_GEN_MONTH"))
    return calendars.infer_venue(facts)


@query("market_info", """
SELECT DISTINCT concat('ES', CAST(p_partkey AS VARCHAR), '1 Index') AS ticker, CASE WHEN p_partkey % 3 = 0 THEN 'US' ELSE 'XNYS' END AS exch, 'Asia/Tokyo' AS tz,
  CASE WHEN p_partkey % 2 = 0 THEN NULL END AS freq, false AS is_fut FROM part
UNION ALL SELECT concat('CL', chr(CAST(65 + p_partkey % 26 AS INT)), CAST(p_partkey % 10 AS VARCHAR), ' Comdty'), 'XNYS', 'Asia/Tokyo', 'HMUZ', true FROM part GROUP BY ALL""")
def market_info(spark, path):
    p = A.table(spark, path, "part")
    key = F.col("p_partkey")
    pair = lambda name, value: F.struct(F.lit(name).alias("field"), value.alias("value"))
    base = [pair("id_mic_prim_exch", F.lit("XNYS")), pair("IANA_TIME_ZONE", F.lit("Asia/Tokyo")), pair("FUT_GEN_MONTH", F.lit("HMUZ"))]
    stocks = p.select(
        F.concat(F.lit("ES"), key.cast("string"), F.lit("1 Index")).alias("ticker"),
        F.inline(F.array(*base, pair("EXCH_CODE", F.when(key % 3 == 0, F.lit("US")).otherwise(F.lit(" "))))))
    futures = p.select(
        F.concat(F.lit("CL"), F.chr(65 + key % 26), (key % 10).cast("string"), F.lit(" Comdty")).alias("ticker"), F.inline(F.array(*base)))
    ref = stocks.unionByName(futures)
    return recipes.market_info(ref, ref.select("ticker").distinct())


@query("exchange_info", """
SELECT z.exchange AS ticker, CASE WHEN s.suppkey % 7 = 0 THEN 'XTKS' ELSE z.mic END AS mic, z.exch_code,
  CASE WHEN s.suppkey % 7 = 0 THEN 'Asia/Tokyo' ELSE z.timezone END AS timezone,
  CASE CASE WHEN s.suppkey % 7 = 0 THEN 'Asia/Tokyo' ELSE z.timezone END WHEN 'America/New_York' THEN '-04:00' WHEN 'Europe/London' THEN '+01:00' WHEN 'Europe/Paris' THEN '+02:00'
    WHEN 'Asia/Tokyo' THEN '+09:00' WHEN 'Asia/Hong_Kong' THEN '+08:00' WHEN 'Asia/Shanghai' THEN '+08:00' WHEN 'Australia/Sydney' THEN '+10:00' ELSE '+00:00' END AS utc_offset,
  CASE WHEN s.suppkey % 7 = 0 THEN 'override' ELSE z.tz_source END AS source, TIMESTAMP '2024-07-01 12:00:00' AS cached_at
FROM zoned z JOIN (SELECT s_suppkey AS suppkey, concat('X', CAST(s_suppkey AS VARCHAR)) AS exchange FROM supplier) s ON s.exchange = z.exchange""")
def exchange_info(spark, path):
    facts = A.exchanges(spark, path).withColumnRenamed("exchange", "ticker")
    number = F.regexp_extract("ticker", "[0-9]+", 0).cast("bigint")
    patch = facts.where(number % 7 == 0).select(
        "ticker", F.lit("XTKS").alias("mic"), F.lit(None).cast("string").alias("exch_code"), F.lit("Asia/Tokyo").alias("timezone"))
    return recipes.exchange_info(facts, "2024-07-01 12:00:00", patch).drop("sessions")


@query("extract_field_value", "SELECT ticker, value FROM ref_long WHERE field = 'SECTOR'")
def extract_field_value(spark, path):
    from marketframe.operators.shape import extract_field_value as pick

    return pick(A.ref_long(spark, path), "sector")
