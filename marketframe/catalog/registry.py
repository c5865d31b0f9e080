"""Registration of queries, and the check views their SQL may name."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketframe import refdata
from marketframe.session import tune
from marketframe.sources.adapters import EXCHANGE_FACTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, path: fn(tune(spark), path)
        if sql is not None:
            ORACLES[name] = with_views(exact_round(sql))
        return fn
    return add


def with_views(body: str) -> str:
    """The statement with the views it names in front, views of views first."""
    # a view names only views listed before it
    order = list(VIEWS)
    needed: set[str] = set()

    def visit(text: str, limit: int) -> None:
        for i, name in enumerate(order[:limit]):
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name], i)

    visit(body, len(order))
    if not needed:
        return body
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in order if name in needed)
    rest = body.strip()
    recursive = re.match(r"(?is)with\s+recursive\s+", rest)
    plain = re.match(r"(?is)with\s+", rest)
    if recursive:
        return f"WITH RECURSIVE {head},\n{rest[recursive.end():]}"
    if plain:
        return f"WITH {head},\n{rest[plain.end():]}"
    return f"WITH {head}\n{rest}"


def exact_round(sql: str) -> str:
    """``round(x, n)`` as plain arithmetic, so that both engines treat halves alike."""
    out, i = "", 0
    while True:
        at = sql.find("round(", i)
        if at < 0:
            return out + sql[i:]
        depth, end = 1, at + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner, digits = sql[at + len("round("): end - 1].rsplit(",", 1)
        scale = f"1e{int(digits)}"
        out += sql[i:at] + f"(floor(({inner}) * {scale} + 0.5) / {scale})"
        i = end


def _case(key: str, values: list[str]) -> str:
    return "CASE " + key + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _fact(col: int) -> str:
    return _case("s_suppkey % 8", [row[col] for row in EXCHANGE_FACTS])


def _rules(rules: dict) -> str:
    rows = [
        f"('{k}', {pre}, {post}, {'NULL' if a is None else a}::INTEGER, {'NULL' if b is None else b}::INTEGER, {c})"
        for k, (pre, post, a, b, c) in rules.items()
    ]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(code, pre, post, l1, l2, cont)"


VIEWS = {
    "ticks": """SELECT concat('U', CAST(user_id AS VARCHAR), ' US Equity') AS ticker, ts AS time,
  CASE event_type WHEN 'purchase' THEN 'TRADE' WHEN 'click' THEN 'BID' WHEN 'view' THEN 'ASK'
       ELSE upper(event_type) END AS type,
  value, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS size, event_id FROM events""",
    "hist_wide": """SELECT concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS ticker, CAST(l_shipdate AS DATE) AS date,
  sum(l_extendedprice) / sum(l_quantity) AS px_last, sum(l_quantity) AS volume,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE sum(l_extendedprice) END AS turnover
FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "hist_long": """SELECT ticker, date, 'PX_LAST' AS field, px_last AS value FROM hist_wide
UNION ALL SELECT ticker, date, 'EQY_WEIGHTED_AVG_PX', px_last FROM hist_wide
UNION ALL SELECT ticker, date, 'VOLUME', volume FROM hist_wide
UNION ALL SELECT ticker, date, 'TURNOVER', turnover FROM hist_wide WHERE turnover IS NOT NULL""",
    "ohlc": """SELECT ticker, date, px_last * (1 + (volume % 3 - 1) / 100) AS open,
  px_last * (1 + (volume % 7 + 1) / 100) AS high, px_last * (1 - (volume % 5 + 1) / 100) AS low,
  px_last AS close, volume FROM hist_wide""",
    "ref_long": """SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity') AS ticker, 'NAME' AS field, p_name AS value FROM part
UNION ALL SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity'), 'CRNCY',
  CASE p_partkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'GBp' WHEN 3 THEN 'EUR' ELSE 'JPY' END FROM part
UNION ALL SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity'), 'SECTOR', p_type FROM part WHERE p_partkey % 7 <> 0
UNION ALL SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity'), 'OPEN_INT', CAST(p_size AS VARCHAR) FROM part""",
    "fx_long": """SELECT p.pair AS ticker, d.date, 'PX_LAST' AS field,
  CASE WHEN day(d.date) = 13 THEN 0.0 ELSE p.base + day(d.date) * 0.25 END AS value
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) d
CROSS JOIN (SELECT 'USDGBP Curncy' AS pair, CAST(0.5 AS DOUBLE) AS base
  UNION ALL SELECT 'USDEUR Curncy', CAST(0.75 AS DOUBLE) UNION ALL SELECT 'USDJPY Curncy', CAST(128.0 AS DOUBLE)) p""",
    "chain": """SELECT concat('B', CAST(o_custkey % 20 AS VARCHAR), 'A1 Index') AS gen_ticker,
  concat('B', CAST(o_custkey % 20 AS VARCHAR), 'A', substr('FGHJKMNQUVXZ', CAST(month(o_orderdate) AS INT), 1),
         substr(CAST(year(o_orderdate) AS VARCHAR), 3, 2), ' Index') AS contract,
  max(CAST(o_orderdate AS DATE)) AS last_trade_date
FROM orders GROUP BY o_custkey % 20, month(o_orderdate), year(o_orderdate)""",
    "segments": """SELECT concat('O', CAST(l_orderkey % 50 AS VARCHAR), ' US Equity') AS ticker,
  row_number() OVER (PARTITION BY l_orderkey % 50
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos,
  CASE WHEN l_linenumber = 1 THEN 1 ELSE 2 END AS level, l_extendedprice AS fy2024
FROM lineitem""",
    "maturities": """SELECT contract AS ticker, CASE WHEN day(last_trade_date) % 11 = 0 THEN 'not-a-date'
  ELSE strftime(last_trade_date, '%Y-%m-%d') END AS maturity FROM chain""",
    "futures_points": """SELECT DISTINCT concat('B', CAST(o_custkey % 20 AS VARCHAR), 'A', CAST(day(o_orderdate) % 3 + 1 AS VARCHAR), ' Index') AS gen_ticker,
  CAST(o_orderdate AS DATE) AS dt FROM orders""",
    "contract_volume": """SELECT ticker, date, 'VOLUME' AS field, CAST(CAST(sum(lots) AS BIGINT) AS VARCHAR) AS value FROM (
  SELECT concat('B', CAST(o_custkey % 20 AS VARCHAR), 'A', substr('FGHJKMNQUVXZ', CAST(month(m) AS INT), 1),
    substr(CAST(year(m) AS VARCHAR), 3, 2), ' Index') AS ticker, date, lots
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_custkey AS lots,
    CAST(date_trunc('month', o_orderdate) + to_months(CAST(o_orderkey % 3 AS INT)) AS DATE) AS m FROM orders)) GROUP BY ticker, date""",
    "cdx_ref": """SELECT concat('CDX C', CAST(c_custkey AS VARCHAR), ' CDSI GEN 5Y Corp') AS ticker, 'ROLLING_SERIES' AS field,
  CASE WHEN c_custkey % 9 = 0 THEN 'n/a' WHEN c_custkey % 2 = 0 THEN concat(CAST(c_custkey % 25 AS VARCHAR), '.0')
    ELSE CAST(c_custkey % 25 AS VARCHAR) END AS value FROM customer
UNION ALL SELECT concat('CDX C', CAST(c_custkey AS VARCHAR), ' CDSI GEN 5Y Corp'), 'VERSION', CAST(c_custkey % 4 AS VARCHAR) FROM customer
UNION ALL SELECT concat('CDX C', CAST(c_custkey AS VARCHAR), ' CDSI GEN 5Y Corp'), 'CDS_FIRST_ACCRUAL_START_DATE',
  strftime(DATE '1995-06-01' + c_nationkey * 60, '%Y-%m-%d') FROM customer""",
    "cdx_points": """SELECT DISTINCT concat('CDX C', CAST(o_custkey AS VARCHAR), ' CDSI GEN 5Y Corp') AS gen_ticker,
  CAST(o_orderdate AS DATE) AS dt FROM orders""",
    "cdx_hist": """SELECT concat('CDX C', CAST(o_custkey AS VARCHAR), ' CDSI S', CAST(o_custkey % 25 - o_orderkey % 2 AS VARCHAR), ' 5Y Corp') AS ticker,
  CAST(o_orderdate AS DATE) - CAST(o_orderkey % 7 AS INT) AS date, 'PX_LAST' AS field, o_totalprice AS value FROM orders""",
    "dividends": """SELECT concat('O', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 7 = 0 THEN ' Index' ELSE ' US Equity' END,
    CASE WHEN o_orderkey % 13 = 0 THEN ' =C' ELSE '' END) AS ticker,
  CASE o_orderkey % 3 WHEN 0 THEN 'DVD_Hist_All' WHEN 1 THEN 'DVD_Hist' ELSE 'Eqy_DVD_Hist_Splits' END AS field,
  CAST(o_orderdate AS DATE) + CAST(i * 90 AS INT) AS dec_date, CAST(o_orderdate AS DATE) + CAST(i * 90 + 10 AS INT) AS ex_date,
  CAST(o_orderdate AS DATE) + CAST(i * 90 + 30 AS INT) AS pay_date, (o_custkey + i) / 4 AS dvd_amt, o_orderpriority AS dvd_type
FROM orders, generate_series(0, 2) g(i) WHERE i <= o_custkey % 3""",
    "cashflows": """SELECT concat('B', CAST(o_orderkey AS VARCHAR), ' Corp') AS ticker,
  CASE o_orderkey % 4 WHEN 0 THEN 'DES_CASH_FLOW' WHEN 1 THEN 'CASHFLOW_SCHEDULE'
    WHEN 2 THEN 'CDS_INDEX_DEFAULT_INFORMATION' ELSE 'CDS_DEFAULT_PROB' END AS field,
  CAST(CAST(o_orderdate AS DATE) + to_months(CAST(i * 6 AS INT)) AS DATE) AS payment_date, (o_custkey % 50) / 8 AS coupon,
  CASE WHEN i = o_custkey % 5 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS principal
FROM orders, generate_series(0, 4) g(i) WHERE i <= o_custkey % 5""",
    "options": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
  concat('S', CAST(l_suppkey AS VARCHAR), ' US Equity') AS underlying,
  CASE WHEN l_linestatus = 'O' THEN 'Call' ELSE 'Put' END AS put_call,
  CAST(l_shipdate AS DATE) + CAST(l_linenumber * 7 AS INT) AS expire_dt, l_quantity * 10 AS strike_px, 255.0::DOUBLE AS undl_px,
  l_discount AS ivol, l_tax * 10 AS delta, l_tax AS gamma, l_quantity / 100 AS vega, -l_discount AS theta,
  l_quantity * 10 / 255.0::DOUBLE AS moneyness, l_partkey AS open_int, l_suppkey AS px_volume,
  l_extendedprice / l_quantity AS px_last, l_extendedprice / l_quantity * 0.5 AS px_bid, l_extendedprice / l_quantity * 2 AS px_ask,
  CASE WHEN l_returnflag = 'A' THEN 'US' ELSE 'LN' END AS exch_code,
  CASE WHEN l_returnflag = 'N' THEN 'European' ELSE 'American' END AS exercise_type FROM lineitem""",
    "bonds": """SELECT concat('B', CAST(c_custkey AS VARCHAR)) AS id, c_name AS name, concat(c_mktsegment, ' US Equity') AS issuer,
  CASE WHEN c_custkey % 2 = 0 THEN 'Preferreds' ELSE 'Corporates' END AS asset_class, c_custkey // 4 AS consolidated_id,
  CASE WHEN c_custkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS crncy, DATE '2000-01-01' + CAST(c_custkey % 2000 AS INT) AS maturity,
  c_acctbal AS amount FROM customer""",
    "field_info": """SELECT CASE WHEN p_partkey % 19 = 0 THEN ' ' ELSE concat('F', CAST(p_partkey AS VARCHAR)) END AS id,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(upper(replace(p_name, ' ', '_')), '_', CAST(p_partkey AS VARCHAR)) END AS mnemonic,
  CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE """ + _case(
        "p_partkey % 8", ["Double", "Int32", "Date", "String", "Boolean", "Time", "Price", "Odd"]) + """ END AS datatype,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 'Real' END AS ftype, p_name AS description, p_brand AS category FROM part""",
    "catalog_fields": """SELECT coalesce(nullif(trim(mnemonic), ''), id) AS field,
  coalesce(nullif(trim(datatype), ''), nullif(trim(ftype), ''), 'String') AS type, description, category
FROM field_info WHERE trim(id) <> ''""",
    "exchanges": f"""SELECT concat('X', CAST(s_suppkey AS VARCHAR)) AS exchange, {_fact(0)} AS mic, {_fact(1)} AS exch_code,
  {_fact(2)} AS country, CASE WHEN s_suppkey % 5 = 0 THEN 'Europe/Paris' ELSE ' ' END AS iana_tz,
  {_fact(3)} AS day_start, {_fact(4)} AS day_end FROM supplier""",
    "mic_rules": _rules(refdata.MIC_RULES),
    "code_rules": _rules(refdata.EXCHANGE_RULES),
    "country_zones": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}')" for k, v in refdata.COUNTRY_ZONES.items()) + ") t(country, zone)",
    "ruled": """SELECT e.*, coalesce(m.pre, c.pre) AS pre, coalesce(m.post, c.post) AS post,
  CASE WHEN m.code IS NOT NULL THEN m.l1 ELSE c.l1 END AS l1, CASE WHEN m.code IS NOT NULL THEN m.l2 ELSE c.l2 END AS l2,
  coalesce(m.cont, c.cont) AS cont, m.code IS NOT NULL OR c.code IS NOT NULL AS has_rule
FROM exchanges e LEFT JOIN mic_rules m ON m.code = trim(e.mic) LEFT JOIN code_rules c ON c.code = trim(e.exch_code)""",
    "zoned": """SELECT e.*, coalesce(nullif(trim(e.iana_tz), ''), z.zone, 'UTC') AS timezone,
  CASE WHEN trim(e.iana_tz) <> '' THEN 'vendor' WHEN z.zone IS NOT NULL THEN 'inferred' ELSE 'fallback' END AS tz_source
FROM exchanges e LEFT JOIN country_zones z ON z.country = upper(trim(e.country))""",
    "hours": """SELECT r.*, CASE WHEN h1 <= 23 AND m1 <= 59 AND h2 <= 23 AND m2 <= 59 THEN h1 * 60 + m1 END AS s,
  CASE WHEN h1 <= 23 AND m1 <= 59 AND h2 <= 23 AND m2 <= 59 THEN h2 * 60 + m2 END AS e,
  has_rule AND NOT coalesce(cont, false) AS extended
FROM (SELECT *, CAST(CASE WHEN contains(day_start, ':') THEN split_part(day_start, ':', 1) ELSE left(day_start, 2) END AS INT) AS h1,
  CAST(CASE WHEN contains(day_start, ':') THEN split_part(day_start, ':', 2) ELSE right(day_start, 2) END AS INT) AS m1,
  CAST(CASE WHEN contains(day_end, ':') THEN split_part(day_end, ':', 1) ELSE left(day_end, 2) END AS INT) AS h2,
  CAST(CASE WHEN contains(day_end, ':') THEN split_part(day_end, ':', 2) ELSE right(day_end, 2) END AS INT) AS m2 FROM ruled) r""",
    "session_minutes": """SELECT exchange, 'day' AS session, s AS a, e AS b FROM hours WHERE s IS NOT NULL
UNION ALL SELECT exchange, 'allday', CASE WHEN extended THEN s - pre ELSE s END, CASE WHEN extended THEN e + post ELSE e END FROM hours WHERE s IS NOT NULL
UNION ALL SELECT exchange, 'pre', s - pre, s FROM hours WHERE extended AND pre > 0 AND s IS NOT NULL
UNION ALL SELECT exchange, 'post', e + 1, e + post FROM hours WHERE extended AND post > 0 AND s IS NOT NULL
UNION ALL SELECT exchange, 'am', s, s + l1 FROM hours WHERE extended AND l1 IS NOT NULL AND s IS NOT NULL
UNION ALL SELECT exchange, 'pm', s + l2, e FROM hours WHERE extended AND l1 IS NOT NULL AND s IS NOT NULL""",
    "session_windows": """SELECT exchange, session,
  printf('%02d:%02d', ((a + 1440) % 1440) // 60, (a + 1440) % 60) AS start_time,
  printf('%02d:%02d', ((b + 1440) % 1440) // 60, (b + 1440) % 60) AS end_time FROM session_minutes""",
    "exchange_days": """SELECT DISTINCT concat('X', CAST(l_suppkey AS VARCHAR)) AS exchange, CAST(l_shipdate AS DATE) AS date FROM lineitem""",
    "messages": """SELECT ts AS timestamp, concat('U', CAST(user_id AS VARCHAR)) AS topic, event_id,
  CAST(event_id AS VARCHAR) AS last_trade, regexp_extract(props, '[0-9]+', 0) AS size,
  CASE WHEN event_id % 4 = 0 THEN concat('b', CAST(event_id % 10 AS VARCHAR)) END AS bid,
  CASE WHEN event_id % 4 <> 0 THEN concat('a', CAST(event_id % 10 AS VARCHAR)) END AS ask,
  CASE WHEN event_type = 'error' THEN 'SUMMARY' ELSE upper(event_type) END AS etype,
  CASE WHEN event_type = 'error' THEN 'DATALOSS' ELSE 'NEW' END AS esub FROM events""",
    "sub_events": """SELECT ts AS event_time, event_id AS seq, concat('U', CAST(user_id AS VARCHAR)) AS topic,
  CASE event_type WHEN 'purchase' THEN 'data' WHEN 'click' THEN 'subscription' WHEN 'view' THEN 'admin'
    WHEN 'error' THEN 'session' ELSE 'service' END AS category,
  CASE WHEN event_type = 'error' THEN 'warning' ELSE 'info' END AS level,
  CASE event_type WHEN 'purchase' THEN 'MarketData'
    WHEN 'click' THEN """ + _case("event_id % 5", ["SubscriptionStarted", "SubscriptionFailure", "SubscriptionTerminated",
                                                    "SubscriptionUnsubscribed", "SubscriptionUnsubscribing"]) + """
    WHEN 'view' THEN """ + _case("event_id % 3", ["SlowConsumerWarning", "SlowConsumerWarningCleared", "DataLoss"]) + """
    WHEN 'error' THEN """ + _case("event_id % 4", ["SessionConnectionDown", "RecoveryAttempt", "RecoverySuccess", "SessionConnectionUp"]) + """
    ELSE """ + _case("event_id % 2", ["ServiceUp", "ServiceDown"]) + """ END AS message_type,
  CASE WHEN event_type = 'signup' THEN concat('svc', CAST(user_id % 5 AS VARCHAR))
    ELSE concat('reason ', CAST(event_id % 17 AS VARCHAR)) END AS detail FROM events""",
    "stated": """SELECT *, CASE WHEN category = 'data' THEN 'streaming' ELSE CASE message_type WHEN 'SubscriptionStarted' THEN 'started'
  WHEN 'SubscriptionUnsubscribing' THEN 'unsubscribing' WHEN 'SubscriptionUnsubscribed' THEN 'unsubscribed'
  WHEN 'SubscriptionFailure' THEN 'failed' WHEN 'SubscriptionTerminated' THEN 'terminated' END END AS state FROM sub_events""",
    "topic_state": """SELECT topic, state, event_time AS last_change FROM stated WHERE state IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY event_time DESC, seq DESC) = 1""",
    "holdings": """SELECT concat('F', CAST(l_suppkey AS VARCHAR), ' US Equity') AS fund, concat('PF', CAST(l_suppkey AS VARCHAR)) AS portfolio,
  concat('P', CAST(l_partkey AS VARCHAR), ' US Equity') AS holding, concat('XS', lpad(CAST(l_partkey AS VARCHAR), 10, '0')) AS id_isin,
  l_discount AS weights, l_quantity AS position, l_returnflag AS sector, l_linestatus AS asset_class FROM lineitem""",
    "crncy": "SELECT ticker, trim(value) AS crncy FROM ref_long WHERE field = 'CRNCY' AND trim(value) <> ''",
    "terms": """SELECT ticker, crncy, CASE WHEN upper(crncy) <> 'USD' THEN concat('USD', upper(crncy), ' Curncy') END AS pair,
  CASE WHEN upper(crncy) <> 'USD' AND regexp_matches(crncy, '[a-z]$') THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END AS factor,
  upper(crncy) <> 'USD' AS needs_conversion FROM crncy""",
    "cdx_facts": """SELECT gen_ticker, CASE WHEN s >= 1 AND s = floor(s) THEN CAST(s AS INT) END AS series,
  CASE WHEN v >= 1 AND v = floor(v) THEN CAST(v AS INT) END AS version, a AS accrual
FROM (SELECT ticker AS gen_ticker, TRY_CAST(max(CASE WHEN field = 'ROLLING_SERIES' THEN value END) AS DOUBLE) AS s,
  TRY_CAST(max(CASE WHEN field = 'VERSION' THEN value END) AS DOUBLE) AS v,
  CAST(max(CASE WHEN field = 'CDS_FIRST_ACCRUAL_START_DATE' THEN value END) AS DATE) AS a FROM cdx_ref GROUP BY ticker)""",
    "placed": "SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS pos FROM ohlc",
}
