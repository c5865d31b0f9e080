"""Queries of futures and credit-index resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.functions import contracts as C
from marketframe.plans import futures, jobs
from marketframe.sources import adapters as A

NTH = """
WITH live AS (SELECT p.gen_ticker, p.dt, c.contract, c.last_trade_date AS expiry,
  row_number() OVER (PARTITION BY p.gen_ticker, p.dt ORDER BY c.last_trade_date, c.contract) AS rk
  FROM futures_points p JOIN chain c ON c.gen_ticker = regexp_replace(p.gen_ticker, '[0-9] Index$', '1 Index') AND c.last_trade_date > p.dt)
SELECT p.gen_ticker, p.dt, l.contract, l.expiry FROM futures_points p LEFT JOIN live l
ON l.gen_ticker = p.gen_ticker AND l.dt = p.dt AND l.rk = CAST(substr(regexp_extract(p.gen_ticker, '[0-9] Index$'), 1, 1) AS INT)"""


@query("fut_ticker", NTH)
def fut_ticker(spark, path):
    return futures.fut_ticker(A.futures_points(spark, path), A.chain(spark, path))


@query("nth_contract", """
WITH pts AS (SELECT DISTINCT regexp_replace(gen_ticker, '[0-9] Index$', '1 Index') AS gen_ticker, dt FROM futures_points),
live AS (SELECT p.gen_ticker, p.dt, c.contract, c.last_trade_date AS expiry,
  row_number() OVER (PARTITION BY p.gen_ticker, p.dt ORDER BY c.last_trade_date, c.contract) AS rk
  FROM pts p JOIN chain c ON c.gen_ticker = p.gen_ticker AND c.last_trade_date > p.dt)
SELECT p.gen_ticker, p.dt, 2::INTEGER AS n, l.contract, l.expiry FROM pts p LEFT JOIN live l ON l.gen_ticker = p.gen_ticker AND l.dt = p.dt AND l.rk = 2""")
def nth_contract(spark, path):
    points = A.futures_points(spark, path).withColumn("gen_ticker", C.with_generic_index(F.col("gen_ticker"), 1)).distinct()
    return futures.nth_contract(points, A.chain(spark, path), 2)


CANDIDATES = """(SELECT gen_ticker, dt, i AS rank, CAST(date_trunc('month', dt) + to_months(CAST(i AS INT)) AS DATE) AS month
  FROM futures_points, generate_series(0, 10) g(i)
  WHERE i < greatest(greatest(CAST(substr(regexp_extract(gen_ticker, '[0-9] Index$'), 1, 1) AS INT) - 1, 0) + 2, 3))"""
CANDIDATE = """concat(regexp_replace(gen_ticker, '[0-9] Index$', ''), substr('FGHJKMNQUVXZ', CAST(month(month) AS INT), 1),
  CASE WHEN date_trunc('month', dt) = DATE '1999-07-01' THEN CAST(year(month) % 10 AS VARCHAR) ELSE lpad(CAST(year(month) % 100 AS VARCHAR), 2, '0') END, ' Index')"""


@query("contract_calendar", f"""SELECT gen_ticker, dt, CAST(rank AS INTEGER) AS rank, month, {CANDIDATE} AS candidate,
substr('FGHJKMNQUVXZ', CAST(month(month) AS INT), 1) AS code FROM {CANDIDATES} c""")
def contract_calendar(spark, path):
    return jobs.contract_calendar(A.futures_points(spark, path), as_of="1999-07-15")


@query("contract_calendar_quarterly", """SELECT gen_ticker, dt, CAST(i AS INTEGER) AS rank, CAST(q + to_months(CAST(3 * i AS INT)) AS DATE) AS month,
  concat(regexp_replace(gen_ticker, '[0-9] Index$', ''), substr('FGHJKMNQUVXZ', CAST(month(q + to_months(CAST(3 * i AS INT))) AS INT), 1),
    lpad(CAST(year(q + to_months(CAST(3 * i AS INT))) % 100 AS VARCHAR), 2, '0'), ' Index') AS candidate,
  substr('FGHJKMNQUVXZ', CAST(month(q + to_months(CAST(3 * i AS INT))) AS INT), 1) AS code
FROM (SELECT gen_ticker, dt, CAST(date_trunc('quarter', dt) + INTERVAL 2 MONTH AS DATE) AS q FROM futures_points), generate_series(0, 3) g(i)
WHERE i < greatest(CAST(substr(regexp_extract(gen_ticker, '[0-9] Index$'), 1, 1) AS INT) - 1 + 2, 3)""")
def contract_calendar_quarterly(spark, path):
    return jobs.contract_calendar(A.futures_points(spark, path), freq="quarterly")


@query("fut_ticker_candidates", f"""
WITH cand AS (SELECT gen_ticker, dt, {CANDIDATE.replace('1999-07-01', '1900-01-01')} AS contract FROM {CANDIDATES} c),
live AS (SELECT c.gen_ticker, c.dt, c.contract, TRY_CAST(m.maturity AS DATE) AS expiry,
  row_number() OVER (PARTITION BY c.gen_ticker, c.dt ORDER BY TRY_CAST(m.maturity AS DATE), c.contract) AS rk
  FROM cand c JOIN maturities m ON m.ticker = c.contract WHERE TRY_CAST(m.maturity AS DATE) > c.dt)
SELECT gen_ticker, dt, contract, expiry FROM live WHERE rk = CAST(substr(regexp_extract(gen_ticker, '[0-9] Index$'), 1, 1) AS INT)""")
def fut_ticker_candidates(spark, path):
    return futures.fut_ticker_candidates(A.futures_points(spark, path), A.maturities(spark, path))


@query("active_futures", """
WITH live AS (SELECT p.gen_ticker, p.dt, c.contract, c.last_trade_date AS expiry,
  row_number() OVER (PARTITION BY p.gen_ticker, p.dt ORDER BY c.last_trade_date, c.contract) AS rk
  FROM futures_points p JOIN chain c ON c.gen_ticker = regexp_replace(p.gen_ticker, '[0-9] Index$', '1 Index') AND c.last_trade_date > p.dt),
two AS (SELECT p.gen_ticker, p.dt, f.contract AS front, f.expiry, s.contract AS second FROM futures_points p
  LEFT JOIN live f ON f.gen_ticker = p.gen_ticker AND f.dt = p.dt AND f.rk = 1 LEFT JOIN live s ON s.gen_ticker = p.gen_ticker AND s.dt = p.dt AND s.rk = 2),
vol AS (SELECT t.gen_ticker, t.dt,
  (SELECT arg_max(CAST(v.value AS DOUBLE), v.date) FROM contract_volume v WHERE v.ticker = t.front AND v.date BETWEEN t.dt - 10 AND t.dt) AS fv,
  (SELECT arg_max(CAST(v.value AS DOUBLE), v.date) FROM contract_volume v WHERE v.ticker = t.second AND v.date BETWEEN t.dt - 10 AND t.dt) AS sv FROM two t)
SELECT t.gen_ticker, t.dt, CASE WHEN t.second IS NULL OR date_trunc('month', t.dt) < date_trunc('month', t.expiry) THEN t.front
  WHEN v.sv > v.fv OR (v.fv IS NULL AND v.sv IS NOT NULL) THEN t.second ELSE t.front END AS contract
FROM two t JOIN vol v ON v.gen_ticker = t.gen_ticker AND v.dt = t.dt""")
def active_futures(spark, path):
    return futures.active_futures(A.futures_points(spark, path), A.chain(spark, path), A.contract_volume(spark, path))


CDX = """SELECT p.gen_ticker, p.dt, CASE WHEN f.accrual IS NOT NULL AND p.dt < f.accrual AND f.series > 1
    THEN regexp_replace(p.gen_ticker, 'GEN', concat('S', CAST(f.series - 1 AS VARCHAR)))
  WHEN f.series IS NOT NULL THEN regexp_replace(p.gen_ticker, 'GEN', concat('S', CAST(f.series AS VARCHAR){version})) END AS contract, f.accrual
FROM cdx_points p LEFT JOIN cdx_facts f ON f.gen_ticker = p.gen_ticker"""


@query("cdx_ticker", CDX.format(version=""))
def cdx_ticker(spark, path):
    return futures.cdx_ticker(A.cdx_points(spark, path), A.cdx_ref(spark, path))


@query("cdx_ticker_version", CDX.format(version=", CASE WHEN f.version > 1 THEN concat(' V', CAST(f.version AS VARCHAR)) ELSE '' END"))
def cdx_ticker_version(spark, path):
    return futures.cdx_ticker(A.cdx_points(spark, path), A.cdx_ref(spark, path), with_version=True)


@query("active_cdx", f"""
WITH cur AS ({CDX.format(version="")}),
prev AS (SELECT *, CASE WHEN CAST(regexp_extract(contract, ' S([0-9]+) ', 1) AS INT) > 1 THEN
  regexp_replace(contract, ' S[0-9]+ ', concat(' S', CAST(CAST(regexp_extract(contract, ' S([0-9]+) ', 1) AS INT) - 1 AS VARCHAR), ' ')) END AS previous
  FROM (SELECT * FROM cur WHERE contract IS NOT NULL)),
lastd AS (SELECT p.*, (SELECT max(h.date) FROM cdx_hist h WHERE h.ticker = p.contract AND h.date BETWEEN p.dt - 10 AND p.dt) AS cd,
  (SELECT max(h.date) FROM cdx_hist h WHERE h.ticker = p.previous AND h.date BETWEEN p.dt - 10 AND p.dt) AS pd FROM prev p)
SELECT gen_ticker, dt, CASE WHEN previous IS NOT NULL AND (pd > cd OR (cd IS NULL AND pd IS NOT NULL)) THEN previous ELSE contract END AS contract FROM lastd
UNION ALL SELECT gen_ticker, dt, NULL FROM cur WHERE contract IS NULL""")
def active_cdx(spark, path):
    return futures.active_cdx(A.cdx_points(spark, path), A.cdx_ref(spark, path), A.cdx_hist(spark, path))


@query("cdx_tickers", """SELECT ticker, concat(index, ' S', CAST(series - 1 AS VARCHAR), ' ', tenor, ' Corp') AS previous_series, concat(index, ' S', CAST(series AS VARCHAR), ' ', tenor, ' Corp') AS stripped,
  concat(index, ' S', CAST(series AS VARCHAR), ' V', n, ' ', tenor, ' Corp') AS versioned
FROM (SELECT o_orderkey, concat('CDX ', o_orderstatus, ' CDSI') AS index, o_custkey % 50 + 2 AS series, '5Y' AS tenor, CAST(o_custkey % 7 + 2 AS VARCHAR) AS n,
  concat('CDX ', o_orderstatus, ' CDSI S', CAST(o_custkey % 50 + 2 AS VARCHAR), ' V', CAST(o_custkey % 7 + 1 AS VARCHAR), ' 5Y Corp') AS ticker FROM orders)""")
def cdx_tickers(spark, path):
    o = A.table(spark, path, "orders")
    cust = F.col("o_custkey")
    t = o.select(
        F.concat(F.lit("CDX "), "o_orderstatus", F.lit(" CDSI S"), (cust % 50 + 2).cast("string"), F.lit(" V"),
                 (cust % 7 + 1).cast("string"), F.lit(" 5Y Corp")).alias("ticker"), (cust % 7 + 2).alias("n"))
    x = F.col("ticker")
    return t.select(
        "ticker", C.previous_series(x).alias("previous_series"), C.strip_version(x).alias("stripped"),
        C.with_version(x, F.col("n")).alias("versioned"))


@query("month_codes", """SELECT o_orderkey, substr('FGHJKMNQUVXZ', CAST(month(o_orderdate) AS INT), 1) AS code,
  strftime(o_orderdate, '%b') AS month_name, CAST(month(o_orderdate) AS INTEGER) AS month_number FROM orders""")
def month_codes(spark, path):
    o = A.table(spark, path, "orders").select("o_orderkey", C.month_code(F.month("o_orderdate")).alias("code"))
    return o.select("o_orderkey", "code", C.month_name(F.col("code")).alias("month_name"), C.month_number(F.lower("code")).alias("month_number"))
