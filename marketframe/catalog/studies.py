"""Queries of the technical studies over all daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.tools import half_up, rounded
from marketframe.operators import studies
from marketframe.sources import adapters as A

W = "PARTITION BY ticker ORDER BY date"


def _frame(n: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _add(name: str, sql: str, out: list[str], digits: int = 4, **params) -> None:
    @query(name, sql)
    def run(spark, path):
        done = studies.study(A.ohlc(spark, path), name, **params)
        numbers = [c for c in out if c != "ptps_trend"]
        return rounded(done.select("ticker", "date", *out), *numbers, digits=digits)


def _r(expr: str, name: str, digits: int = 4) -> str:
    return f"round({expr}, {digits}) AS {name}"


def _full(expr: str, n: int) -> str:
    return f"CASE WHEN pos >= {n - 1} THEN {expr} END"


def _ema(out: str, src: str, a: float, b: str) -> str:
    """Recursive view: y = a*y + b along the positions of a ticker."""
    return (
        f"{out} AS (SELECT ticker, pos, {b} AS y FROM {src} WHERE pos = 0 UNION ALL "
        f"SELECT s.ticker, s.pos, {a!r}::DOUBLE * r.y + s.{b} FROM {out} r JOIN {src} s ON s.ticker = r.ticker AND s.pos = r.pos + 1)"
    )


def _seeded(n: int, x: str, first: int = 0) -> str:
    alpha = 2 / (n + 1)
    return f"CASE WHEN pos = {first} THEN {x} WHEN pos > {first} THEN {alpha!r}::DOUBLE * ({x}) ELSE 0::DOUBLE END"


def _wilder(n: int, x: str, first: int = 1) -> str:
    start = first + n - 1
    return f"CASE WHEN pos = {start} THEN avg({x}) {_frame(n)} WHEN pos > {start} THEN ({x}) / {n} ELSE 0::DOUBLE END"


_add("smavg", f"SELECT ticker, date, {_r(_full('avg(close) ' + _frame(20), 20), 'smavg')} FROM placed", ["smavg"])
_add("tmavg", f"""WITH m AS (SELECT *, {_full('avg(close) ' + _frame(10), 10)} AS m FROM placed)
SELECT ticker, date, {_r(_full('avg(m) ' + _frame(10), 19), 'tmavg')} FROM m""", ["tmavg"], period=10)
_add("wmavg", f"""WITH w AS (SELECT *, """ + " + ".join(f"{20 - k} * lag(close, {k}) OVER ({W})" for k in range(20)) + f""" AS s FROM placed)
SELECT ticker, date, {_r('s / 210', 'wmavg')} FROM w""", ["wmavg"])
_add("mao", f"SELECT ticker, date, {_r(_full('avg(close) ' + _frame(5) + ' - avg(close) ' + _frame(12), 12), 'mao')} FROM placed", ["mao"], short=5, long=12)
_add("momentum", f"SELECT ticker, date, {_r(f'close - lag(close, 10) OVER ({W})', 'momentum')} FROM placed", ["momentum"], period=10)
_add("roc", f"SELECT ticker, date, {_r(f'100 * (close / lag(close, 10) OVER ({W}) - 1)', 'roc')} FROM placed", ["roc"], period=10)
_add("boll", f"""WITH m AS (SELECT *, {_full('avg(close) ' + _frame(20), 20)} AS mid, {_full('stddev_pop(close) ' + _frame(20), 20)} AS sd FROM placed)
SELECT ticker, date, {_r('mid', 'boll_mid')}, {_r('mid + 2 * sd', 'boll_upper')}, {_r('mid - 2 * sd', 'boll_lower')},
{_r('(close - (mid - 2 * sd)) / nullif(4 * sd, 0)', 'boll_pct')}, {_r('4 * sd / mid', 'boll_width')} FROM m""",
     ["boll_mid", "boll_upper", "boll_lower", "boll_pct", "boll_width"])
_add("mae", f"""WITH m AS (SELECT *, {_full('avg(close) ' + _frame(20), 20)} AS mid FROM placed)
SELECT ticker, date, {_r('mid', 'mae_mid')}, {_r('mid * 1.05::DOUBLE', 'mae_upper')}, {_r('mid * 0.95::DOUBLE', 'mae_lower')} FROM m""",
     ["mae_mid", "mae_upper", "mae_lower"])

TR = f"""t AS (SELECT *, CASE WHEN lag(close) OVER ({W}) IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER ({W})), abs(low - lag(close) OVER ({W}))) END AS tr FROM placed)"""

_add("atr", f"WITH {TR} SELECT ticker, date, {_r(_full('avg(tr) ' + _frame(14), 14), 'atr')} FROM t", ["atr"])
_add("tas", f"""WITH k AS (SELECT *, {_full(f'100 * (close - min(low) {_frame(14)}) / nullif(max(high) {_frame(14)} - min(low) {_frame(14)}, 0)', 14)} AS k FROM placed),
d AS (SELECT *, {_full('avg(k) ' + _frame(3), 16)} AS d FROM k), e AS (SELECT *, {_full('avg(d) ' + _frame(3), 18)} AS ds FROM d)
SELECT ticker, date, {_r('k', 'tas_k')}, {_r('d', 'tas_d')}, {_r('ds', 'tas_ds')}, {_r(_full('avg(ds) ' + _frame(3), 20), 'tas_dss')} FROM e""",
     ["tas_k", "tas_d", "tas_ds", "tas_dss"])
_add("wlpr", f"""SELECT ticker, date, {_r(_full(f'-100 * (max(high) {_frame(14)} - close) / nullif(max(high) {_frame(14)} - min(low) {_frame(14)}, 0)', 14), 'wlpr')} FROM placed""", ["wlpr"])
_add("maxmin", f"SELECT ticker, date, {_r(_full('max(high) ' + _frame(20), 20), 'max_high')}, {_r(_full('min(low) ' + _frame(20), 20), 'min_low')} FROM placed", ["max_high", "min_low"])
_add("cmci", f"""WITH p AS (SELECT *, (high + low + close) / 3 AS tp FROM placed), m AS (SELECT *, avg(tp) {_frame(20)} AS m, list(tp) {_frame(20)} AS xs FROM p)
SELECT ticker, date, {_r(_full('(tp - m) / nullif(0.015::DOUBLE * list_sum(list_transform(xs, lambda x: abs(x - m))) / 20, 0)', 20), 'cmci')} FROM m""", ["cmci"])
MF = "coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0) * volume"
_add("ado", f"SELECT ticker, date, {_r(f'sum({MF}) OVER ({W})', 'ado')} FROM placed", ["ado"])
_add("pivot", f"""WITH p AS (SELECT *, lag(high) OVER ({W}) AS h, lag(low) OVER ({W}) AS l, lag(close) OVER ({W}) AS c FROM placed), q AS (SELECT *, (h + l + c) / 3 AS pp FROM p)
SELECT ticker, date, {_r('pp', 'pivot')}, {_r('2 * pp - l', 'r1')}, {_r('2 * pp - h', 's1')}, {_r('pp + (h - l)', 'r2')}, {_r('pp - (h - l)', 's2')} FROM q""",
     ["pivot", "r1", "s1", "r2", "s2"])
_add("goc", f"""WITH m AS (SELECT *, {_full(f'(max(high) {_frame(5)} + min(low) {_frame(5)}) / 2', 5)} AS c, {_full(f'(max(high) {_frame(10)} + min(low) {_frame(10)}) / 2', 10)} AS b,
  {_full(f'(max(high) {_frame(20)} + min(low) {_frame(20)}) / 2', 20)} AS s FROM placed)
SELECT ticker, date, {_r('c', 'goc_conversion')}, {_r('b', 'goc_base')}, {_r(f'lag((c + b) / 2, 10) OVER ({W})', 'goc_span_a')},
{_r(f'lag(s, 10) OVER ({W})', 'goc_span_b')}, {_r(f'lead(close, 10) OVER ({W})', 'goc_lagging')} FROM m""",
     ["goc_conversion", "goc_base", "goc_span_a", "goc_span_b", "goc_lagging"], conversion=5, base=10, span=20)

_add("emavg", f"""WITH RECURSIVE x AS (SELECT *, {_seeded(20, 'close')} AS b FROM placed), {_ema('r', 'x', 1 - 2 / 21, 'b')}
SELECT x.ticker, x.date, round(CASE WHEN x.pos >= 19 THEN r.y END, 4) AS emavg FROM x JOIN r ON r.ticker = x.ticker AND r.pos = x.pos""", ["emavg"])
_add("rsi", f"""WITH RECURSIVE c AS (SELECT *, close - lag(close) OVER ({W}) AS ch FROM placed),
x AS (SELECT *, {_wilder(14, 'greatest(ch, 0)')} AS g, {_wilder(14, 'greatest(-ch, 0)')} AS l FROM c),
{_ema('gs', 'x', 13 / 14, 'g')}, {_ema('ls', 'x', 13 / 14, 'l')}
SELECT x.ticker, x.date, round(CASE WHEN x.pos >= 14 THEN CASE WHEN ls.y = 0 THEN 100 ELSE 100 - 100 / (1 + gs.y / ls.y) END END, 4) AS rsi
FROM x JOIN gs ON gs.ticker = x.ticker AND gs.pos = x.pos JOIN ls ON ls.ticker = x.ticker AND ls.pos = x.pos""", ["rsi"])
_add("macd", f"""WITH RECURSIVE x AS (SELECT *, {_seeded(6, 'close')} AS f, {_seeded(12, 'close')} AS s FROM placed),
{_ema('fs', 'x', 1 - 2 / 7, 'f')}, {_ema('ss', 'x', 1 - 2 / 13, 's')},
m AS (SELECT x.ticker, x.date, x.pos, CASE WHEN x.pos >= 11 THEN fs.y - ss.y END AS macd FROM x JOIN fs ON fs.ticker = x.ticker AND fs.pos = x.pos JOIN ss ON ss.ticker = x.ticker AND ss.pos = x.pos),
g AS (SELECT *, {_seeded(5, 'macd', 11)} AS b FROM m), {_ema('sg', 'g', 1 - 2 / 6, 'b')}
SELECT g.ticker, g.date, round(g.macd, 4) AS macd, round(CASE WHEN g.pos >= 15 THEN sg.y END, 4) AS macd_signal, round(g.macd - CASE WHEN g.pos >= 15 THEN sg.y END, 4) AS macd_hist
FROM g JOIN sg ON sg.ticker = g.ticker AND sg.pos = g.pos""", ["macd", "macd_signal", "macd_hist"], fast=6, slow=12, signal=5)
_add("kltn", f"""WITH RECURSIVE {TR}, a AS (SELECT *, avg(tr) {_frame(10)} AS atr, {_seeded(20, 'close')} AS b FROM t), {_ema('r', 'a', 1 - 2 / 21, 'b')}
SELECT a.ticker, a.date, round(CASE WHEN a.pos >= 19 THEN r.y END, 4) AS kltn_mid, round(CASE WHEN a.pos >= 19 THEN r.y + 2 * atr END, 4) AS kltn_upper,
round(CASE WHEN a.pos >= 19 THEN r.y - 2 * atr END, 4) AS kltn_lower FROM a JOIN r ON r.ticker = a.ticker AND r.pos = a.pos""", ["kltn_mid", "kltn_upper", "kltn_lower"])
_add("chko", f"""WITH RECURSIVE d AS (SELECT *, sum({MF}) OVER ({W}) AS ad FROM placed), x AS (SELECT *, {_seeded(3, 'ad')} AS f, {_seeded(10, 'ad')} AS s FROM d),
{_ema('fs', 'x', 1 - 2 / 4, 'f')}, {_ema('ss', 'x', 1 - 2 / 11, 's')}
SELECT x.ticker, x.date, round(CASE WHEN x.pos >= 9 THEN fs.y - ss.y END, 4) AS chko FROM x JOIN fs ON fs.ticker = x.ticker AND fs.pos = x.pos JOIN ss ON ss.ticker = x.ticker AND ss.pos = x.pos""", ["chko"])
_add("dmi", f"""WITH RECURSIVE {TR}, u AS (SELECT *, high - lag(high) OVER ({W}) AS up, lag(low) OVER ({W}) - low AS dn FROM t),
v AS (SELECT *, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS p, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS m FROM u),
x AS (SELECT *, {_wilder(7, 'p')} AS pb, {_wilder(7, 'm')} AS mb, {_wilder(7, 'tr')} AS tb FROM v),
{_ema('ps', 'x', 6 / 7, 'pb')}, {_ema('ms', 'x', 6 / 7, 'mb')}, {_ema('ts', 'x', 6 / 7, 'tb')},
d AS (SELECT x.ticker, x.date, x.pos, CASE WHEN x.pos >= 7 THEN 100 * ps.y / nullif(ts.y, 0) END AS pdi, CASE WHEN x.pos >= 7 THEN 100 * ms.y / nullif(ts.y, 0) END AS mdi
  FROM x JOIN ps ON ps.ticker = x.ticker AND ps.pos = x.pos JOIN ms ON ms.ticker = x.ticker AND ms.pos = x.pos JOIN ts ON ts.ticker = x.ticker AND ts.pos = x.pos),
e AS (SELECT *, CASE WHEN pos >= 7 THEN coalesce(100 * abs(pdi - mdi) / nullif(pdi + mdi, 0), 0) END AS dx FROM d),
f AS (SELECT *, {_wilder(7, 'dx', 7)} AS ab FROM e), {_ema('ad', 'f', 6 / 7, 'ab')}
SELECT f.ticker, f.date, round(pdi, 4) AS plus_di, round(mdi, 4) AS minus_di, round(CASE WHEN f.pos >= 13 THEN ad.y END, 4) AS adx
FROM f JOIN ad ON ad.ticker = f.ticker AND ad.pos = f.pos""", ["plus_di", "minus_di", "adx"], period=7)
_add("ptps", """WITH RECURSIVE s AS (SELECT ticker, pos, date, high AS h, low AS l, close AS c, lag(high) OVER w AS h1, lag(low) OVER w AS l1, lag(close) OVER w AS c1,
  lag(high, 2) OVER w AS h2, lag(low, 2) OVER w AS l2 FROM placed WINDOW w AS (PARTITION BY ticker ORDER BY date)),
r AS (SELECT ticker, pos, CASE WHEN c >= c1 THEN 1 ELSE -1 END AS trend, CASE WHEN c >= c1 THEN l1 ELSE h1 END AS sar,
  CASE WHEN c >= c1 THEN greatest(h1, h) ELSE least(l1, l) END AS ep, 0.02::DOUBLE AS af FROM s WHERE pos = 1
UNION ALL SELECT ticker, pos, CASE WHEN x THEN -trend ELSE trend END, CASE WHEN x THEN ep ELSE ns END,
  CASE WHEN x THEN CASE WHEN trend = 1 THEN l ELSE h END WHEN trend = 1 THEN greatest(ep, h) ELSE least(ep, l) END,
  CASE WHEN x THEN 0.02::DOUBLE WHEN (trend = 1 AND h > ep) OR (trend = -1 AND l < ep) THEN least(af + 0.02::DOUBLE, 0.2::DOUBLE) ELSE af END
  FROM (SELECT *, CASE WHEN trend = 1 THEN l < ns ELSE h > ns END AS x FROM (
    SELECT s.*, r.trend, r.ep, r.af, CASE WHEN r.trend = 1 THEN least(r.sar + r.af * (r.ep - r.sar), s.l1, s.l2) ELSE greatest(r.sar + r.af * (r.ep - r.sar), s.h1, s.h2) END AS ns
    FROM r JOIN s ON s.ticker = r.ticker AND s.pos = r.pos + 1)))
SELECT s.ticker, s.date, r.trend AS ptps_trend, round(r.sar, 4) AS ptps FROM s LEFT JOIN r ON r.ticker = s.ticker AND r.pos = s.pos""", ["ptps_trend", "ptps"])


@query("hurst", f"""
WITH r AS (SELECT ticker, pos - 1 AS i, ln(close / lag(close) OVER ({W})) AS r FROM placed QUALIFY pos > 0), n AS (SELECT ticker, count(*) AS cnt FROM r GROUP BY ticker),
c AS (SELECT r.*, z.n, r.i // z.n AS chunk FROM r JOIN n ON n.ticker = r.ticker JOIN (VALUES (8), (16), (32), (64), (128), (256), (512), (1024), (2048)) z(n) ON z.n <= n.cnt / 2 WHERE (r.i // z.n + 1) * z.n <= n.cnt),
d AS (SELECT *, r - avg(r) OVER (PARTITION BY ticker, n, chunk) AS dev, stddev_pop(r) OVER (PARTITION BY ticker, n, chunk) AS sd FROM c),
y AS (SELECT *, sum(dev) OVER (PARTITION BY ticker, n, chunk ORDER BY i) AS y FROM d),
rs AS (SELECT ticker, n, chunk, (max(y) - min(y)) / nullif(max(sd), 0) AS rs FROM y GROUP BY ticker, n, chunk), a AS (SELECT ticker, n, avg(rs) AS rs FROM rs GROUP BY ticker, n HAVING avg(rs) > 0)
SELECT ticker, round(CASE WHEN count(*) > 1 THEN regr_slope(ln(rs), ln(n)) END, 4) AS hurst FROM a GROUP BY ticker""")
def hurst(spark, path):
    return rounded(studies.hurst(A.ohlc(spark, path)), "hurst", digits=4)


@query("concat_studies", f"""SELECT ticker, date, {_r(_full('avg(close) ' + _frame(5), 5), 'smavg')}, NULL::DOUBLE AS momentum FROM placed
UNION ALL SELECT ticker, date, NULL, round(close - lag(close, 3) OVER ({W}), 4) FROM placed""")
def concat_studies(spark, path):
    bars = A.ohlc(spark, path)
    a = studies.study(bars, "sma", period=5).select("ticker", "date", half_up(F.col("smavg"), 4).alias("smavg"))
    b = studies.study(bars, "mom", period=3).select("ticker", "date", half_up(F.col("momentum"), 4).alias("momentum"))
    return studies.concat_studies([a, b])
