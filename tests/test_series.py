"""Blocked series against plain brute force, with one ticker holding most rows."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketframe.operators import aggregate, scan, series, studies

D0 = datetime.date(1990, 1, 1)


def bars(spark, lengths=(400, 3, 37)):
    rng = np.random.default_rng(7)
    rows = []
    for k, n in enumerate(lengths):
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
        for i, c in enumerate(close):
            rows.append((f"T{k}", D0 + datetime.timedelta(days=int(i * 3)), float(c * (1 + rng.uniform(0, 0.03))),
                         float(c * (1 - rng.uniform(0, 0.03))), float(c), float(rng.integers(1, 1000))))
    pdf = pd.DataFrame(rows, columns=["ticker", "date", "high", "low", "close", "volume"])
    df = spark.createDataFrame(pdf, "ticker string, date date, high double, low double, close double, volume double")
    return pdf, df.repartition(5)


def result(df, *cols):
    return df.select("ticker", "date", *cols).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def per_ticker(pdf, fn):
    return pd.concat([fn(g.reset_index(drop=True)) for _, g in pdf.groupby("ticker")]).reset_index(drop=True)


def same(got, want):
    np.testing.assert_allclose(got.astype(float).to_numpy(), want.astype(float).to_numpy(), rtol=1e-9, equal_nan=True)


def test_positions_and_running_totals(spark):
    pdf, df = bars(spark)
    out = result(series.with_running(
        df, ["ticker"], [F.col("date")], F.year("date"), {"pos": F.lit(1).cast("bigint"), "total": F.col("volume")}), "pos", "total")
    assert list(out["pos"]) == list(pdf.groupby("ticker").cumcount() + 1)
    same(out["total"], pdf.groupby("ticker")["volume"].cumsum())


def test_positions_with_null_keys(spark):
    df = spark.createDataFrame([(None, D0), (None, D0 + datetime.timedelta(days=800)), ("A", D0)], "ticker string, date date")
    out = series.with_positions(df, ["ticker"], [F.col("date")], F.year("date")).collect()
    assert sorted((r.ticker or "", r.pos) for r in out) == [("", 0), ("", 1), ("A", 0)]


def test_in_blocks_keeps_each_row_once(spark):
    _, df = bars(spark)
    placed = series.with_positions(df, ["ticker"], [F.col("date")], F.year("date"))
    blocks = series.in_blocks(placed, ["ticker"], 7, 5, block_rows=16)
    assert series.own_rows(blocks).count() == 440
    assert blocks.groupBy("ticker", "_blk").count().agg(F.max("count")).first()[0] <= 16 + 7 + 5


@pytest.mark.parametrize("block", [None, 64])
def test_rolling_studies(spark, block):
    pdf, df = bars(spark)
    kw = {} if block is None else {"block_rows": block}
    sma = result(studies.smavg(df, 20, **kw), "smavg")
    same(sma["smavg"], per_ticker(pdf, lambda g: g["close"].rolling(20).mean()))
    boll = result(studies.boll(df, 20, **kw), "boll_upper", "boll_pct")
    upper = per_ticker(pdf, lambda g: g["close"].rolling(20).mean() + 2 * g["close"].rolling(20).std(ddof=0))
    same(boll["boll_upper"], upper)
    wma = result(studies.wmavg(df, 10, **kw), "wmavg")
    weights = np.arange(1, 11) / 55
    same(wma["wmavg"], per_ticker(pdf, lambda g: g["close"].rolling(10).apply(lambda x: (x * weights).sum(), raw=True)))
    hi = result(studies.maxmin(df, 15, **kw), "max_high", "min_low")
    same(hi["max_high"], per_ticker(pdf, lambda g: g["high"].rolling(15).max()))


def ema(x, n, first=0):
    out, y, a = np.full(len(x), np.nan), None, 2 / (n + 1)
    for i, v in enumerate(x):
        if i < first:
            continue
        y = v if i == first else a * v + (1 - a) * y
        out[i] = y
    return out


def wilder(x, n, first=1):
    out, y = np.full(len(x), np.nan), None
    for i in range(len(x)):
        if i == first + n - 1:
            y = np.mean(x[first:first + n])
        elif i > first + n - 1:
            y = (y * (n - 1) + x[i]) / n
        if y is not None:
            out[i] = y
    return out


# period 3 forgets fast: a block of 140 rows makes the long ticker span several blocks
@pytest.mark.parametrize("period, block", [(20, None), (3, 140)])
def test_exponential_mean(spark, period, block):
    pdf, df = bars(spark)
    kw = {} if block is None else {"block_rows": block}
    got = result(studies.emavg(df, period, **kw), "emavg")

    def want(g):
        y = pd.Series(ema(g["close"].to_numpy(), period))
        y[: period - 1] = np.nan
        return y
    same(got["emavg"], per_ticker(pdf, want))


def test_exponential_mean_over_many_blocks(spark):
    """A series far longer than a block keeps the exact value of the plain recurrence."""
    pdf, df = bars(spark, (6000, 50))
    same(result(studies.emavg(df, 9, block_rows=700), "emavg")["emavg"],
         per_ticker(pdf, lambda g: pd.Series(np.where(np.arange(len(g)) >= 8, ema(g["close"].to_numpy(), 9), np.nan))))


def test_macd_rsi_dmi(spark):
    pdf, df = bars(spark)
    got = result(studies.macd(df, 4, 9, 3), "macd", "macd_signal")

    def macd(g):
        c = g["close"].to_numpy()
        m = ema(c, 4) - ema(c, 9)
        sig = ema(m, 3, first=8)
        m[:8], sig[:10] = np.nan, np.nan
        return pd.DataFrame({"m": m, "s": sig})
    want = per_ticker(pdf, macd)
    same(got["macd"], want["m"])
    same(got["macd_signal"], want["s"])

    def rsi(g):
        ch = np.diff(g["close"].to_numpy(), prepend=np.nan)
        up, down = wilder(np.maximum(ch, 0), 14), wilder(np.maximum(-ch, 0), 14)
        return pd.Series(100 - 100 / (1 + up / down))
    same(result(studies.rsi(df), "rsi")["rsi"], per_ticker(pdf, rsi))

    adx = result(studies.dmi(df, 5), "plus_di", "adx")
    assert adx["adx"].between(0, 100).sum() == adx["adx"].notna().sum() > 300


def stop(g, step=0.02, cap=0.2):
    h, lo, c = (g[x].to_numpy() for x in ("high", "low", "close"))
    out = np.full(len(g), np.nan)
    if len(g) < 2:
        return pd.Series(out)
    up = c[1] >= c[0]
    sar, ep, af = (lo[0], max(h[0], h[1]), step) if up else (h[0], min(lo[0], lo[1]), step)
    out[1] = sar
    for i in range(2, len(g)):
        sar = sar + af * (ep - sar)
        sar = min(sar, lo[i - 1], lo[i - 2]) if up else max(sar, h[i - 1], h[i - 2])
        if (up and lo[i] < sar) or (not up and h[i] > sar):
            sar, up, af = ep, not up, step
            ep = h[i] if up else lo[i]
        elif up and h[i] > ep:
            ep, af = h[i], min(af + step, cap)
        elif not up and lo[i] < ep:
            ep, af = lo[i], min(af + step, cap)
        out[i] = sar
    return pd.Series(out)


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_parabolic_stop_over_blocks(spark, block):
    pdf, df = bars(spark)
    got = result(studies.ptps(df, block_rows=block), "ptps")
    same(got["ptps"], per_ticker(pdf, stop))


def test_hurst_of_short_series_is_null(spark):
    _, df = bars(spark, (400, 20))
    out = {r.ticker: r.hurst for r in studies.hurst(df).collect()}
    assert 0 < out["T0"] < 1 and out["T1"] is None


def plain_hurst(close, smallest=8):
    with np.errstate(all="ignore"):
        r = np.log(close[1:] / close[:-1])
    x, y, n = [], [], smallest
    while n <= len(r) / 2:
        found = []
        for i in range(len(r) // n):
            c = np.nan_to_num(r[i * n: (i + 1) * n])
            sd = np.nanstd(r[i * n: (i + 1) * n])
            walk = np.cumsum(c - c.sum() / n)
            if sd > 0:
                found.append((walk.max() - walk.min()) / sd)
        if found and np.mean(found) > 0:
            x.append(np.log(n))
            y.append(np.log(np.mean(found)))
        n *= 2
    return np.polyfit(x, y, 1)[0] if len(x) > 1 else None


@pytest.mark.parametrize("block, fan", [(1 << 16, 1 << 12), (16, 4), (64, 8), (8, 16)])
def test_hurst_over_levels(spark, block, fan):
    """Lengths within a block, from summaries of blocks, and from summaries of summaries."""
    pdf, df = bars(spark, (2100, 700, 129, 40, 9, 1))
    flat = spark.createDataFrame([("FLAT", D0 + datetime.timedelta(days=i), 1.0, 1.0, 5.0, 1.0) for i in range(300)], df.schema)
    got = {r.ticker: r.hurst for r in studies.hurst(df.unionByName(flat), block=block, fan=fan).collect()}
    for ticker, g in pdf.groupby("ticker"):
        longest = block * fan * fan
        want = plain_hurst(g["close"].to_numpy())
        if len(g) <= longest:
            assert got.get(ticker) == pytest.approx(want, rel=1e-9) if want is not None else got.get(ticker) is None
    assert got.get("FLAT") is None


def test_hull_corners_give_every_extreme():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 2000):
        x, y = np.arange(1.0, n + 1), np.cumsum(r.normal(size=n))
        for slope in r.normal(size=20):
            for sign in (1, -1):
                at = studies._hull(x, y, sign)
                assert (sign * (y - slope * x)).max() == (sign * (y - slope * x))[at].max()


def test_hurst_reads_each_level_once(spark):
    _, df = bars(spark, (50,))
    plan = studies.hurst(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 10


def test_hist_adjust_counts_later_actions_only(spark):
    hist = spark.createDataFrame([("A", D0, 10.0), ("A", D0 + datetime.timedelta(days=700), 10.0)], "ticker string, date date, value double")
    acts = spark.createDataFrame(
        [("A", D0, "split", 0.5), ("A", D0 + datetime.timedelta(days=700), "split", 0.25), ("A", D0 + datetime.timedelta(days=800), "cash", 0.9)],
        "ticker string, date date, kind string, factor double")
    values = lambda a: [round(r.value, 9) for r in scan.hist_adjust(hist, acts, a).orderBy("date").collect()]
    assert values("split") == [2.5, 10.0]
    assert values("dvd") == [9.0, 9.0]
    assert values("all") == [2.25, 9.0]


@pytest.mark.parametrize("cell", [65536, 4])
def test_level_percentages(spark, cell, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", cell)
    rows = [("A", 0, 2, 9.0), ("A", 1, 1, 100.0), ("A", 2, 1, 200.0), ("A", 3, 2, 50.0), ("A", 4, 2, 50.0), ("A", 5, 3, 1.0), ("A", 6, 1, None)]
    df = spark.createDataFrame(rows, "ticker string, pos bigint, level int, v double")
    out = [r.v_pct for r in aggregate.level_percentages(df, "v", bucket_rows=2).orderBy("pos").collect()]
    assert [None if x is None else round(x, 2) for x in out] == [None, 33.33, 66.67, 50.0, 50.0, None, None]


def test_level_percentages_of_a_hot_ticker(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", 100)
    df = spark.range(3000).select(
        F.lit("A").alias("ticker"), F.col("id").alias("pos"), F.when(F.col("id") % 1000 == 0, 1).otherwise(2).alias("level"), F.lit(2.0).alias("v"))
    out = aggregate.level_percentages(df, "v", bucket_rows=64)
    level = out.groupBy("level").agg(F.sum("v_pct").alias("s"), F.count("v_pct").alias("n")).orderBy("level").collect()
    assert [(round(r.s, 6), r.n) for r in level] == [(100.0, 3), (300.0, 2997)]


def test_fill_forward(spark):
    day = lambda n: D0 + datetime.timedelta(days=n)
    df = spark.createDataFrame([("A", "P", day(0), 1.0), ("A", "P", day(3), 2.0), ("A", "P", day(400), 3.0)], "ticker string, field string, date date, value double")
    out = aggregate.fill_forward(df).orderBy("date").collect()
    assert [r.date for r in out] == [day(i) for i in range(401)]
    assert [r.value for r in out] == [1.0] * 3 + [2.0] * 397 + [3.0]
    assert aggregate.fill_forward(df, fill="N").where("value is not null").count() == 3
    assert aggregate.fill_forward(df, days="W").where("weekday(date) >= 5").count() == 0
    assert aggregate.fill_forward(df, end=str(day(410))).agg(F.max("date")).first()[0] == day(410)


def test_studies_of_intraday_bars(spark):
    pdf, df = bars(spark)
    timed = df.withColumn("time", F.col("date").cast("timestamp") + F.expr("interval 5 minutes")).drop("date")
    out = studies.smavg(timed, 20).toPandas().sort_values(["ticker", "time"])
    same(out["smavg"], per_ticker(pdf, lambda g: g["close"].rolling(20).mean()))
    out = studies.ado(timed).toPandas().sort_values(["ticker", "time"])

    def flow(g):
        return (((g["close"] - g["low"]) - (g["high"] - g["close"])) / (g["high"] - g["low"]) * g["volume"]).cumsum()
    same(out["ado"], per_ticker(pdf, flow))


def test_ties_follow_seq(spark):
    df = spark.createDataFrame([("A", D0, i, float(i)) for i in range(6)], "ticker string, date date, seq int, close double")
    out = studies.momentum(df, 2).orderBy("seq").collect()
    assert [r.momentum for r in out] == [None, None, 2.0, 2.0, 2.0, 2.0]


def test_top_rows_are_cut_before_the_shuffle(spark):
    from marketframe.operators import predicates, status

    ev = spark.range(10).select(F.timestamp_seconds("id").alias("event_time"), F.col("id").alias("seq"), (F.col("id") % 3).cast("string").alias("topic"))
    plan = status.event_history(ev, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") != plan.rindex("WindowGroupLimit")
    text = F.col("id").cast("string")
    chain = spark.range(10).select(
        text.alias("id"), text.alias("underlying"), F.to_date(F.timestamp_seconds("id")).alias("expire_dt"), text.alias("put_call"),
        F.col("id").cast("double").alias("strike_px"), F.lit(3.0).alias("undl_px"))
    plan = predicates.option_chain(chain, strike="ATM", points=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cluster_needs_a_shared_folder(monkeypatch):
    from marketframe.session import work_dir

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **kw):
            self.conf = Conf({k.replace("_", "."): v for k, v in kw.items()})

    def session_of(**kw):
        session = Session()
        session.conf = Conf({f"spark.{k.replace('__', '.')}": v for k, v in kw.items()})
        return session

    for conf in ({}, {"sql__warehouse__dir": "file:/opt/app/spark-warehouse"}, {"sql__warehouse__dir": "/opt/app/spark-warehouse"}):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(session_of(master="yarn", **conf), "x")
    assert work_dir(session_of(master="local[2]", sql__warehouse__dir="file:/w"), "x").startswith("file:/w/_work/x-")
    assert work_dir(session_of(master="yarn", sql__warehouse__dir="s3a://b/w"), "x").startswith("s3a://b/w/_work/x-")
    shared = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/"})
    session = Session()
    session.conf = shared
    assert work_dir(session, "x").startswith("hdfs://nn/shared/x-")


def halted(spark, moving, n):
    """One series that moves, rests for the remaining rows, and ends with one move."""
    rng = np.random.default_rng(3)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, moving)))
    close = np.concatenate((close, np.full(n - moving - 1, close[-1]), [close[-1] * 1.01]))
    half = np.where(np.arange(n) < moving, 0.01, 0.0)
    pdf = pd.DataFrame({"ticker": "T0", "date": [D0 + datetime.timedelta(days=i) for i in range(n)],
                        "high": close * (1 + half * rng.uniform(0, 1, n)), "low": close * (1 - half * rng.uniform(0, 1, n)), "close": close})
    return pdf, spark.createDataFrame(pdf, "ticker string, date date, high double, low double, close double").repartition(5)


@pytest.mark.parametrize("block", [None, 300, 1100])
def test_smoothings_after_a_rest(spark, block):
    """Ratios of two decayed means keep their value however long a series rests, in any block length."""
    pdf, df = halted(spark, 100, 3000)
    kw = {} if block is None else {"block_rows": block}
    change = np.diff(pdf["close"].to_numpy(), prepend=np.nan)
    up, down = wilder(np.maximum(change, 0), 14), wilder(np.maximum(-change, 0), 14)
    same(result(studies.rsi(df, **kw), "rsi")["rsi"], pd.Series(100 - 100 / (1 + up / down)))

    h, lo, c = (pdf[x].to_numpy() for x in ("high", "low", "close"))
    u, d = np.diff(h, prepend=np.nan), -np.diff(lo, prepend=np.nan)
    prev = np.concatenate(([np.nan], c[:-1]))
    tr = np.fmax.reduce([h - lo, np.abs(h - prev), np.abs(lo - prev)])
    plus = wilder(np.where((u > d) & (u > 0), u, 0.0), 14) / wilder(tr, 14) * 100
    minus = wilder(np.where((d > u) & (d > 0), d, 0.0), 14) / wilder(tr, 14) * 100
    got = result(studies.dmi(df, 14, **kw), "plus_di", "minus_di", "adx")
    same(got["plus_di"], pd.Series(plus))
    same(got["adx"], pd.Series(wilder(100 * np.abs(plus - minus) / (plus + minus), 14, first=14)))


def test_periods_far_apart(spark):
    pdf, df = halted(spark, 2500, 3000)
    c = pdf["close"].to_numpy()
    want = ema(c, 2) - ema(c, 200)
    want[:199] = np.nan
    np.testing.assert_allclose(result(studies.macd(df, 2, 200, 9), "macd")["macd"].to_numpy(), want, rtol=1e-7, atol=1e-9)
