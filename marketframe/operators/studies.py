"""Technical studies per ticker, ordered by date (daily bars) or time (intraday bars).

Every study works on blocks (see ``series``): a row is null until its
look-back is full, look-backs count rows, and no ticker is gathered whole in
one task. Smoothings of the form ``y = a*y + b`` run as weighted running sums
inside a block, to which the end state of the blocks before is carried.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketframe import refdata
from marketframe.operators import series
from marketframe.session import work_dir

KEY = "ticker"


def _pos() -> Column:
    return F.col("pos")


def ta_studies() -> list[str]:
    """Names of the studies that can run."""
    return sorted(STUDIES)


def ta_study_params(study: str) -> dict[str, object]:
    """Default parameters of a study, by name or alias."""
    name = study.lower().replace("-", "_").replace(" ", "_")
    return dict(refdata.STUDY_DEFAULTS.get(refdata.STUDY_ALIASES.get(name, name), {}))


def _axis(df: DataFrame) -> tuple[list[Column], Column]:
    """Row order and time bucket: daily bars by year, intraday bars by day; ``seq`` breaks ties."""
    tie = [F.col("seq")] if "seq" in df.columns else []
    if "date" in df.columns:
        return [F.col("date"), *tie], F.year("date")
    return [F.col("time"), *tie], F.to_date("time")


def _placed(df: DataFrame) -> DataFrame:
    order, bucket = _axis(df)
    return series.with_positions(df, [KEY], order, bucket)


def _run(
    placed: DataFrame, before: int, build: Callable, after: int = 0, block_rows: int | None = None,
) -> DataFrame:
    """Cut into blocks, add the study's columns, keep each row once."""
    size = series.block_length(before, after, block_rows)
    blocks = series.in_blocks(placed, [KEY], before, after, block_rows=size)
    return series.own_rows(build(blocks, series.block_window([KEY]), size)).drop("pos")


def _rows(w, n: int):
    return w.rowsBetween(-(n - 1), 0)


def _full(value: Column, n: int) -> Column:
    return F.when(_pos() >= n - 1, value)


def _ema(df: DataFrame, size: int, first: int = 0, **terms: tuple[str, int]) -> DataFrame:
    """EMA with alpha 2/(n+1), seeded with the value at position ``first``, for each name = (column, n)."""
    def term(x: str, n: int) -> tuple[Column, float]:
        alpha = 2 / (n + 1)
        return F.when(_pos() == first, F.col(x)).when(_pos() > first, alpha * F.col(x)), 1 - alpha
    return series.smoothed(df, [KEY], {out: term(x, n) for out, (x, n) in terms.items()}, size)


def _wilder(df: DataFrame, n: int, w, size: int, first: int = 1, **terms: str) -> DataFrame:
    """Mean of the first n values from ``first`` on, then (prev*(n-1) + x)/n, null before, for each name = column."""
    start = first + n - 1
    df = df.withColumns({f"_mean_{out}": F.avg(x).over(_rows(w, n)) for out, x in terms.items()})
    b = {out: F.when(_pos() == start, F.col(f"_mean_{out}")).when(_pos() > start, F.col(x) / n) for out, x in terms.items()}
    df = series.smoothed(df, [KEY], {out: (value, (n - 1) / n) for out, value in b.items()}, size)
    return df.withColumns({out: F.when(_pos() >= start, F.col(out)) for out in terms}).drop(*[f"_mean_{out}" for out in terms])


def smavg(df: DataFrame, period: int = 20, value: str = "close", name: str = "smavg", **kw) -> DataFrame:
    return _run(_placed(df), period - 1, lambda d, w, _: d.withColumn(
        name, _full(F.avg(value).over(_rows(w, period)), period)), **kw)


def emavg(df: DataFrame, period: int = 20, value: str = "close", name: str = "emavg", **kw) -> DataFrame:
    def build(d, w, size):
        d = _ema(d, size, _e=(value, period))
        return d.withColumn(name, _full(F.col("_e"), period)).drop("_e")
    return _run(_placed(df), 0, build, **kw)


def wmavg(df: DataFrame, period: int = 20, value: str = "close", name: str = "wmavg", **kw) -> DataFrame:
    """Weights 1 to n, the newest row weighs most."""
    def build(d, w, _):
        frame = F.collect_list(value).over(_rows(w, period))
        terms = F.transform(frame, lambda x, i: x * (i + 1))
        total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
        return d.withColumn(name, _full(total / (period * (period + 1) / 2), period))
    return _run(_placed(df), period - 1, build, **kw)


def tmavg(df: DataFrame, period: int = 20, value: str = "close", name: str = "tmavg", **kw) -> DataFrame:
    """Mean of the mean."""
    def build(d, w, _):
        d = d.withColumn("_m", _full(F.avg(value).over(_rows(w, period)), period))
        return d.withColumn(name, _full(F.avg("_m").over(_rows(w, period)), 2 * period - 1)).drop("_m")
    return _run(_placed(df), 2 * (period - 1), build, **kw)


def rsi(df: DataFrame, period: int = 14, value: str = "close", name: str = "rsi", **kw) -> DataFrame:
    def build(d, w, size):
        change = F.col(value) - F.lag(value).over(w)
        d = d.withColumn("_c", change).withColumn("_g", F.greatest("_c", F.lit(0.0)))
        d = d.withColumn("_l", F.when(F.col("_c").isNotNull(), F.greatest(-F.col("_c"), F.lit(0.0))))
        d = d.withColumn("_g", F.when(F.col("_c").isNotNull(), F.col("_g")))
        d = _wilder(d, period, w, size, _ag="_g", _al="_l")
        strength = F.when(F.col("_al") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("_ag") / F.col("_al")))
        return d.withColumn(name, F.when(F.col("_al").isNotNull(), strength)).drop("_c", "_g", "_l", "_ag", "_al")
    return _run(_placed(df), period + 1, build, **kw)


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, value: str = "close", **kw) -> DataFrame:
    if not fast < slow:
        raise ValueError("fast must be shorter than slow")
    def build(d, w, size):
        d = _ema(d, size, _f=(value, fast), _s=(value, slow))
        d = d.withColumn("macd", _full(F.col("_f") - F.col("_s"), slow))
        d = _ema(d, size, first=slow - 1, _g=("macd", signal))
        d = d.withColumn("macd_signal", _full(F.col("_g"), slow + signal - 1))
        return d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop("_f", "_s", "_g")
    return _run(_placed(df), 0, build, **kw)


def mao(df: DataFrame, short: int, long: int, value: str = "close", name: str = "mao", **kw) -> DataFrame:
    return _run(_placed(df), long - 1, lambda d, w, _: d.withColumn(
        name, _full(F.avg(value).over(_rows(w, short)) - F.avg(value).over(_rows(w, long)), long)), **kw)


def momentum(df: DataFrame, period: int, value: str = "close", name: str = "momentum", **kw) -> DataFrame:
    return _run(_placed(df), period, lambda d, w, _: d.withColumn(name, F.col(value) - F.lag(value, period).over(w)), **kw)


def roc(df: DataFrame, period: int, value: str = "close", name: str = "roc", **kw) -> DataFrame:
    return _run(_placed(df), period, lambda d, w, _: d.withColumn(
        name, 100 * (F.col(value) / F.nullif(F.lag(value, period).over(w), F.lit(0.0)) - 1)), **kw)


def boll(
    df: DataFrame, period: int = 20, upper: float = 2.0, lower: float = 2.0, value: str = "close", **kw
) -> DataFrame:
    """Mean, bands of k population deviations, position in the bands and their width."""
    def build(d, w, _):
        frame = _rows(w, period)
        d = d.withColumn("boll_mid", _full(F.avg(value).over(frame), period))
        d = d.withColumn("_sd", _full(F.stddev_pop(value).over(frame), period))
        d = d.withColumn("boll_upper", F.col("boll_mid") + upper * F.col("_sd"))
        d = d.withColumn("boll_lower", F.col("boll_mid") - lower * F.col("_sd"))
        spread = F.nullif(F.col("boll_upper") - F.col("boll_lower"), F.lit(0.0))
        d = d.withColumn("boll_pct", (F.col(value) - F.col("boll_lower")) / spread)
        return d.withColumn("boll_width", F.try_divide(F.col("boll_upper") - F.col("boll_lower"), "boll_mid")).drop("_sd")
    return _run(_placed(df), period - 1, build, **kw)


def true_range(w) -> Column:
    prev = F.lag("close").over(w)
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))


def atr(df: DataFrame, period: int = 14, ma_type: str = "Simple", name: str = "atr", **kw) -> DataFrame:
    if ma_type not in ("Simple", "Wilder"):
        raise ValueError("ma_type must be Simple or Wilder")
    def simple(d, w, _):
        d = d.withColumn("_tr", true_range(w))
        return d.withColumn(name, _full(F.avg("_tr").over(_rows(w, period)), period)).drop("_tr")
    def wilder(d, w, size):
        return _wilder(d.withColumn("_tr", true_range(w)), period, w, size, first=0, **{name: "_tr"}).drop("_tr")
    if ma_type == "Simple":
        return _run(_placed(df), period, simple, **kw)
    return _run(_placed(df), period + 1, wilder, **kw)


def kltn(
    df: DataFrame, period: int = 20, atr_period: int = 10, width: float = 2.0, **kw
) -> DataFrame:
    """EMA of the close with bands of k mean true ranges."""
    def build(d, w, size):
        d = _ema(d, size, _e=("close", period)).withColumn("_tr", true_range(w))
        d = d.withColumn("_atr", F.avg("_tr").over(_rows(w, atr_period)))
        n = max(period, atr_period)
        d = d.withColumn("kltn_mid", _full(F.col("_e"), n))
        d = d.withColumn("kltn_upper", F.col("kltn_mid") + width * F.col("_atr"))
        d = d.withColumn("kltn_lower", F.col("kltn_mid") - width * F.col("_atr"))
        return d.drop("_e", "_tr", "_atr")
    return _run(_placed(df), atr_period + 1, build, **kw)


def mae(df: DataFrame, period: int = 20, pct: float = 0.05, value: str = "close", **kw) -> DataFrame:
    """Mean with an envelope of a fixed share."""
    def build(d, w, _):
        d = d.withColumn("mae_mid", _full(F.avg(value).over(_rows(w, period)), period))
        return d.withColumn("mae_upper", F.col("mae_mid") * (1 + pct)).withColumn("mae_lower", F.col("mae_mid") * (1 - pct))
    return _run(_placed(df), period - 1, build, **kw)


def dmi(df: DataFrame, period: int = 14, **kw) -> DataFrame:
    """Directional movement: +DI, -DI and ADX, smoothed after Wilder."""
    def build(d, w, size):
        up = F.col("high") - F.lag("high").over(w)
        down = F.lag("low").over(w) - F.col("low")
        d = d.withColumn("_u", up).withColumn("_d", down).withColumn("_tr", true_range(w))
        moved = F.col("_u").isNotNull()
        plus = F.when((F.col("_u") > F.col("_d")) & (F.col("_u") > 0), F.col("_u")).otherwise(0.0)
        minus = F.when((F.col("_d") > F.col("_u")) & (F.col("_d") > 0), F.col("_d")).otherwise(0.0)
        d = d.withColumn("_p", F.when(moved, plus)).withColumn("_m", F.when(moved, minus))
        d = _wilder(d, period, w, size, _ps="_p", _ms="_m", _trs="_tr")
        range_ = F.nullif("_trs", F.lit(0.0))
        d = d.withColumn("plus_di", 100 * F.col("_ps") / range_).withColumn("minus_di", 100 * F.col("_ms") / range_)
        both = F.nullif(F.col("plus_di") + F.col("minus_di"), F.lit(0.0))
        dx = F.coalesce(100 * F.abs(F.col("plus_di") - F.col("minus_di")) / both, F.lit(0.0))
        d = d.withColumn("_dx", F.when(_pos() >= period, dx))
        d = _wilder(d, period, w, size, first=period, adx="_dx")
        return d.drop("_u", "_d", "_tr", "_p", "_m", "_ps", "_ms", "_trs", "_dx")
    return _run(_placed(df), 2 * period + 1, build, **kw)


def tas(
    df: DataFrame, period_k: int = 14, period_d: int = 3, period_ds: int = 3, period_dss: int = 3, **kw
) -> DataFrame:
    """Stochastic %K and three successive means of it."""
    def build(d, w, _):
        frame = _rows(w, period_k)
        low, high = F.min("low").over(frame), F.max("high").over(frame)
        d = d.withColumn("_lo", low).withColumn("_hi", high)
        spread = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
        d = d.withColumn("tas_k", _full(100 * (F.col("close") - F.col("_lo")) / spread, period_k)).drop("_lo", "_hi")
        n = period_k
        for src, out, p in (("tas_k", "tas_d", period_d), ("tas_d", "tas_ds", period_ds), ("tas_ds", "tas_dss", period_dss)):
            n += p - 1
            d = d.withColumn(out, _full(F.avg(src).over(_rows(w, p)), n))
        return d
    return _run(_placed(df), period_k + period_d + period_ds + period_dss - 4, build, **kw)


def wlpr(df: DataFrame, period: int = 14, name: str = "wlpr", **kw) -> DataFrame:
    """Williams %R."""
    def build(d, w, _):
        frame = _rows(w, period)
        d = d.withColumn("_lo", F.min("low").over(frame)).withColumn("_hi", F.max("high").over(frame))
        spread = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
        return d.withColumn(name, _full(-100 * (F.col("_hi") - F.col("close")) / spread, period)).drop("_lo", "_hi")
    return _run(_placed(df), period - 1, build, **kw)


def maxmin(df: DataFrame, period: int = 20, **kw) -> DataFrame:
    """Rolling high and low."""
    return _run(_placed(df), period - 1, lambda d, w, _: d.withColumn(
        "max_high", _full(F.max("high").over(_rows(w, period)), period)).withColumn(
        "min_low", _full(F.min("low").over(_rows(w, period)), period)), **kw)


def cmci(df: DataFrame, period: int = 20, constant: float = 0.015, name: str = "cmci", **kw) -> DataFrame:
    """Commodity channel index of the typical price."""
    def build(d, w, _):
        frame = _rows(w, period)
        d = d.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
        d = d.withColumn("_m", F.avg("_tp").over(frame)).withColumn("_all", F.collect_list("_tp").over(frame))
        spread = F.aggregate("_all", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("_m"))) / period
        index = (F.col("_tp") - F.col("_m")) / F.nullif(constant * spread, F.lit(0.0))
        return d.withColumn(name, _full(index, period)).drop("_tp", "_m", "_all")
    return _run(_placed(df), period - 1, build, **kw)


def _money_flow() -> Column:
    spread = F.col("high") - F.col("low")
    share = ((F.col("close") - F.col("low")) - (F.col("high") - F.col("close"))) / F.nullif(spread, F.lit(0.0))
    return F.coalesce(share, F.lit(0.0)) * F.col("volume")


def _accumulated(df: DataFrame, name: str) -> DataFrame:
    order, bucket = _axis(df)
    totals = {"pos": F.lit(1).cast("bigint"), name: _money_flow()}
    return series.with_running(df, [KEY], order, bucket, totals).withColumn("pos", _pos() - 1)


def ado(df: DataFrame, name: str = "ado") -> DataFrame:
    """Accumulation/distribution: running money flow."""
    return _accumulated(df, name).drop("pos")


def chko(df: DataFrame, fast: int = 3, slow: int = 10, name: str = "chko", **kw) -> DataFrame:
    """Fast minus slow EMA of accumulation/distribution."""
    def build(d, w, size):
        d = _ema(d, size, _f=("_ad", fast), _s=("_ad", slow))
        return d.withColumn(name, _full(F.col("_f") - F.col("_s"), slow)).drop("_ad", "_f", "_s")
    return _run(_accumulated(df, "_ad"), 0, build, **kw)


def goc(df: DataFrame, conversion: int = 9, base: int = 26, span: int = 52, **kw) -> DataFrame:
    """Ichimoku lines; the spans are shifted by the base period, the lagging line backwards."""
    def middle(w, n):
        return _full((F.max("high").over(_rows(w, n)) + F.min("low").over(_rows(w, n))) / 2, n)
    def build(d, w, _):
        d = d.withColumn("goc_conversion", middle(w, conversion)).withColumn("goc_base", middle(w, base))
        d = d.withColumn("_a", (F.col("goc_conversion") + F.col("goc_base")) / 2).withColumn("_b", middle(w, span))
        d = d.withColumn("goc_span_a", F.lag("_a", base).over(w)).withColumn("goc_span_b", F.lag("_b", base).over(w))
        return d.withColumn("goc_lagging", F.lead("close", base).over(w)).drop("_a", "_b")
    return _run(_placed(df), span + base, build, after=base, **kw)


def pivot(df: DataFrame, **kw) -> DataFrame:
    """Floor pivots of the prior bar."""
    def build(d, w, _):
        h, l, c = (F.lag(x).over(w) for x in ("high", "low", "close"))
        d = d.withColumn("_h", h).withColumn("_l", l).withColumn("pivot", (F.col("_h") + F.col("_l") + c) / 3)
        p, h, l = F.col("pivot"), F.col("_h"), F.col("_l")
        return (
            d.withColumn("r1", 2 * p - l).withColumn("s1", 2 * p - h)
            .withColumn("r2", p + (h - l)).withColumn("s2", p - (h - l)).drop("_h", "_l")
        )
    return _run(_placed(df), 1, build, **kw)


PTPS_BLOCK = 1_000_000


def _stop_batches(step: float, cap: float, columns: list[str]):
    """Batch function of the parabolic stop over rows sorted by (ticker, pos).

    Rows with ``_own`` false only supply the two bars before a block, whose
    carried state arrives in the ``_c_`` columns.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, bars, trend, sar, ep, af = None, [], None, None, None, None
        for pdf in batches:
            out = {"trend": [], "sar": [], "ep": [], "af": []}
            carried = zip(pdf["_c_trend"], pdf["_c_sar"], pdf["_c_ep"], pdf["_c_af"])
            for k, pos, own, h, l, c, carry in zip(
                pdf[KEY], pdf["pos"], pdf["_own"], pdf["high"], pdf["low"], pdf["close"], carried
            ):
                if k != key:
                    key, bars, trend = k, [], None
                    if carry[0] == carry[0] and carry[0] is not None:
                        trend, sar, ep, af = int(carry[0]), carry[1], carry[2], carry[3]
                if own and pos == 1:
                    h0, l0, c0 = bars[-1]
                    trend = 1 if c >= c0 else -1
                    sar = l0 if trend > 0 else h0
                    ep, af = (max(h0, h) if trend > 0 else min(l0, l)), step
                elif own and pos > 1:
                    (h2, l2, _), (h1, l1, _) = bars[-2], bars[-1]
                    sar = sar + af * (ep - sar)
                    sar = min(sar, l1, l2) if trend > 0 else max(sar, h1, h2)
                    crossed = l < sar if trend > 0 else h > sar
                    if crossed:
                        sar, trend, af = ep, -trend, step
                        ep = l if trend < 0 else h
                    elif (trend > 0 and h > ep) or (trend < 0 and l < ep):
                        ep, af = (h if trend > 0 else l), min(af + step, cap)
                bars = [*bars[-1:], (h, l, c)]
                known = own and pos >= 1
                out["trend"].append(trend if known else None)
                for name, v in (("sar", sar), ("ep", ep), ("af", af)):
                    out[name].append(v if known else None)
            res = pdf[columns].copy()
            res["_trend"] = pd.array(out["trend"], dtype="Int32")
            for name in ("sar", "ep", "af"):
                res[f"_{name}"] = pd.array(out[name], dtype="Float64")
            yield res[pdf["_own"].to_numpy(dtype=bool)]
    return run


def ptps(df: DataFrame, step: float = 0.02, cap: float = 0.20, block_rows: int = PTPS_BLOCK) -> DataFrame:
    """Parabolic stop-and-reverse: stop level and trend (1 up, -1 down).

    The stop depends on its whole past, so blocks of a series run one after
    the other, all tickers side by side, and only the state at the end of a
    block travels on. Daily series fit one block; a longer one takes as many
    rounds as it has blocks, each written out before the next.
    """
    spark = df.sparkSession
    placed = _placed(df)
    blocks = series.in_blocks(placed, [KEY], 2, block_rows=block_rows)
    longest = placed.agg(F.max("pos")).first()[0]
    if longest is None:
        longest = 0
    rounds = int(longest) // block_rows + 1
    columns = [*df.columns, "pos"]
    state = "_trend int, _sar double, _ep double, _af double"
    schema = T.StructType([placed.schema[c] for c in columns] + list(T.StructType.fromDDL(state)))
    carry_names = ["_c_trend", "_c_sar", "_c_ep", "_c_af"]

    def one_round(part: DataFrame) -> DataFrame:
        part = part.repartition(KEY).sortWithinPartitions(KEY, "pos")
        return part.mapInPandas(_stop_batches(step, cap, columns), schema)

    def finish(out: DataFrame) -> DataFrame:
        return out.withColumnsRenamed({"_sar": "ptps", "_trend": "ptps_trend"}).drop("_ep", "_af", "pos")

    if rounds == 1:
        blank = [F.lit(None).cast("double").alias(c) for c in carry_names]
        return finish(one_round(blocks.select("*", *blank)))
    folder = work_dir(spark, "ptps")
    carry = None
    for i in range(rounds):
        part = blocks.where(F.col("_blk") == i)
        if carry is None:
            part = part.select("*", *[F.lit(None).cast("double").alias(c) for c in carry_names])
        else:
            part = series.null_safe(part, carry, [KEY], "left")
        path = f"{folder}/round={i}"
        one_round(part).write.mode("overwrite").parquet(path)
        done = spark.read.schema(schema).parquet(path)
        carry = done.where(_pos() == (i + 1) * block_rows - 1).select(
            KEY, F.col("_trend").cast("double").alias("_c_trend"), F.col("_sar").alias("_c_sar"),
            F.col("_ep").alias("_c_ep"), F.col("_af").alias("_c_af"),
        )
    return finish(spark.read.schema(schema).parquet(*[f"{folder}/round={i}" for i in range(rounds)]))


HURST_BLOCK, HURST_FAN = 1 << 16, 1 << 12
_HURST_NODE = "count long, sum double, mean double, m2 double, upper array<struct<x: double, y: double>>, lower array<struct<x: double, y: double>>"


def _hull(x: np.ndarray, y: np.ndarray, sign: int) -> np.ndarray:
    """Places of the corners of the upper (sign 1) or lower (-1) hull of points in order of x.

    A point on or under the line between its neighbours is no corner; all such
    points are left out at once, again and again.
    """
    at = np.arange(len(x))
    while len(at) > 2:
        a, b, c = at[:-2], at[1:-1], at[2:]
        corner = sign * ((x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])) < 0
        if corner.all():
            break
        at = at[np.concatenate(([True], corner, [True]))]
    return at


@dataclasses.dataclass
class _Chunk:
    """Summary of ``n`` returns in a row: enough to give their rescaled range, and to be joined with the next ``n``.

    The range is that of the partial sums less a straight line. Whatever the
    line, it is reached at corners of the hulls of (number, partial sum).
    """
    n: int
    count: int
    sum: float
    mean: float
    m2: float
    upper: np.ndarray
    lower: np.ndarray

    @staticmethod
    def of(returns: np.ndarray) -> _Chunk:
        known = returns[~np.isnan(returns)]
        x, y = np.arange(1.0, len(returns) + 1), np.cumsum(np.nan_to_num(returns))
        mean = known.mean() if len(known) else 0.0
        hulls = [np.column_stack((x, y))[_hull(x, y, sign)] for sign in (1, -1)]
        return _Chunk(len(returns), len(known), float(y[-1]), float(mean), float(((known - mean) ** 2).sum()), *hulls)

    def and_next(self, other: _Chunk) -> _Chunk:
        count = self.count + other.count
        gap = other.mean - self.mean
        mean = self.mean + gap * other.count / count if count else 0.0
        m2 = self.m2 + other.m2 + (gap * gap * self.count * other.count / count if count else 0.0)
        hulls = []
        for sign, a, b in ((1, self.upper, other.upper), (-1, self.lower, other.lower)):
            both = np.concatenate((a, b + (self.n, self.sum)))
            hulls.append(both[_hull(both[:, 0], both[:, 1], sign)])
        return _Chunk(self.n + other.n, count, self.sum + other.sum, mean, m2, *hulls)

    def rescaled_range(self) -> float:
        drift = self.sum / self.n
        spread = math.sqrt(self.m2 / self.count) if self.count else 0.0
        high = (self.upper[:, 1] - drift * self.upper[:, 0]).max()
        low = (self.lower[:, 1] - drift * self.lower[:, 0]).min()
        return (high - low) / spread if spread else math.nan


def _ranges(returns: np.ndarray, n: int) -> np.ndarray:
    """Rescaled ranges of all full chunks of ``n`` returns; nan where they do not vary."""
    chunks = returns[: len(returns) // n * n].reshape(-1, n)
    known = ~np.isnan(chunks)
    filled = np.where(known, chunks, 0.0)
    sums = filled.cumsum(axis=1)
    walk = sums - sums[:, -1:] / n * np.arange(1, n + 1)
    count = np.maximum(known.sum(axis=1), 1)
    mean = filled.sum(axis=1) / count
    spread = np.sqrt((np.where(known, chunks - mean[:, None], 0.0) ** 2).sum(axis=1) / count)
    return np.where(spread > 0, (walk.max(axis=1) - walk.min(axis=1)) / np.where(spread > 0, spread, 1.0), np.nan)


def _groups(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[pa.Table]:
    """Whole groups of equal ``by`` from batches sorted by them; a group may span batches."""
    held, at = [], None
    for batch in batches:
        # numbers of the groups' names within the batch, null a name like any other
        codes = [batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy() for c in by]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            if a == b:
                continue
            name = tuple(batch.column(c)[a].as_py() for c in by)
            if held and name != at:
                yield pa.Table.from_batches(held)
                held = []
            at = name
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _chunk_rows(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from pa.Table.from_pylist(rows, schema).to_batches()


def _node(chunk: _Chunk, **place) -> dict:
    corners = lambda h: [{"x": x, "y": y} for x, y in h.tolist()]
    return place | {"n": chunk.n, "count": chunk.count, "sum": chunk.sum, "mean": chunk.mean, "m2": chunk.m2, "upper": corners(chunk.upper), "lower": corners(chunk.lower)}


def _total(n: int, ranges: Sequence[float], **place) -> dict:
    found = [r for r in ranges if r == r]
    return place | {"n": n, "total": float(sum(found)), "found": len(found)}


def _block_levels(block: int, smallest: int, schema: pa.Schema):
    """Blocks of returns -> totals of their chunk lengths, and a summary where a block is full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for table in _groups(batches, KEY, "_blk"):
            own = table["_own"].to_numpy() & (table["_i"].to_numpy() >= 0)
            returns = table["_r"].to_numpy()[own].astype(float)
            place = {KEY: table[KEY][0].as_py(), "_blk": table["_blk"][0].as_py()}
            rows.append(place | {"n": 0, "total": 0.0, "found": len(returns)})
            n = smallest
            while n <= min(block, len(returns)):
                rows.append(_total(n, _ranges(returns, n).tolist(), **place))
                n *= 2
            if len(returns) == block:
                rows.append(_node(_Chunk.of(returns), **place))
            if len(rows) > 1000:
                yield from _chunk_rows(rows, schema)
                rows = []
        yield from _chunk_rows(rows, schema)
    return run


def _merged_levels(fan: int, schema: pa.Schema):
    """Totals pass; summaries of up to ``fan`` neighbours give totals of the doubled lengths, and a summary where all are there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = []
        for batch in batches:
            is_total = batch.column("upper").is_null()
            yield batch.filter(is_total).select(schema.names)
            summaries.append(batch.filter(pc.invert(is_total)))
        rows = []
        for table in _groups(iter(summaries), KEY, "_up"):
            place, nodes = {KEY: table[KEY][0].as_py(), "_blk": table["_up"][0].as_py()}, {}
            for row in table.to_pylist():
                hulls = [np.array([(p["x"], p["y"]) for p in row[c]]) for c in ("upper", "lower")]
                nodes[row["_blk"] % fan] = _Chunk(row["n"], row["count"], row["sum"], row["mean"], row["m2"], *hulls)
            width = fan
            while width > 1 and nodes:
                nodes, width = {k // 2: nodes[k].and_next(nodes[k + 1]) for k in nodes if k % 2 == 0 and k + 1 in nodes}, width // 2
                if nodes:
                    rows.append(_total(next(iter(nodes.values())).n, [c.rescaled_range() for c in nodes.values()], **place))
            rows += [_node(c, **place) for c in nodes.values()]
        yield from _chunk_rows(rows, schema)
    return run


def hurst(df: DataFrame, value: str = "close", smallest: int = 8, block: int = HURST_BLOCK, fan: int = HURST_FAN) -> DataFrame:
    """Rescaled-range exponent per ticker of its log returns.

    For chunk lengths n = 8, 16, 32, ... up to half the series, the mean of
    range over deviation of all full chunks; the exponent is the slope of its
    logarithm on log n. Every length is worked out once: those up to ``block``
    rows (a power of two times ``smallest``) in the task that holds the block,
    longer ones from summaries of the chunks half as long, ``fan`` of them at a
    time. Two such rounds reach ``block * fan * fan`` rows, 2**40 as it stands.
    """
    if block % smallest or (block // smallest) & (block // smallest - 1) or fan & (fan - 1):
        raise ValueError("block must be a power of two times smallest, fan a power of two")
    # returns are numbered from 0: the first row has none
    placed = _placed(df).withColumn("_i", _pos() - 1).select(KEY, "_i", F.col(value).alias("_x"))
    blocks = series.in_blocks(placed, [KEY], 1, pos="_i", block_rows=block)
    w = series.block_window([KEY], "_i")
    returns = blocks.withColumn("_r", F.log(F.try_divide("_x", F.lag("_x").over(w)))).select(KEY, "_blk", "_i", "_own", "_r")
    key_type = df.schema[KEY].dataType.simpleString()
    ddl = f"{KEY} {key_type}, _blk long, n long, total double, found long, {_HURST_NODE}"
    schema = to_arrow_schema(T._parse_datatype_string(ddl))
    levels = returns.sortWithinPartitions(KEY, "_blk", "_i").mapInArrow(_block_levels(block, smallest, schema), ddl)
    for _ in range(2):
        near = levels.withColumn("_up", F.expr(f"_blk div {fan}")).repartition(KEY, "_up").sortWithinPartitions(KEY, "_up")
        levels = near.mapInArrow(_merged_levels(fan, schema), ddl)
    totals = levels.where("upper IS NULL").groupBy(KEY, "n").agg(F.sum("total").alias("_total"), F.sum("found").alias("_found"))
    # length 0 stands for the number of returns; a ticker has one row per length
    size = F.max(F.when(F.col("n") == 0, F.col("_found"))).over(Window.partitionBy(KEY))
    means = totals.withColumn("_n", size).where((F.col("n") > 0) & (F.col("n") * 2 <= F.col("_n")) & (F.col("_found") > 0))
    means = means.withColumn("_rs", F.col("_total") / F.col("_found")).where("_rs > 0")
    return means.groupBy(KEY).agg(F.regr_slope(F.log("_rs"), F.log("n")).alias("hurst"))


STUDIES: dict[str, Callable[..., DataFrame]] = {
    "smavg": smavg, "emavg": emavg, "wmavg": wmavg, "tmavg": tmavg, "rsi": rsi, "macd": macd, "mao": mao,
    "momentum": momentum, "roc": roc, "boll": boll, "kltn": kltn, "mae": mae, "dmi": dmi, "atr": atr, "tas": tas,
    "wlpr": wlpr, "maxmin": maxmin, "cmci": cmci, "ptps": ptps, "ado": ado, "chko": chko, "goc": goc, "pivot": pivot,
    "hurst": hurst,
}


def study(df: DataFrame, name: str, **params) -> DataFrame:
    """Run a study by name or alias with its default parameters."""
    key = name.lower().replace("-", "_").replace(" ", "_")
    key = refdata.STUDY_ALIASES.get(key, key)
    if key not in STUDIES:
        raise ValueError(f"unknown study {name!r}; available: {', '.join(ta_studies())}")
    return STUDIES[key](df, **{**refdata.STUDY_DEFAULTS.get(key, {}), **params})


def concat_studies(results: Sequence[DataFrame]) -> DataFrame:
    """One table from several study results; columns a result lacks are null."""
    if not results:
        raise ValueError("no study returned a result")
    out = results[0]
    for df in results[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
