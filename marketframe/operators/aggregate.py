"""Bars, VWAP, percentages, periodicity and other aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions import values
from marketframe.operators.asof import as_of
from marketframe.operators.series import spread_join, with_running


def bar_columns(time: str = "time", seq: str | None = "event_id") -> list[Column]:
    """Open, high, low, close, volume and event count of a group of trades.

    ``seq`` orders trades of the same instant. Where a ticker's times are
    unique, None saves the sort a two-part order costs.
    """
    at = F.struct(time, seq) if seq else F.col(time)
    return [
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", at).alias("close"), F.sum("size").cast("double").alias("volume"),
        F.count(F.lit(1)).cast("int").alias("numEvents"),
    ]


def bars_from_ticks(
    ticks: DataFrame, interval: int, seconds: bool = False, typ: str = "TRADE", seq: str | None = "event_id"
) -> DataFrame:
    """OHLCV bars of ``interval`` minutes (or seconds) from ticks of one type.

    All parts of a bar combine on the map side, so the busiest ticker sends
    one row per bar and task.
    """
    if interval < 1:
        raise ValueError("interval must be at least 1")
    width = f"{interval} {'seconds' if seconds else 'minutes'}"
    grouped = ticks.where(F.col("type") == typ).groupBy("ticker", F.window("time", width).alias("w"))
    bars = grouped.agg(*bar_columns(seq=seq))
    return bars.select("ticker", F.col("w.start").alias("time"), "open", "high", "low", "close", "volume", "numEvents")


def clock_between(time: Column, start: str | None, end: str | None) -> Column:
    """Time of day within [start, end] given as HH:MM or HH:MM:SS, both instants included; a window may cross midnight."""
    def micros(clock: str) -> int:
        parts = [int(p) for p in clock.split(":")]
        return sum(p * unit for p, unit in zip(parts, (3_600_000_000, 60_000_000, 1_000_000)))

    clock = F.unix_micros(time.cast("timestamp")) - F.unix_micros(F.date_trunc("day", time.cast("timestamp")))
    if start is None or end is None:
        return F.lit(True) if start is None and end is None else (clock >= micros(start) if start else clock <= micros(end))
    if micros(start) <= micros(end):
        return clock.between(micros(start), micros(end))
    return (clock >= micros(start)) | (clock <= micros(end))


def vwap(
    ticks: DataFrame, start_time: str | None = None, end_time: str | None = None,
    keys: Sequence[str] = ("ticker",), typ: str = "TRADE",
) -> DataFrame:
    """Volume-weighted price, volume and turnover, optionally of a time-of-day window."""
    rows = ticks.where((F.col("type") == typ) & clock_between(F.col("time"), start_time, end_time))
    amount = F.sum(F.col("value") * F.col("size"))
    volume = F.sum("size")
    return rows.groupBy(*keys).agg(
        (amount / F.nullif(volume, F.lit(0))).alias("vwap"), volume.alias("volume"), amount.alias("turnover")
    )


def level_percentages(
    df: DataFrame, values: str | Sequence[str], level: str = "level", pos: str = "pos", key: str = "ticker",
    bucket_rows: int = 65536,
) -> DataFrame:
    """Share of each row in its level, in percent, as ``<value>_pct`` columns.

    Level 1: of all level 1 rows of the ticker. Level 2: of the level 2 rows
    under the same preceding level 1 row. Other levels, leading level 2 rows,
    null values and zero sums give null. ``pos`` starts near zero per ticker
    and cuts a ticker into buckets.
    """
    names = [values] if isinstance(values, str) else list(values)
    is_parent, is_child = F.col(level) == 1, F.col(level) == 2
    parent = F.when(is_parent, 1).otherwise(0).cast("bigint")
    rows = with_running(df, [key], [F.col(pos)], F.expr(f"{pos} div {bucket_rows}"), {"_gid": parent})
    span = [F.min(pos).alias("_lo"), F.max(pos).alias("_hi")]
    # one aggregate per (ticker, parent) feeds both sums
    groups = rows.groupBy(key, "_gid").agg(
        *[F.sum(F.when(is_parent, F.col(v))).alias(f"_p{i}") for i, v in enumerate(names)],
        *[F.sum(F.when(is_child, F.col(v))).alias(f"_c{i}") for i, v in enumerate(names)], *span,
    )
    totals = groups.groupBy(key).agg(
        *[F.sum(f"_p{i}").alias(f"_t{i}") for i in range(len(names))], F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    # totals meet the small groups first, so the rows are joined only once
    groups = spread_join(groups.drop(*[f"_p{i}" for i in range(len(names))]), totals, [key], "_lo")
    rows = spread_join(rows, groups, [key, "_gid"], pos)
    share = lambda v, i: F.when(is_parent, 100 * F.col(v) / F.nullif(f"_t{i}", F.lit(0.0))).when(
        is_child & (F.col("_gid") > 0), 100 * F.col(v) / F.nullif(f"_c{i}", F.lit(0.0)))
    rows = rows.withColumns({f"{v}_pct": share(v, i) for i, v in enumerate(names)})
    return rows.drop("_gid", *[f"_{x}{i}" for x in "tc" for i in range(len(names))])


def level_group_id(
    df: DataFrame, level: str = "level", pos: str = "pos", key: str = "ticker", bucket_rows: int = 65536
) -> DataFrame:
    """Running count of level 1 rows."""
    parent = F.when(F.col(level) == 1, 1).otherwise(0).cast("bigint")
    return with_running(df, [key], [F.col(pos)], F.expr(f"{pos} div {bucket_rows}"), {"gid": parent})


def last_write_wins(df: DataFrame, keys: Sequence[str], pos: str, value: str = "value") -> DataFrame:
    """Value of the last row per key, null included."""
    return df.groupBy(*keys).agg(F.max_by(value, pos).alias(value))


def latest_point(hist: DataFrame, field: str, end: Column, lookback: int, pos: str | None = None) -> DataFrame:
    """Latest dated numeric value per ticker up to ``end``; text that is no number is skipped."""
    number = values.clean_value(F.col("value").cast("string")).try_cast("double")
    rows = hist.where(
        (F.upper("field") == field.upper()) & F.col("date").between(F.date_sub(end, lookback), end)
    ).withColumn("_n", number).where(F.col("_n").isNotNull() & ~F.isnan("_n"))
    order = F.struct("date", pos) if pos else F.col("date")
    return rows.groupBy("ticker").agg(F.max("date").alias("date"), F.max_by("_n", order).alias("value"))


def latest_points(points: DataFrame, hist: DataFrame, field: str, lookback: int, pos: str | None = None) -> DataFrame:
    """Latest dated numeric value of each point's ticker up to its ``dt``: ``points`` with date and value, null where there is none.

    Of a doubled cell the last row by ``pos`` counts, or the largest value
    without positions.
    """
    number = values.clean_value(F.col("value").cast("string")).try_cast("double")
    rows = hist.where(F.upper("field") == field.upper()).withColumn("_n", number).where(F.col("_n").isNotNull() & ~F.isnan("_n"))
    cells = rows.groupBy("ticker", F.col("date").alias("_seen")).agg((F.max_by("_n", pos) if pos else F.max("_n")).alias("value"))
    return as_of(points, cells, "ticker", "dt", ["value"], lookback, value_day="_seen", at="date")


def first_seen_distinct(df: DataFrame, col: str, pos: str) -> DataFrame:
    """Distinct values with the position of their first appearance."""
    return df.groupBy(col).agg(F.min(pos).alias("first_pos"))


def date_span(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """First and last date, or the given fallback where there is none."""
    return df.agg(
        F.coalesce(F.min(col), F.lit(start).cast("date")).alias("start"),
        F.coalesce(F.max(col), F.lit(end).cast("date")).alias("end"),
    )


PERIODS = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}


def periodicity(hist: DataFrame, period: str) -> DataFrame:
    """Last point of each day, week, month, quarter or year, dated by itself."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}")
    keys = ["ticker", "field"] if "field" in hist.columns else ["ticker"]
    vals = [c for c in hist.columns if c not in (*keys, "date")]
    bucket = F.date_trunc(PERIODS[period], F.col("date")).cast("date").alias("period")
    last = hist.groupBy(*keys, bucket).agg(
        F.max("date").alias("date"), F.max_by(F.struct(*vals), "date").alias("_v")
    )
    return last.select(*keys, "period", "date", *[F.col(f"_v.{c}").alias(c) for c in vals])


def fill_forward(
    hist: DataFrame, start=None, end=None, days: str = "A", fill: str = "P", keys: Sequence[str] = ("ticker", "field"),
    value: str = "value",
) -> DataFrame:
    """One row per calendar day (``A``) or weekday (``W``) from a series' first to last date.

    A day without a point takes the previous value (``P``) or null (``N``).
    Each point spans the days up to the next one, so no calendar join and no
    window over whole series is needed: the series is cut into year buckets,
    and each bucket ends with the first date of the next one.
    """
    if days not in ("A", "W") or fill not in ("P", "N"):
        raise ValueError("days must be A or W, fill must be P or N")
    keys = list(keys)
    points = (hist.where(F.col(value).isNotNull()) if fill == "P" else hist).select(*keys, "date", value)
    points = points.withColumn("_year", F.year("date")).withColumn("_end", F.lit(0))
    firsts = points.groupBy(*keys, "_year").agg(F.min("date").alias("date"))
    later = F.lead("date").over(Window.partitionBy(*keys).orderBy("_year"))
    ends = firsts.select(*keys, "_year", later.alias("date"), F.lit(1).alias("_end")).where("date is not null")
    inside = Window.partitionBy(*keys, "_year").orderBy("_end", "date")
    merged = points.unionByName(ends, allowMissingColumns=True)
    spans = merged.withColumn("_next", F.lead("date").over(inside)).where(F.col("_end") == 0)
    stop = F.coalesce(F.date_sub("_next", 1), F.lit(end).cast("date"), F.col("date"))
    stop = F.greatest(stop, F.col("date"))
    out = spans.withColumn("day", F.explode(F.sequence(F.col("date"), stop)))
    if start is not None:
        out = out.where(F.col("day") >= F.lit(start).cast("date"))
    if days == "W":
        out = out.where(F.weekday("day") < 5)
    filled = F.col(value) if fill == "P" else F.when(F.col("day") == F.col("date"), F.col(value))
    return out.select(*keys, F.col("day").alias("date"), filled.alias(value))


def group_sum(opts: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    return opts.groupBy(*keys).agg(F.sum(col).alias(f"sum_{col}"))


def latest_first(df: DataFrame, keys: Sequence[str], date: str = "date", tie: str | None = None) -> DataFrame:
    """First row per key in descending date order."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(date, tie) if tie else F.col(date)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def argmax_volume(front: Column, second: Column, front_volume: Column, second_volume: Column) -> Column:
    """The contract with the larger volume; a tie or no volume at all gives the front one."""
    return (
        F.when(front_volume.isNull() & second_volume.isNotNull(), second)
        .when(second_volume > front_volume, second)
        .otherwise(front)
    )


def sort_by_maturity(df: DataFrame, expiry: str, tie: str) -> DataFrame:
    return df.orderBy(expiry, tie)


def max_results(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of an order (a top-k report)."""
    return df.orderBy(*order).limit(n)


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    return df.unionByName(more, allowMissingColumns=True)


def topics_add(active: DataFrame, new: DataFrame) -> DataFrame:
    """Active topics with new ones added; adding twice changes nothing."""
    return active.select("topic").union(new.select("topic")).distinct()


def topics_remove(active: DataFrame, gone: DataFrame) -> DataFrame:
    return active.join(gone.select("topic"), "topic", "left_anti")
