"""Dates, clock times, offsets and time zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_YMD = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$"
_DMY = r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"


def _date_of(text: Column, pattern: str, y: int, m: int, d: int) -> Column:
    parts = [F.regexp_extract(text, pattern, g) for g in (y, m, d)]
    return F.when(text.rlike(pattern), F.concat_ws("-", *parts).try_cast("date"))


def parse_date(text: Column) -> Column:
    """Date from y-m-d, yyyymmdd, y/m/d, d-m-y or d/m/y text; null if none fits."""
    t = F.trim(text)
    return F.coalesce(
        _date_of(t, _YMD, 1, 3, 4), _date_of(t, _COMPACT, 1, 2, 3), _date_of(t, _DMY, 4, 3, 1)
    )


def parse_any_date(text: Column) -> Column:
    """As ``parse_date``, else the first ten characters (drops a clock part)."""
    t = F.trim(text)
    return F.when(t != "", F.coalesce(parse_date(t), parse_date(F.substring(t, 1, 10))))


def fmt_date(date: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(date, fmt)


def date_offset(offset: Column, as_of: Column) -> Column:
    """``as_of`` moved by ``-2d``, ``1w``, ``-3m`` (30 days each) or ``-4h``."""
    pattern = r"^(-?\d+)([dwmh])$"
    n = F.regexp_extract(offset, pattern, 1).try_cast("int")
    unit = F.regexp_extract(offset, pattern, 2)
    hours = n * F.when(unit == "h", 1).when(unit == "d", 24).when(unit == "w", 168).otherwise(720)
    zero = F.lit(0)
    return F.when(
        offset.rlike(pattern), as_of + F.make_dt_interval(zero, hours, zero, F.lit(0).cast("decimal(18,6)"))
    )


_CLOCK = r"^(?:(\d{1,2}):(\d{1,2})(?::\d{1,2}(?:\.\d+)?)?|(\d{2})(\d{2}))$"


def clock_minutes(hhmm: Column) -> Column:
    """Minutes since midnight of ``H:MM``, ``HH:MM[:SS]`` or ``HHMM``; null if out of range."""
    t = F.trim(hhmm)
    # a group that takes no part in the match is empty text
    part = lambda a, b: F.concat(F.regexp_extract(t, _CLOCK, a), F.regexp_extract(t, _CLOCK, b)).try_cast("int")
    hour, minute = part(1, 3), part(2, 4)
    return F.when((hour <= 23) & (minute <= 59), hour * 60 + minute)


def clock_text(minutes: Column) -> Column:
    """``HH:MM`` of minutes since midnight, modulo one day."""
    m = F.pmod(minutes, F.lit(1440))
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(two(F.floor(m / 60)), F.lit(":"), two(F.pmod(m, F.lit(60))))


def parse_hhmm(text: Column) -> Column:
    return clock_text(clock_minutes(text))


def add_minutes(hhmm: Column, n: Column | int) -> Column:
    return clock_text(clock_minutes(hhmm) + (n if isinstance(n, Column) else F.lit(n)))


def parse_futures_hours(text: Column) -> Column:
    """First ``HH:MM-HH:MM`` or ``HHMM-HHMM`` range as struct<start,end>."""
    pattern = r"^\s*(\d{1,2}:?\d{2})\s*-\s*(\d{1,2}:?\d{2})"
    start = parse_hhmm(F.regexp_extract(text, pattern, 1))
    end = parse_hhmm(F.regexp_extract(text, pattern, 2))
    return F.when(start.isNotNull() & end.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def local_to_utc(local: Column, zone: Column) -> Column:
    """UTC instant of a wall-clock timestamp; null where it does not exist or is ambiguous.

    A time whose zone has the same offset a day earlier and a day later is
    certain; only the others are tried against the neighbouring offsets. For
    costly ``local`` expressions use ``with_utc``, which computes each step once.
    """
    utc = F.to_utc_timestamp(local, zone)
    shown = lambda minutes: F.from_utc_timestamp(utc + F.expr(f"interval '{minutes}' minute"), zone)
    day = F.expr("interval '1440' minute")
    calm = (shown(-1440) == local - day) & (shown(1440) == local + day)
    exists = F.from_utc_timestamp(utc, zone) == local
    repeated = (shown(60) == local) | (shown(-60) == local) | (shown(30) == local) | (shown(-30) == local)
    return F.when(calm, utc).when(exists & ~repeated, utc)


def with_utc(df: DataFrame, out: str, local: Column, zone: Column) -> DataFrame:
    """Add the UTC instant of a wall-clock expression, computed in steps so none is repeated."""
    staged = df.withColumn("_local", local).withColumn("_zone", zone)
    return staged.withColumn(out, local_to_utc(F.col("_local"), F.col("_zone"))).drop("_local", "_zone")


def wall_to_utc(text: Column, zone: Column) -> Column:
    """UTC instant of date or date-time text; an offset in the text wins over ``zone``."""
    t = F.trim(text)
    has_offset = t.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d{2}:\d{2}")
    return F.when(has_offset, t.try_cast("timestamp")).otherwise(
        local_to_utc(t.try_cast("timestamp_ntz").cast("timestamp"), zone)
    )


def at_clock(date: Column, minutes: Column) -> Column:
    """Wall-clock timestamp of minutes since midnight on a date."""
    zero = F.lit(0)
    return date.cast("timestamp") + F.make_dt_interval(zero, zero, minutes, F.lit(0).cast("decimal(18,6)"))


def session_time_to_utc(date: Column, hhmm: Column, zone: Column) -> Column:
    """UTC instant of a clock time on ``date``; start and end share the date."""
    return local_to_utc(at_clock(date, clock_minutes(hhmm)), zone)


def zone_to_zone(date: Column, hhmm: Column, source: Column, target: Column) -> Column:
    """``HH:MM`` in ``target`` of a clock time in ``source`` on ``date``."""
    return F.date_format(F.from_utc_timestamp(session_time_to_utc(date, hhmm, source), target), "HH:mm")


def offset_text(utc: Column, zone: Column) -> Column:
    """``+HH:MM`` offset of ``zone`` at an instant."""
    minutes = (F.unix_timestamp(F.from_utc_timestamp(utc, zone)) - F.unix_timestamp(utc)) / 60
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, clock_text(F.abs(minutes)))


def timezone_alias(name: Column, exchange_zone: Column) -> Column:
    """IANA zone of UTC, local, exchange, NY, LN, TK, HK or an IANA name; null otherwise."""
    key = F.upper(F.trim(name))
    return (
        F.when(key == "UTC", F.lit("UTC"))
        .when(key.isin("LOCAL", "EXCHANGE"), exchange_zone)
        .when(key == "NY", F.lit("America/New_York"))
        .when(key == "LN", F.lit("Europe/London"))
        .when(key == "TK", F.lit("Asia/Tokyo"))
        .when(key == "HK", F.lit("Asia/Hong_Kong"))
        .when(F.trim(name).rlike(r"^[A-Za-z_]+/[A-Za-z_/+-]+$"), F.trim(name))
    )
