"""Exchange sessions, trading calendar and market timing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions import contracts, dates, values
from marketframe.operators.joins import market_rule_join


SESSION_NAMES = ("day", "allday", "pre", "post", "am", "pm")


def derive_sessions(start: Column, end: Column, rule: Column) -> Column:
    """struct of session windows from regular hours (in minutes) and a session rule.

    The post session begins one minute after the close. A continuous market
    and one without a rule trade all day within their regular hours.
    """
    text = dates.clock_text
    ok = start.isNotNull() & end.isNotNull()
    pre_min = F.coalesce(rule["pre_minutes"], F.lit(0))
    post_min = F.coalesce(rule["post_minutes"], F.lit(0))
    extended = ok & rule.isNotNull() & ~F.coalesce(rule["is_continuous"], F.lit(False))
    has_pre, has_post = extended & (pre_min > 0), extended & (post_min > 0)
    lunch = extended & rule["lunch_start_min"].isNotNull() & rule["lunch_end_min"].isNotNull()
    earliest = F.when(has_pre, start - pre_min).otherwise(start)
    latest = F.when(has_post, end + post_min).otherwise(end)
    windows = {
        "day": (start, end, ok), "allday": (earliest, latest, ok), "pre": (start - pre_min, start, has_pre),
        "post": (end + 1, end + post_min, has_post), "am": (start, start + rule["lunch_start_min"], lunch),
        "pm": (start + rule["lunch_end_min"], end, lunch), "night": (F.lit(0), F.lit(0), F.lit(False)),
    }
    return F.struct(*[
        F.when(keep, F.struct(text(a).alias("start"), text(b).alias("end"))).alias(name)
        for name, (a, b, keep) in windows.items()
    ])


def with_sessions(exchanges: DataFrame) -> DataFrame:
    """Add ``sessions`` to (mic, exch_code, day_start, day_end) rows."""
    staged = market_rule_join(exchanges).withColumns({
        "_start": dates.clock_minutes(F.col("day_start")), "_end": dates.clock_minutes(F.col("day_end")),
    })
    sessions = derive_sessions(F.col("_start"), F.col("_end"), F.col("rule"))
    return staged.withColumn("sessions", sessions).drop("rule", "_start", "_end")


def hours_to_local(exchanges: DataFrame, date: Column, hours_tz: str = "America/New_York") -> DataFrame:
    """Session hours quoted in one zone moved to each exchange's own, at the offset of ``date``."""
    out = exchanges
    for c in ("day_start", "day_end"):
        quoted = dates.at_clock(date, dates.clock_minutes(F.col(c)))
        out = dates.with_utc(out, "_utc", quoted, F.lit(hours_tz))
        out = out.withColumn(c, F.date_format(F.from_utc_timestamp("_utc", F.col("timezone")), "HH:mm")).drop("_utc")
    return out


def trading_calendar(exchanges: DataFrame, days: DataFrame) -> DataFrame:
    """(exchange, date, session) rows with start and end in UTC and a daylight-saving flag.

    ``exchanges``: exchange, timezone, sessions. ``days``: exchange, date.
    Both times lie on the same date; a time the zone skips or repeats is null.
    """
    pairs = F.array(*[
        F.struct(F.lit(n).alias("session"), F.col(f"sessions.{n}").alias("w")) for n in SESSION_NAMES
    ])
    zone = F.col("timezone")

    def offset(day: Column) -> Column:
        noon = dates.at_clock(day, F.lit(720))
        return F.unix_timestamp(noon) - F.unix_timestamp(F.to_utc_timestamp(noon, zone))

    year = F.year("date")
    winter = F.least(*[offset(F.make_date(year, F.lit(m), F.lit(1))) for m in (1, 7)])
    dated = days.join(exchanges, "exchange").withColumn("is_dst", offset(F.col("date")) > winter)
    rows = dated.select("exchange", "timezone", "date", "is_dst", F.inline(pairs)).where(F.col("w").isNotNull())
    for out, part in (("start_utc", "start"), ("end_utc", "end")):
        rows = dates.with_utc(rows, out, dates.at_clock(F.col("date"), dates.clock_minutes(F.col(f"w.{part}"))), zone)
    return rows.select("exchange", "date", "session", "start_utc", "end_utc", "is_dst")


def market_timing(
    df: DataFrame, out: str, timing: str = "EOD", target: str = "local", sessions: str = "sessions",
    zone: str = "timezone", date: str = "date",
) -> DataFrame:
    """Add the begin (BOD), end (EOD) or last moment (FINISHED) of a market day as text."""
    day = F.col(sessions)["day"]
    clock = {
        "BOD": day["start"],
        "FINISHED": F.coalesce(F.col(sessions)["allday"]["end"], day["end"]),
    }.get(timing.upper(), day["end"])
    if target.lower() == "local":
        return df.withColumn(out, F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), clock))
    local = dates.at_clock(F.col(date), dates.clock_minutes(clock))
    timed = dates.with_utc(df, "_utc", local, F.col(zone))
    shown = F.date_format(F.from_utc_timestamp("_utc", F.lit(target)), "yyyy-MM-dd HH:mm:ss")
    return timed.withColumn(out, F.concat(shown, dates.offset_text(F.col("_utc"), F.lit(target)))).drop("_utc")


def relabel_output_tz(df: DataFrame, zone: str, time: str = "time", name: str = "local_time") -> DataFrame:
    """Same instants, shown in a zone in an extra column."""
    return df.withColumn(name, F.from_utc_timestamp(F.col(time), F.lit(zone)))


def infer_venue(df: DataFrame) -> DataFrame:
    """exch, tz, freq and is_fut of tickers joined with their wide snapshot facts.

    Needs ticker, EXCH_CODE, ID_MIC_PRIM_EXCH, IANA_TIME_ZONE, FUT_GEN_MONTH.
    Tickers of other asset classes, or of one token, drop out.
    """
    tok = contracts.tokens(F.col("ticker"))
    asset = F.element_at(tok, -1)
    credit = (asset == "Corp") & (tok[0] == "CDX")
    generic = asset.isin("Index", "Comdty", "Curncy") & tok[0].rlike(r"[A-Za-z][0-9]$")
    month = F.when(generic, values.clean_value(F.col("FUT_GEN_MONTH")))
    rows = df.where((F.size(tok) >= 2) & asset.isin("Equity", "Comdty", "Curncy", "Index", "Corp"))
    exch = F.coalesce(values.clean_value(F.col("EXCH_CODE")), values.clean_value(F.col("ID_MIC_PRIM_EXCH")))
    return rows.select(
        "ticker",
        F.when(credit, F.lit("US")).otherwise(exch).alias("exch"),
        F.when(credit, F.lit("America/New_York")).otherwise(values.clean_value(F.col("IANA_TIME_ZONE"))).alias("tz"),
        F.when(~credit, month).alias("freq"),
        F.when(~credit, month.isNotNull()).alias("is_fut"),
    )
