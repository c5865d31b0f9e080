"""Whole-table jobs over the scalar functions; rows that do not parse go to a rejects table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.functions import contracts, dates, values
from marketframe.operators import calendars, joins
from marketframe.plans import futures


def normalize_universe(instruments: DataFrame) -> DataFrame:
    """Tickers with their parts: asset, generic parts, contract month and year, credit index, equity or not."""
    t = F.col("ticker")
    g, s, c, specific = F.col("_g"), F.col("_s"), F.col("_c"), F.col("_specific")
    # parsed once per row, then taken apart
    parsed = instruments.withColumns({
        "_g": contracts.parse_ticker(t), "_s": contracts.specific_parts(t), "_c": contracts.parse_cdx(t),
        "_specific": contracts.is_specific_contract(t),
    })
    return parsed.select(
        "ticker",
        F.element_at(contracts.tokens(t), -1).alias("asset"),
        F.coalesce(s["root"], g["prefix"]).alias("prefix"),
        F.when(~specific, g["index"]).cast("bigint").alias("index"),
        g["exchange"].alias("exchange"),
        specific.alias("is_specific"),
        s["month"].cast("bigint").alias("month"), s["year"].cast("bigint").alias("year"),
        c["index"].alias("cdx_index"), c["series"].alias("cdx_series"),
        c["version"].cast("bigint").alias("cdx_version"), c["tenor"].alias("cdx_tenor"),
        (t.contains("Equity") & ~t.contains("=")).alias("is_equity"),
        F.when(g.isNull() & s.isNull() & c.isNull(), F.lit("ticker does not parse")).alias("reason"),
    )


def normalize_dates(raw: DataFrame, as_of: str) -> DataFrame:
    """Text dates, offsets and clock times as date, timestamp and ``HH:mm``."""
    text = F.col("text")
    date = dates.parse_any_date(text)
    moved = dates.date_offset(F.trim(text), F.lit(as_of).cast("timestamp"))
    clock = dates.parse_hhmm(text)
    hours = dates.parse_futures_hours(text)
    out = raw.select(
        "*", date.alias("date"), dates.fmt_date(date).alias("compact"), moved.alias("moved"), clock.alias("clock"),
        hours["start"].alias("hours_start"), hours["end"].alias("hours_end"),
    )
    unread = (
        F.col("date").isNull() & F.col("moved").isNull() & F.col("clock").isNull() & F.col("hours_start").isNull()
    )
    return out.withColumn("reason", F.when(unread, F.lit("no date, offset or time")))


def clean_values(raw: DataFrame) -> DataFrame:
    """Text values with their type name and typed forms."""
    text = values.clean_value(F.col("value"))
    kind = values.dtype_of(F.col("value"))
    return raw.select(
        "*", kind.alias("dtype"), text.alias("cleaned"),
        values.parse_amount(F.col("value")).alias("amount"),
        values.parse_level(F.col("value")).cast("bigint").alias("whole"),
        F.when(kind == "date32", text.try_cast("date")).alias("as_date"),
        F.when(kind == "bool", F.lower(text).isin("true", "y")).alias("as_bool"),
        F.when(text.isNull(), F.lit("blank")).alias("reason"),
    )


def rejects(df: DataFrame, original: list[str]) -> DataFrame:
    """Rows a job could not read, with the reason."""
    return df.where(F.col("reason").isNotNull()).select(*original, "reason")


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNull()).drop("reason")


fx_terms = joins.fx_terms


def contract_calendar(generics: DataFrame, days: DataFrame | None = None, freq: str = "monthly", as_of=None) -> DataFrame:
    """(generic, date) points with their candidate contracts, month letters and ranks.

    ``generics`` may already hold the points; with ``days`` (gen_ticker, dt)
    only the listed ones are used.
    """
    points = generics if days is None else generics.select("gen_ticker").distinct().join(days, "gen_ticker")
    rows = futures.futures_candidates(points.select("gen_ticker", "dt"), freq, as_of)
    return rows.withColumn("code", contracts.month_code(F.month("month")))


trading_calendar = calendars.trading_calendar
