"""Multi-table recipes: turnover, dividends, earnings, fund holdings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.functions import dates
from marketframe.operators import aggregate, calendars, joins, predicates, scan, shape


def turnover(
    hist: DataFrame, ref: DataFrame, fx: DataFrame, tickers: scan.Tickers = None, start=None, end=None,
    ccy: str = "USD", factor: float = 1e6, as_of=None,
) -> DataFrame:
    """Daily turnover per ticker in a currency, divided by ``factor``.

    Tickers with turnover rows of their own use them; the others get average
    price times volume. Without dates the range is the thirty days before
    yesterday, counted from ``as_of``. One aggregate per (ticker, date) reads
    the history once for both ways.
    """
    if as_of is not None and end is None:
        end = F.date_sub(F.lit(as_of).cast("date"), 1)
    if as_of is not None and start is None:
        start = F.date_sub(end if not isinstance(end, str) else F.lit(end).cast("date"), 30)
    rows = scan.only_tickers(hist, tickers).where(
        F.col("field").isin("TURNOVER", "EQY_WEIGHTED_AVG_PX", "VOLUME")
    )
    if start is not None:
        rows = rows.where(F.col("date") >= (F.lit(start).cast("date") if isinstance(start, str) else start))
    if end is not None:
        rows = rows.where(F.col("date") <= (F.lit(end).cast("date") if isinstance(end, str) else end))
    pick = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    daily = rows.groupBy("ticker", "date").agg(
        pick("TURNOVER").alias("direct"),
        (pick("EQY_WEIGHTED_AVG_PX") * pick("VOLUME")).alias("derived"),
    )
    # the tickers that have rows of their own; the others fall back as a whole
    own = rows.where(F.col("field") == "TURNOVER").select("ticker").distinct().withColumn("_own", F.lit(True))
    both = daily.join(own, "ticker", "left").select(
        "ticker", "date", F.when(F.col("_own"), F.col("direct")).otherwise(F.col("derived")).alias("value"),
        F.lit("TURNOVER").alias("field"),
    ).where(F.col("value").isNotNull())
    money = joins.fx_join_long(both, ref, fx, ccy)
    return money.select("ticker", "date", "field", (F.col("value") / factor).alias("value"))


def dividend(bulk: DataFrame, tickers: scan.Tickers = None, typ: str = "all", start=None, end=None) -> DataFrame:
    """Dividend records of equity tickers with short column names, by ex-date range."""
    field = refdata.DIVIDEND_TYPES.get(typ.lower(), typ)
    rows = scan.bulk_scan(predicates.equity_filter(bulk), tickers, field)
    rows = shape.rename_dividend_columns(rows)
    if "ex_date" in rows.columns:
        rows = scan.date_range(rows, start, end, "ex_date")
    return rows


EARNING_KINDS = {"G": "Geo", "P": "Product"}


def earnings(data: DataFrame, header: DataFrame, level: str = "level", pos: str = "pos") -> DataFrame:
    """Segment figures: period columns named by the header, each followed by its share in percent."""
    named = shape.earning_header_rename(data, header)
    periods = [c for c in named.columns if c.lower().startswith("fy")]
    if level not in named.columns or not periods:
        return named
    rated = aggregate.level_percentages(named, periods, level, pos)
    order = []
    for c in named.columns:
        order.append(c)
        if c in periods:
            order.append(f"{c}_pct")
    return rated.select(*order)


def earning_choices(by: str = "Geo", ccy: str | None = None, level: int | None = None, year: int | None = None, periods: int | None = None) -> tuple[dict[str, str], dict[str, str]]:
    """Parameter columns and values of the header and of the figures; a year and a number of periods hold for both."""
    kind = by[:1].upper()
    if kind not in EARNING_KINDS:
        raise ValueError(f"by {by!r}: one of {', '.join(EARNING_KINDS.values())}")
    given = lambda **choices: {k: str(v) for k, v in choices.items() if v is not None}
    both = given(Product_Geo_Override=kind, Eqy_Fund_Year=year, Number_Of_Periods=periods)
    return both, both | given(Eqy_Fund_Crncy=ccy, PG_Hierarchy_Level=level)


def earnings_of(bulk: DataFrame, ticker: str, typ: str = "Revenue", **choices) -> DataFrame:
    """Segment figures of a ticker from its nested fields ``PG_Bulk_Header`` and ``PG_<typ>``.

    ``choices`` (see ``earning_choices``) pick precomputed rows by parameter
    columns of the nested table. Rows without a header keep their column names.
    """
    of_header, of_data = earning_choices(**choices)

    def picked(field: str, params: dict[str, str]) -> DataFrame:
        return scan.bulk_scan(bulk.where(predicates.all_of([F.col(c) == v for c, v in params.items()])), ticker, field)

    data = picked(f"PG_{typ}", of_data)
    return earnings(data.drop(*[c for c in data.columns if c.endswith(" Header")]), picked("PG_Bulk_Header", of_header))


ETF_BASE = ["id_isin", "weights", "id().position"]


def etf_holdings(holdings: DataFrame, etf: str | DataFrame | None = None, fields: Sequence[str] = ()) -> DataFrame:
    """Holdings of a fund: ISIN, weight, position and extra fields, under short names."""
    cols = ["ID", *ETF_BASE, *[f for f in fields if f not in ETF_BASE]]
    out = holdings
    if isinstance(etf, str):
        out = out.where(F.col("fund") == etf)
    elif etf is not None:
        out = out.join(etf.select("fund"), "fund", "left_semi")
    return shape.rename_etf_columns(out.select("fund", *[F.col(f"`{c}`") for c in cols]))


def yas_filter(
    settle_dt: str | None = None, yield_type: int | None = None, spread: float | None = None,
    yield_: float | None = None, price: float | None = None, benchmark: str | None = None,
) -> dict[str, str]:
    """Parameter columns and values of a yield analysis request; absent ones are left out."""
    given = {
        "YAS_SETTLE_DT": settle_dt, "YAS_YLD_FLAG": yield_type, "YAS_YLD_SPREAD": spread,
        "YAS_BOND_YLD": yield_, "YAS_BOND_PX": price, "YAS_BNCHMRK_BOND": benchmark,
    }
    return {k: str(v) for k, v in given.items() if v is not None}


def yas(ref: DataFrame, tickers: DataFrame, fields: Sequence[str] = ("YAS_BOND_YLD",), **params) -> DataFrame:
    """Yield-analysis fields of the precomputed rows that match the parameters."""
    rows = ref
    for col, value in yas_filter(**params).items():
        rows = rows.where(F.col(col) == value)
    return scan.ref_scan(rows, tickers, fields)


def exchange_info(
    facts: DataFrame, as_of: str, overrides: DataFrame | None = None, cached: DataFrame | None = None
) -> DataFrame:
    """Exchange, zone, offset and sessions per ticker.

    ``facts``: ticker, mic, exch_code, country, iana_tz, day_start, day_end.
    Overrides (ticker, mic, exch_code, timezone) win over cached rows, those
    over the facts. Sessions follow the resolved codes; the offset is that of
    ``as_of``.
    """
    zoned = joins.timezone_join(facts)
    names = ["mic", "exch_code", "timezone"]
    none = zoned.select("ticker", *names).limit(0)
    found = joins.exchange_resolve(
        zoned.select("ticker"), overrides if overrides is not None else none, cached if cached is not None else none,
        zoned.select("ticker", *names), names,
    )
    hours = zoned.select("ticker", "day_start", "day_end", "tz_source")
    rows = calendars.with_sessions(found.join(hours, "ticker"))
    at = F.lit(as_of).cast("timestamp")
    origin = F.when(F.col("source") == "source", F.col("tz_source")).otherwise(F.col("source"))
    return rows.select(
        "ticker", "mic", "exch_code", "timezone", dates.offset_text(at, F.col("timezone")).alias("utc_offset"),
        "sessions", origin.alias("source"), at.alias("cached_at"),
    )


def market_info(ref: DataFrame, tickers: DataFrame) -> DataFrame:
    """Exchange, zone and futures cycle per ticker from its snapshot fields."""
    fields = ["EXCH_CODE", "ID_MIC_PRIM_EXCH", "IANA_TIME_ZONE", "FUT_GEN_MONTH"]
    rows = scan.only_tickers(ref, tickers).where(F.upper("field").isin(fields))
    wide = shape.format_semi_long(rows.withColumn("field", F.upper("field")), ["ticker"], fields)
    return calendars.infer_venue(wide)
