"""Scans: the requested slice of a canonical table, with the shape of a request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions import dates

Tickers = DataFrame | Sequence[str] | str | None


def only_tickers(df: DataFrame, tickers: Tickers, col: str = "ticker") -> DataFrame:
    """Rows of the requested tickers: a pushed-down IN list, or a semi join with a frame."""
    if tickers is None:
        return df
    if isinstance(tickers, DataFrame):
        wanted = tickers.select(F.col("ticker").alias("_wanted"))
        return df.join(wanted, df[col] == F.col("_wanted"), "left_semi")
    names = [tickers] if isinstance(tickers, str) else list(tickers)
    return df.where(F.col(col).isin(names))


def _field_list(fields: Sequence[str] | str) -> list[str]:
    names = [fields] if isinstance(fields, str) else list(fields)
    if not names:
        raise ValueError("at least one field is required")
    return names


def request_grid(tickers: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(ticker, field, pos) for every ticker and requested field, in request order."""
    names = F.array(*[F.lit(f) for f in _field_list(fields)])
    return tickers.select("ticker", F.posexplode(names).alias("pos", "field"))


def last_of(field: str, pos: str | None) -> Column:
    """Aggregate: the value of a field's last row by position; without positions each cell has one row."""
    value = F.when(F.col("field") == field, F.col("value"))
    return F.max_by(value, F.when(F.col("field") == field, F.col(pos))) if pos else F.max(value)


def position(df: DataFrame) -> str | None:
    return "pos" if "pos" in df.columns else None


def ref_scan(
    ref: DataFrame, tickers: DataFrame, fields: Sequence[str], as_of=None, include_errors: bool = False
) -> DataFrame:
    """One row per known ticker and requested field; null where the field is absent.

    A requested ticker the snapshot does not know emits nothing, or one
    ``__SECURITY_ERROR__`` row with ``include_errors``. With ``as_of`` the
    snapshot must carry a ``date`` and the last row up to that date counts.
    """
    names = _field_list(fields)
    known = only_tickers(ref, tickers)
    if as_of is not None:
        known = known.where(F.col("date") <= F.lit(as_of))
        value = lambda f: F.max_by(F.when(F.col("field") == f, F.col("value")),
                                   F.when(F.col("field") == f, F.col("date")))
    else:
        value = lambda f: last_of(f, position(known))
    # one partial aggregate per ticker instead of a grid and a join
    wide = known.groupBy("ticker").agg(*[value(f).alias(f"v{i}") for i, f in enumerate(names)])
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"v{i}").alias("value")) for i, f in enumerate(names)
    ])
    out = wide.select("ticker", F.inline(rows))
    if include_errors:
        unknown = tickers.select("ticker").distinct().join(ref.select("ticker"), "ticker", "left_anti")
        errors = unknown.select(
            "ticker", F.lit("__SECURITY_ERROR__").alias("field"), F.lit("Unknown security").alias("value")
        )
        out = out.unionByName(errors)
    return out


def require_known(ref: DataFrame, tickers: DataFrame) -> None:
    """Raise if not one requested ticker is known (checked with a one-row probe)."""
    if only_tickers(ref, tickers).limit(1).isEmpty() and not tickers.limit(1).isEmpty():
        raise ValueError("all requested securities failed")


def date_range(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Rows with ``start <= date <= end``; either bound may be open."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def hist_scan(
    hist: DataFrame, tickers: Tickers = None, fields: Sequence[str] = ("PX_LAST",), start=None, end=None
) -> DataFrame:
    """Per ticker and date present, one row per requested field; null where absent.

    Without ``start`` the range begins eight weeks before ``end``. Where rows
    carry a position ``pos``, the last row of a cell counts.
    """
    names = _field_list(fields)
    if end is not None and start is None:
        hist = hist.where(F.col("date") >= F.date_sub(F.lit(end).cast("date"), 56))
    known = date_range(only_tickers(hist, tickers), start, end)
    wide = known.groupBy("ticker", "date").agg(*[
        last_of(f, position(known)).alias(f"v{i}") for i, f in enumerate(names)
    ])
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"v{i}").alias("value")) for i, f in enumerate(names)
    ])
    return wide.select("ticker", "date", F.inline(rows))


def last_before(hist: DataFrame, tickers: Tickers, fields: Sequence[str], start) -> DataFrame:
    """Per ticker and field the last point with a value before ``start``: one row a series, combined on the map side."""
    early = only_tickers(hist, tickers).where((F.col("date") < F.lit(start).cast("date")) & F.col("field").isin(_field_list(fields)) & F.col("value").isNotNull())
    order = F.struct("date", position(early)) if position(early) else F.col("date")
    last = early.groupBy("ticker", "field").agg(F.max("date").alias("date"), F.max_by("value", order).alias("value"))
    return last.select("ticker", "date", "field", "value")


ADJUSTMENTS = {"split": ("split",), "dvd": ("cash",), "all": ("split", "cash")}


VOLUME_FIELDS = ("VOLUME", "PX_VOLUME")
# A price has PX or PRICE as one of the words of its name.
PRICE_NAME = "(^|_)(PX|PRICE)(_|$)"


def hist_adjust(hist: DataFrame, actions: DataFrame, adjust: str = "all", value: str = "value") -> DataFrame:
    """Prices times the factors of all corporate actions strictly after their date.

    ``actions``: ticker, date, kind (split or cash), factor. Of long history
    (with a column ``field``) price fields (``PRICE_NAME``) are multiplied, volumes
    are divided by the split factors, and all other fields stay. Both tables merge
    into one ordered series cut into year buckets, so neither a range join nor
    a whole ticker in one task is needed.
    """
    if adjust not in ADJUSTMENTS:
        raise ValueError(f"adjust must be one of {sorted(ADJUSTMENTS)}")
    from marketframe.operators.series import with_running

    wanted = actions.where(F.col("kind").isin(*ADJUSTMENTS[adjust]))
    # newest first: an action of the same day comes after the price and does not count
    split = F.when(F.col("kind") == "split", F.col("factor")).otherwise(F.lit(1.0))
    events = wanted.select("ticker", "date", F.lit(1).alias("_kind"), F.col("factor").alias("_factor"), split.alias("_split"))
    prices = hist.withColumns({"_kind": F.lit(0), "_factor": F.lit(1.0), "_split": F.lit(1.0)})
    merged = prices.unionByName(events, allowMissingColumns=True)
    totals = {"_after": F.col("_factor")}
    if "field" in hist.columns:
        totals["_after_split"] = F.col("_split")
    run = with_running(merged, ["ticker"], [F.col("date").desc(), F.col("_kind")], -F.year("date"), totals, product=True)
    new = F.col(value) * F.col("_after")
    if "field" in hist.columns:
        name = F.upper("field")
        new = (F.when(name.isin(*VOLUME_FIELDS), F.col(value) / F.col("_after_split"))
               .when(name.rlike(PRICE_NAME), new).otherwise(F.col(value)))
    return run.where(F.col("_kind") == 0).withColumn(value, new).drop("_kind", "_factor", "_split", "_after", "_after_split")


def bulk_scan(bulk: DataFrame, tickers: Tickers, field: str, rows: str = "rows") -> DataFrame:
    """Rows of one nested field: an array of structs becomes one row per element."""
    known = only_tickers(bulk, tickers).where(F.upper("field") == field.upper())
    return known.select("ticker", "field", F.inline(rows))


def bars_scan(
    bars: DataFrame, tickers: Tickers, dt=None, start=None, end=None, typ: str = "TRADE"
) -> DataFrame:
    """Bars of one whole day or of an explicit time range."""
    if dt is not None:
        out = whole_days(only_tickers(bars, tickers), dt, dt)
    elif start is None or end is None:
        raise ValueError("either dt, or both start and end, are required")
    else:
        out = time_range(only_tickers(bars, tickers), start, end)
    return out.where(F.col("type") == typ) if "type" in bars.columns else out


def whole_days(df: DataFrame, first, last, col: str = "time") -> DataFrame:
    """Rows from the beginning of the first day up to, not including, the day after the last."""
    return df.where((F.col(col) >= F.lit(str(first)).cast("timestamp")) & (F.col(col) < F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp")))


def time_range(df: DataFrame, start, end, col: str = "time") -> DataFrame:
    return df.where(F.col(col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def ticks_scan(
    ticks: DataFrame, tickers: Tickers, start, end, event_types: Sequence[str] = ("TRADE",)
) -> DataFrame:
    """Ticks of a time range and of the wanted event types."""
    return time_range(only_tickers(ticks, tickers), start, end).where(F.col("type").isin(list(event_types)))


def quotes_scan(
    ticks: DataFrame, tickers: Tickers, as_of: str, date_offset: str | None = None, start=None, end=None,
    event_types: Sequence[str] = ("BID", "ASK"), extras: Sequence[str] = (),
) -> DataFrame:
    """Quotes of the last ``date_offset`` (default two days) or of a date range.

    A date range spans whole days. ``as_of`` stands for the current time.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    known = only_tickers(ticks, tickers).where(F.col("type").isin(list(event_types)))
    if start is not None:
        known = whole_days(known, start, end)
    else:
        hi = F.lit(as_of).cast("timestamp")
        known = known.where(F.col("time").between(dates.date_offset(F.lit(date_offset or "-2d"), hi), hi))
    optional = [F.col(c) if c in ticks.columns else F.lit(None).cast("string").alias(c) for c in extras]
    return known.select("ticker", "time", "type", "value", "size", *optional)


def field_catalog(info: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Metadata rows: mnemonic else id, type from datatype else ftype else String."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    out = info.where(blank(F.col("id")).isNotNull()).select(
        F.coalesce(blank(F.col("mnemonic")), F.col("id")).alias("field"),
        F.coalesce(blank(F.col("datatype")), blank(F.col("ftype")), F.lit("String")).alias("type"),
        "description", "category",
    )
    if fields is not None:
        out = out.where(F.upper("field").isin([f.upper() for f in fields]))
    return out


def portfolio_scan(holdings: DataFrame, portfolio: str, fields: Sequence[str]) -> DataFrame:
    return holdings.where(F.col("portfolio") == portfolio).select("portfolio", *fields)


def generic_request(
    df: DataFrame, filters: dict[str, object] | None = None, fields: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One entry point over any canonical table: equality or IN filters, predicate, projection."""
    for col, wanted in (filters or {}).items():
        df = df.where(F.col(col).isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else F.col(col) == wanted)
    if where is not None:
        df = df.where(where)
    return df.select(*fields) if fields else df
