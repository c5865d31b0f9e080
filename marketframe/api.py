"""One entry point over the canonical tables, with output formats.

    md = MarketData(spark, history=hist, snapshot=ref, ticks=ticks, fx=fx)
    md.history(["AAPL US Equity"], ["PX_LAST"], "2024-01-01", format="wide")

Every call returns a lazy DataFrame. ``to_client`` hands a bounded result to
pandas or Arrow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.functions import dates
from marketframe.operators import aggregate, calendars, joins, predicates, scan, shape, studies
from marketframe.plans import bundles, futures, recipes

FORMATS = ("long", "long_typed", "long_metadata", "semi_long", "wide", "json")

# Short names of period, fill and days.
SHORT_NAMES = ("Per", "Fill", "Days")


def formatted(
    df: DataFrame, format: str, keys: Sequence[str], fields: Sequence[str], types: dict[str, str], default: str
) -> DataFrame:
    """Long rows (keys, field, value) in one of the output formats."""
    if format not in FORMATS:
        raise ValueError(f"format {format!r}: one of {', '.join(FORMATS)}")
    if format == "long":
        return shape.format_long(df, {f: types.get(f, default) for f in fields}, default)
    if format == "long_typed":
        return shape.format_long_typed(df)
    if format == "long_metadata":
        return shape.format_long_metadata(df, types)
    if format == "semi_long":
        return shape.format_semi_long(df, keys, fields, types)
    if format == "wide":
        return shape.format_semi_long(df, keys, fields)
    return shape.raw_json(shape.format_semi_long(df, keys, fields))


@dataclass
class MarketData:
    """The canonical tables a client works with; tables that are not needed may be left out."""

    spark: SparkSession
    snapshot: DataFrame | None = None
    history: DataFrame | None = None
    bulk: DataFrame | None = None
    ticks: DataFrame | None = None
    fx: DataFrame | None = None
    catalog: DataFrame | None = None
    holdings: DataFrame | None = None
    instruments: DataFrame | None = None
    curves: DataFrame | None = None
    govts: DataFrame | None = None
    funds: DataFrame | None = None
    contracts: DataFrame | None = None
    options: DataFrame | None = None
    bonds: DataFrame | None = None
    exchanges: DataFrame | None = None
    screens: predicates.Screens = field(default_factory=predicates.Screens)
    field_types: dict[str, str] = field(default_factory=dict)

    def _need(self, name: str) -> DataFrame:
        table = getattr(self, name)
        if table is None:
            raise ValueError(f"no {name} table given")
        return table

    def _tickers(self, tickers: scan.Tickers) -> DataFrame:
        if isinstance(tickers, DataFrame):
            return tickers.select("ticker")
        names = [tickers] if isinstance(tickers, str) else list(tickers)
        return self.spark.createDataFrame([(t,) for t in names], "ticker string")

    def _points(self, generics: str | Sequence[str] | DataFrame, days: str | Sequence[str] | None) -> DataFrame:
        """Points (gen_ticker, dt): a frame of them, or every name at every date."""
        if isinstance(generics, DataFrame):
            return generics.select("gen_ticker", "dt")
        if not days:
            raise ValueError("names need dates")
        names, days = ([x] if isinstance(x, str) else list(x) for x in (generics, days))
        rows = self.spark.createDataFrame([(n, d) for n in names for d in days], "gen_ticker string, dt string")
        return rows.withColumn("dt", F.col("dt").cast("date"))

    def _zone(self, label: str, tickers: scan.Tickers = None) -> str:
        """Zone of a label: an alias, a zone name, a reference ticker, or ``exchange`` for the only ticker asked for."""
        of = label
        if label.lower() == "exchange":
            names = [tickers] if isinstance(tickers, str) else tickers
            if names is None or isinstance(names, DataFrame) or len(names) != 1:
                raise ValueError("exchange needs a single ticker")
            of = names[0]
        elif " " not in label:
            shown = dates.timezone_alias(F.lit(label), F.lit(None).cast("string"))
            # the alias of one literal; an unknown zone fails here, not in a task
            zone = self.spark.range(1).select(shown.alias("zone"), F.from_utc_timestamp(F.lit("2000-01-01"), shown)).first()["zone"]
            if zone is None:
                raise ValueError(f"unknown zone {label!r}")
            return zone
        facts = joins.timezone_join(self._need("exchanges").where(F.col("ticker") == of)).select("timezone").limit(1).collect()
        if not facts:
            raise ValueError(f"no exchange known for {of!r}")
        return facts[0]["timezone"]

    def _between(self, tickers: scan.Tickers, start, end, request_tz: str | None) -> tuple:
        """Bounds as UTC instants; wall-clock texts of another zone are converted, so that the scan still gets constants."""
        if request_tz is None:
            return start, end
        zone = F.lit(self._zone(request_tz, tickers))
        return tuple(F.to_utc_timestamp(F.lit(x).cast("timestamp"), zone) for x in (start, end))

    def _shown(self, df: DataFrame, tickers: scan.Tickers, output_tz: str | None) -> DataFrame:
        """With a column ``local_time`` where an output zone is asked for."""
        return df if output_tz is None else calendars.relabel_output_tz(df, self._zone(output_tz, tickers))

    def _types(self, fields: Sequence[str], default: str) -> dict[str, str]:
        """Types of the requested fields: own ones, else those of the field catalog, if there is one."""
        if self.catalog is None:
            return self.field_types
        wanted = self.spark.createDataFrame([(f,) for f in fields], "field string").distinct()
        known = scan.field_catalog(self.catalog, list(fields))
        return {r["field"]: r["type"] for r in shape.resolve_field_types(wanted, self.field_types, known, default).collect()}  # one row per requested field

    def reference(
        self, tickers: scan.Tickers, fields: Sequence[str], format: str = "long", include_errors: bool = False, as_of=None
    ) -> DataFrame:
        """Snapshot fields; types come from overrides, then the field catalog, else text."""
        rows = scan.ref_scan(self._need("snapshot"), self._tickers(tickers), fields, as_of, include_errors)
        return formatted(rows, format, ["ticker"], list(fields), self._types(fields, "string"), "string")

    def daily(
        self, tickers: scan.Tickers, fields: Sequence[str] = ("PX_LAST",), start=None, end=None, format: str = "long",
        period: str | None = None, fill: str | None = None, days: str = "W", ccy: str | None = None,
        adjust: str | None = None, actions: DataFrame | None = None, **short: str,
    ) -> DataFrame:
        """Daily history, optionally adjusted, converted, sampled by period or filled over days.

        ``Per``, ``Fill`` and ``Days`` are short names of period, fill and days.

        The range is cut first, so that only its rows are adjusted; days before
        the first point of the range are filled from the last one before it.
        """
        if unknown := set(short) - set(SHORT_NAMES):
            raise ValueError(f"unknown options {sorted(unknown)}; short names are {', '.join(SHORT_NAMES)}")
        period, fill, days = (short.get(name, given) for name, given in zip(SHORT_NAMES, (period, fill, days)))
        rows = scan.hist_scan(self._need("history"), tickers, fields, start, end)
        if fill == "P" and start is not None:
            rows = rows.unionByName(scan.last_before(self._need("history"), tickers, fields, start))
        if adjust is not None:
            rows = scan.hist_adjust(rows, scan.only_tickers(actions, tickers), adjust)
        if ccy is not None:
            rows = joins.fx_join_long(rows, self._need("snapshot"), self._need("fx"), ccy)
        if fill is not None:
            rows = aggregate.fill_forward(rows, start, end, days, fill)
        if period is not None:
            rows = aggregate.periodicity(rows, period).drop("period")
        return formatted(rows, format, ["ticker", "date"], list(fields), self.field_types, "float64")

    def nested(self, tickers: scan.Tickers, field_name: str) -> DataFrame:
        return scan.bulk_scan(self._need("bulk"), tickers, field_name)

    def bars(
        self, tickers: scan.Tickers, dt=None, start=None, end=None, interval: int = 1, seconds: bool = False,
        typ: str = "TRADE", session: str | None = None, exchange: DataFrame | None = None,
        request_tz: str | None = None, output_tz: str | None = None,
    ) -> DataFrame:
        """Intraday bars built from ticks; the range and tickers reach the tick scan first.

        ``request_tz`` is the zone of the day or range, ``output_tz`` that of an
        extra column ``local_time``; see ``_zone`` for their labels.
        """
        if dt is not None:
            start, end = f"{dt} 00:00:00", f"{dt} 23:59:59.999999"
        if start is None or end is None:
            raise ValueError("either dt, or both start and end, are required")
        start, end = self._between(tickers, start, end, request_tz)
        rows = scan.ticks_scan(self._need("ticks"), tickers, start, end, [typ])
        if session is not None:
            rows = predicates.session_filter(rows, session, exchange)
        return self._shown(aggregate.bars_from_ticks(rows, interval, seconds, typ), tickers, output_tz)

    def trades(
        self, tickers: scan.Tickers, start, end, event_types: Sequence[str] = ("TRADE",), request_tz: str | None = None, output_tz: str | None = None,
    ) -> DataFrame:
        start, end = self._between(tickers, start, end, request_tz)
        return self._shown(scan.ticks_scan(self._need("ticks"), tickers, start, end, event_types), tickers, output_tz)

    def quotes(self, tickers: scan.Tickers, as_of: str, **kw) -> DataFrame:
        return scan.quotes_scan(self._need("ticks"), tickers, as_of, **kw)

    def field_info(self, fields: Sequence[str] | None = None, spec: str | None = None) -> DataFrame:
        return predicates.field_search(scan.field_catalog(self._need("catalog")), spec, fields)

    def portfolio(self, name: str, fields: Sequence[str]) -> DataFrame:
        return scan.portfolio_scan(self._need("holdings"), name, fields)

    def lookup(self, query: str, yellowkey: str | None = None, max_results: int = 20) -> DataFrame:
        return predicates.instrument_search(self._need("instruments"), query, yellowkey, max_results)

    def find_curves(self, **criteria: str | None) -> DataFrame:
        return predicates.curve_search(self._need("curves"), **criteria)

    def find_govts(self, query: str, partial: bool = True) -> DataFrame:
        return predicates.govt_search(self._need("govts"), query, partial)

    def screen(self, name: str, group: str = "General", as_of=None) -> DataFrame:
        return predicates.screen(self._need("snapshot"), self.screens, name, group, as_of)

    def turnover(self, tickers: scan.Tickers = None, start=None, end=None, ccy: str = "USD", factor: float = 1e6, as_of=None) -> DataFrame:
        return recipes.turnover(
            self._need("history"), self._need("snapshot"), self._need("fx"), tickers, start, end, ccy, factor, as_of)

    def dividend(self, tickers: scan.Tickers, typ: str = "all", start=None, end=None) -> DataFrame:
        return recipes.dividend(self._need("bulk"), tickers, typ, start, end)

    def vwap(
        self, tickers: scan.Tickers, dt=None, start=None, end=None, start_time: str | None = None, end_time: str | None = None, typ: str = "TRADE",
    ) -> DataFrame:
        """Volume-weighted price, volume and turnover of a day or range, optionally within a time of day."""
        if dt is not None:
            start, end = f"{dt} 00:00:00", f"{dt} 23:59:59.999999"
        if start is None or end is None:
            raise ValueError("either dt, or both start and end, are required")
        return aggregate.vwap(scan.ticks_scan(self._need("ticks"), tickers, start, end, [typ]), start_time, end_time, typ=typ)

    def earnings(self, ticker: str, by: str = "Geo", typ: str = "Revenue", **choices) -> DataFrame:
        """Segment figures by geography or product with shares; ``choices``: ccy, level, year, periods."""
        return recipes.earnings_of(self._need("bulk"), ticker, typ, by=by, **choices)

    def fund_holdings(self, fund: str | DataFrame | None, fields: Sequence[str] = ()) -> DataFrame:
        return recipes.etf_holdings(self._need("funds"), fund, fields)

    def yield_analysis(self, tickers: scan.Tickers, fields: Sequence[str] = ("YAS_BOND_YLD",), **params) -> DataFrame:
        return recipes.yas(self._need("snapshot"), self._tickers(tickers), fields, **params)

    def bundle(self, name: str, tickers: scan.Tickers = None, **params: str) -> DataFrame:
        """A field bundle of the snapshot, or the rows of a nested one."""
        if name in bundles.BULK_FIELDS:
            return bundles.bulk_bundle(self._need("bulk"), name, tickers)
        return bundles.field_bundle(self._need("snapshot"), name, tickers, **params)

    def futures_contract(self, generics: str | Sequence[str] | DataFrame, days: str | Sequence[str] | None = None, active: bool = False) -> DataFrame:
        """Contract of each generic future at each date: by its number, or the more active of the first two."""
        points, chain = self._points(generics, days), self._need("contracts")
        return futures.active_futures(points, chain, self._need("history")) if active else futures.fut_ticker(points, chain)

    def credit_index(self, generics: str | Sequence[str] | DataFrame, days: str | Sequence[str] | None = None, active: bool = False) -> DataFrame:
        """Series of each generic credit index at each date: the current one, or the one with the more recent price."""
        points, ref = self._points(generics, days), self._need("snapshot")
        return futures.active_cdx(points, ref, self._need("history")) if active else futures.cdx_ticker(points, ref)

    def option_chain(self, underlying: str | None = None, **choices) -> DataFrame:
        """Members of a chain; ``choices`` as in ``predicates.option_chain``."""
        rows = self._need("options")
        return predicates.option_chain(rows if underlying is None else rows.where(F.col("underlying") == underlying), **choices)

    def option_screen(self, underlying: str | None = None, **conditions) -> DataFrame:
        return predicates.option_screen_filter(self._need("options"), underlying, **conditions)

    def preferreds(self, issuer: str, fields: Sequence[str] = ()) -> DataFrame:
        return predicates.preferreds(self._need("bonds"), issuer, fields)

    def corporate_bonds(self, issuer: str, **choices) -> DataFrame:
        """Corporate bonds of an issuer; ``choices``: ccy, fields, active_only, as_of."""
        return predicates.corporate_bonds(self._need("bonds"), issuer, **choices)

    def exchange_info(self, tickers: scan.Tickers, as_of: str, overrides: DataFrame | None = None) -> DataFrame:
        return recipes.exchange_info(scan.only_tickers(self._need("exchanges"), tickers), as_of, overrides)

    def market_info(self, tickers: scan.Tickers) -> DataFrame:
        return recipes.market_info(self._need("snapshot"), self._tickers(tickers))

    def converted(self, df: DataFrame, ccy: str) -> DataFrame:
        """A given frame in another currency: long history (ticker, date, field, value), or a panel with one column per ticker and field."""
        convert = joins.fx_join_long if {"ticker", "date", "field", "value"} <= set(df.columns) else joins.fx_join_wide
        return convert(df, self._need("snapshot"), self._need("fx"), ccy)

    def study(self, bars: DataFrame, name: str, **params) -> DataFrame:
        return studies.study(bars, name, **params)

    def request(self, table: str, filters: dict[str, object] | None = None, fields: Sequence[str] | None = None, where=None) -> DataFrame:
        """Any of the tables with filters and a projection."""
        return scan.generic_request(self._need(table), filters, fields, where)


CLIENT_ROWS = 1_000_000


def to_client(df: DataFrame, backend: str = "pandas", max_rows: int = CLIENT_ROWS):
    """A result as a pandas frame or Arrow table; larger ones are refused, not cut."""
    if backend not in ("pandas", "arrow"):
        raise ValueError("backend must be pandas or arrow")
    if df.select(F.lit(1)).limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result to a table, or read it in batches")
    return df.toPandas() if backend == "pandas" else df.toArrow()
