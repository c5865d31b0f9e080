"""Filters, screens and searches."""

from __future__ import annotations

import datetime
import decimal
import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions import contracts, dates
from marketframe.operators.scan import only_tickers


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def filter_tickers(df: DataFrame, tickers) -> DataFrame:
    return only_tickers(df, tickers)


def filter_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of the named fields, compared without case."""
    return df.where(F.upper("field").isin([f.upper() for f in fields]))


def equity_filter(df: DataFrame, col: str = "ticker") -> DataFrame:
    """Equity tickers; equity options (with ``=``) are out."""
    return df.where(F.col(col).contains("Equity") & ~F.col(col).contains("="))


def valid_contracts(chain: DataFrame, ref_date: Column, maturity: str = "maturity") -> DataFrame:
    """Contracts whose maturity parses and lies strictly after the reference date."""
    return chain.withColumn("expiry", dates.parse_any_date(F.col(maturity))).where(F.col("expiry") > ref_date)


def cycle_filter(df: DataFrame, cycle: str, month: str = "month") -> DataFrame:
    """Contracts whose delivery month belongs to a cycle such as ``HMUZ``."""
    code = contracts.month_code(F.col(month))
    return df.where(F.instr(F.lit(cycle.upper()), code) > 0)


def is_specific_contract(df: DataFrame, col: str = "ticker") -> DataFrame:
    return df.withColumn("is_specific", contracts.is_specific_contract(F.col(col)))


def validate_generic(df: DataFrame, col: str = "ticker") -> DataFrame:
    """Message for every ticker that is a specific contract, null for a generic one."""
    message = F.concat(F.lit("'"), F.col(col), F.lit("' is a specific contract; a generic ticker is required"))
    return df.withColumn("error", F.when(contracts.is_specific_contract(F.col(col)), message))


def _within(col: str, low, high) -> list[Column]:
    c = F.col(col)
    return ([c >= low] if low is not None else []) + ([c <= high] if high is not None else [])


SCREEN_COLUMNS = ("strike_px", "expire_dt", "ivol", "delta", "open_int", "px_last", "px_bid", "px_ask")


def option_screen_filter(
    opts: DataFrame, underlying: str | None = None, put_call: str | None = None, expiry: tuple = (None, None),
    min_open_int=None, min_volume=None, min_bid=None, max_ask=None, exch_code: str | None = None,
    exercise_type: str | None = None, extra: Column | str | None = None,
    columns: Sequence[str] = ("id", *SCREEN_COLUMNS), **ranges: tuple,
) -> DataFrame:
    """Options that meet every given condition.

    ``ranges`` takes (low, high) for strike_px, delta, gamma, vega, theta,
    ivol and moneyness; either end may be None.
    """
    allowed = {"strike_px", "delta", "gamma", "vega", "theta", "ivol", "moneyness"}
    unknown = set(ranges) - allowed
    if unknown:
        raise ValueError(f"unknown ranges {sorted(unknown)}")
    conds = [] if underlying is None else [F.col("underlying") == underlying]
    if put_call is not None:
        conds.append(F.col("put_call") == ("Call" if put_call.upper() in ("C", "CALL") else "Put"))
    conds += [c for col, bound in (("expire_dt", expiry), *ranges.items()) for c in _within(col, *bound)]
    conds += _within("open_int", min_open_int, None) + _within("px_volume", min_volume, None)
    conds += _within("px_bid", min_bid, None) + _within("px_ask", None, max_ask)
    if exch_code is not None:
        conds.append(F.col("exch_code") == exch_code)
    if exercise_type is not None:
        conds.append(F.col("exercise_type") == exercise_type)
    if extra is not None:
        conds.append(F.expr(extra) if isinstance(extra, str) else extra)
    return opts.where(all_of(conds)).select(*columns)


PERIODICITIES = ("W", "M", "Q", "Y", "")


def option_chain(
    chain: DataFrame, put_call: str | None = None, expiry=None, expiry_match: str = "E",
    strike: float | str | None = None, points: int | None = None, periodicity: str = "",
    exercise: str | None = None,
) -> DataFrame:
    """Members of a chain by side, expiry, strike, expiry cycle and exercise style.

    ``strike`` is a number or ``ATM`` (the underlying price). With ``points``
    the nearest strikes are kept per underlying, expiry and side; without it
    the single nearest. ``expiry_match`` C takes the expiry closest to the
    date. Distances are ranked by bounded top-k aggregates, so no chain is
    gathered whole in one task.
    """
    if periodicity not in PERIODICITIES:
        raise ValueError(f"periodicity must be one of {PERIODICITIES}")
    out = chain
    if put_call is not None:
        out = out.where(F.col("put_call") == ("Call" if put_call.upper() in ("C", "CALL") else "Put"))
    if exercise is not None:
        out = out.where(F.col("exercise_type") == exercise)
    exp = F.col("expire_dt")
    monthly = (F.dayofweek(exp) == 6) & F.day(exp).between(15, 21)
    if periodicity == "W":
        out = out.where(~monthly)
    elif periodicity == "M":
        out = out.where(monthly)
    elif periodicity == "Q":
        out = out.where(monthly & F.month(exp).isin(3, 6, 9, 12))
    elif periodicity == "Y":
        out = out.where(monthly & (F.month(exp) == 12))
    if expiry is not None:
        day = F.lit(expiry).cast("date")
        if expiry_match == "E":
            out = out.where(exp == day)
        else:
            near = out.groupBy("underlying").agg(
                F.min(F.struct(F.abs(F.date_diff(exp, day)), exp.alias("e")))["e"].alias("_near")
            )
            out = out.join(near, "underlying").where(exp == F.col("_near")).drop("_near")
    if strike is not None:
        target = F.col("undl_px") if strike == "ATM" else F.lit(float(strike))
        keep = points or 1
        rank = F.row_number().over(
            Window.partitionBy("underlying", "expire_dt", "put_call").orderBy(
                F.abs(F.col("strike_px") - target), F.col("strike_px"), F.col("id")
            )
        )
        # rank <= k: Spark keeps k rows per group in each task before the shuffle
        out = out.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")
    return out


def issuer_name(issuer: str) -> str:
    return issuer if " " in issuer else f"{issuer} US Equity"


def merged_fields(base: Sequence[str], extra: Sequence[str]) -> list[str]:
    """Extra fields behind the base ones, doubles dropped without regard to case."""
    out = list(base)
    for f in extra:
        if f.lower() not in [x.lower() for x in out]:
            out.append(f)
    return out


def preferreds(bonds: DataFrame, issuer: str, fields: Sequence[str] = ()) -> DataFrame:
    """Preferred issues of an issuer, consolidated duplicates dropped (lowest id stays)."""
    cols = merged_fields(["id", "name"], fields)
    wanted = bonds.where((F.col("issuer") == issuer_name(issuer)) & (F.col("asset_class") == "Preferreds"))
    rest = [c for c in cols if c != "consolidated_id"]
    first = wanted.groupBy("consolidated_id").agg(F.min(F.struct("id", *[c for c in rest if c != "id"])).alias("r"))
    return first.select(*[F.col(f"r.{c}").alias(c) for c in rest])


def corporate_bonds(
    bonds: DataFrame, issuer: str, ccy: str | None = "USD", fields: Sequence[str] = (),
    active_only: bool = False, as_of=None,
) -> DataFrame:
    """Corporate bonds of an issuer, of one currency, optionally not yet matured."""
    out = bonds.where((F.col("issuer") == issuer_name(issuer)) & (F.col("asset_class") == "Corporates"))
    if ccy is not None:
        out = out.where(F.col("crncy") == ccy)
    if active_only:
        out = out.where(F.col("maturity") > F.lit(as_of).cast("date"))
    return out.select(*merged_fields(["id", "name"], fields))


MAX_RESULTS = 1000


def instrument_search(
    instruments: DataFrame, query: str, yellowkey: str | None = None, max_results: int = 20
) -> DataFrame:
    """Instruments whose ticker or name holds the query, best match first (a top-k report)."""
    if not 1 <= max_results <= MAX_RESULTS:
        raise ValueError(f"max_results must be from 1 to {MAX_RESULTS}")
    q = query.lower()
    name, ticker = F.lower("name"), F.lower("ticker")
    out = instruments.where(name.contains(q) | ticker.contains(q))
    if yellowkey is not None:
        out = out.where(F.element_at(contracts.tokens(F.col("ticker")), -1) == yellowkey)
    score = F.when(ticker.startswith(q), 0).when(name.startswith(q), 1).otherwise(2)
    return out.withColumn("score", score).orderBy("score", "ticker").limit(max_results)


def curve_search(curves: DataFrame, **criteria: str | None) -> DataFrame:
    """Curves that match every criterion given."""
    allowed = {"country", "currency", "type", "subtype", "curveid", "global_id"}
    if set(criteria) - allowed:
        raise ValueError(f"criteria must be among {sorted(allowed)}")
    return curves.where(all_of([F.col(c) == v for c, v in criteria.items() if v is not None]))


def govt_search(govts: DataFrame, query: str, partial: bool = True) -> DataFrame:
    """Government issues whose ticker starts with the query, or equals it."""
    t = F.upper("ticker")
    return govts.where(t.startswith(query.upper()) if partial else t == query.upper())


def sql_literal(value: object) -> str:
    """A typed SQL literal; anything but plain values is refused."""
    if value is None or isinstance(value, bool):
        return {None: "NULL", True: "TRUE", False: "FALSE"}[value]
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value) if math.isfinite(value) else f"DOUBLE('{value}')"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


class Screens:
    """Named, saved predicates over a snapshot table."""

    def __init__(self) -> None:
        self._saved: dict[tuple[str, str], str] = {}

    def save(self, name: str, predicate: str, group: str = "General") -> None:
        if not predicate.strip():
            raise ValueError("an empty predicate is no screen")
        self._saved[(group, name)] = predicate

    def run(self, df: DataFrame, name: str, group: str = "General", as_of=None, **params: object) -> DataFrame:
        """Rows that meet a saved screen; ``:name`` markers take the parameters."""
        if (group, name) not in self._saved:
            raise ValueError(f"no screen {name!r} in {group!r}; saved: {sorted(self._saved)}")
        # whole names, in one pass: a value is never read for markers again
        text = re.sub(r"(?<!:):([A-Za-z_]\w*)", lambda m: sql_literal(params[m[1]]) if m[1] in params else m[0], self._saved[(group, name)])
        if as_of is not None:
            df = df.where(F.col("date") == F.lit(as_of).cast("date"))
        return df.where(F.expr(text))


def screen(df: DataFrame, screens: Screens, name: str, group: str = "General", as_of=None) -> DataFrame:
    return screens.run(df, name, group, as_of)


def search(df: DataFrame, screens: Screens, domain: str, **params: str) -> DataFrame:
    """Named search: a saved predicate with text parameters."""
    return screens.run(df, domain, "Search", None, **params)


def field_search(catalog: DataFrame, spec: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Fields whose name or description holds the keyword, or the named fields."""
    if (spec is None) == (fields is None):
        raise ValueError("give exactly one of spec and fields")
    if fields is not None:
        return filter_fields(catalog, fields)
    key = spec.lower()
    return catalog.where(F.lower("field").contains(key) | F.lower("description").contains(key))


BASE_SESSIONS = ("allday", "day", "am", "pm", "pre", "post", "night")


def session_bounds(session: str, sessions: Column) -> tuple[Column, Column]:
    """Start and end minute of a session name over a ``sessions`` struct column.

    Names: a base session, ``day_open_30``, ``day_close_20``,
    ``day_normal_30_20`` and ``allday_exact_2130_0230``.
    """
    base, *rest = session.split("_")
    if base not in BASE_SESSIONS:
        raise ValueError(f"unknown session {session!r}; available: {', '.join(BASE_SESSIONS)}")
    start = dates.clock_minutes(sessions[base]["start"])
    end = dates.clock_minutes(sessions[base]["end"])
    if not rest:
        return start, end
    kind, args = rest[0], rest[1:]
    if kind == "open" and len(args) == 1:
        return start, F.pmod(start + int(args[0]), F.lit(1440))
    if kind == "close" and len(args) == 1:
        return F.pmod(end - int(args[0]), F.lit(1440)), end
    if kind == "normal" and len(args) == 2:
        return F.pmod(start + int(args[0]), F.lit(1440)), F.pmod(end - int(args[1]), F.lit(1440))
    if kind == "exact" and len(args) == 2:
        a, b = (int(x[:2]) * 60 + int(x[2:]) for x in args)
        # the base session must exist at the exchange, its hours do not matter
        return F.when(start.isNotNull(), a), F.when(start.isNotNull(), b)
    raise ValueError(f"session {session!r} does not follow the grammar")


def session_filter(df: DataFrame, session: str, exchange: DataFrame, time: str = "time") -> DataFrame:
    """Rows whose local time of day lies in the named session of their exchange.

    ``exchange``: ticker, timezone, sessions. A session may cross midnight. A
    ticker whose exchange does not define the session keeps no row.
    """
    start, end = session_bounds(session, F.col("sessions"))
    bounds = exchange.select("ticker", "timezone", start.alias("_start"), end.alias("_end"))
    local = F.from_utc_timestamp(F.col(time), F.col("timezone"))
    minute = F.hour(local) * 60 + F.minute(local) + F.second(local) / 60
    inside = F.when(
        F.col("_start") <= F.col("_end"), minute.between(F.col("_start"), F.col("_end"))
    ).otherwise((minute >= F.col("_start")) | (minute <= F.col("_end")))
    return df.join(bounds, "ticker").where(inside).drop("timezone", "_start", "_end")
