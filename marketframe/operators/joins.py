"""Lookups: currencies, rates, market rules, zones, exchange facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.functions import currency, values
from marketframe.operators.scan import request_grid
from marketframe.operators.shape import melt_wide_panel, panel_columns


def security_field_scaffold(ref: DataFrame, tickers: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every ticker with every field; null where the snapshot has no value."""
    grid = request_grid(tickers, fields)
    return grid.join(ref.select("ticker", "field", "value"), ["ticker", "field"], "left")


def currency_lookup(ref: DataFrame, pos: str | None = None) -> DataFrame:
    """Currency per ticker: trimmed, blanks dropped, the later row wins.

    ``pos`` (by default a column of that name, where there is one) orders the
    rows; without it a ticker with two different currencies is an error.
    """
    pos = pos or ("pos" if "pos" in ref.columns else None)
    rows = ref.where(F.upper("field") == "CRNCY").withColumn("crncy", F.trim("value")).where(F.col("crncy") != "")
    if pos:
        return rows.groupBy("ticker").agg(F.max_by("crncy", pos).alias("crncy"))
    doubled = F.raise_error(F.concat(F.lit("several currencies and no position: "), F.col("ticker")))
    ends = rows.groupBy("ticker").agg(F.min("crncy").alias("_first"), F.max("crncy").alias("_last"))
    return ends.select("ticker", F.when(F.col("_first") == F.col("_last"), F.col("_last")).otherwise(doubled).alias("crncy"))


def fx_terms(ref: DataFrame, target: str, pos: str | None = None) -> DataFrame:
    """Per ticker: currency, pair, factor and whether a conversion is needed."""
    ccy, to = F.col("crncy"), F.lit(target)
    needs = ~currency.same_currency(ccy, to)
    return currency_lookup(ref, pos).select(
        "ticker", "crncy",
        F.when(needs, currency.fx_pair(ccy, to)).alias("pair"),
        F.when(needs, currency.fx_factor(ccy)).otherwise(F.lit(1.0)).alias("factor"),
        needs.alias("needs_conversion"),
    )


def fx_requirements(ref: DataFrame, target: str, pos: str | None = None) -> DataFrame:
    """Distinct pairs the conversion of a table needs."""
    return fx_terms(ref, target, pos).where("needs_conversion").select("pair").distinct()


def currencies_needing_conversion(currencies: DataFrame, target: str, col: str = "crncy") -> DataFrame:
    """Distinct currencies other than the target, compared without case, in order."""
    return currencies.where(~currency.same_currency(F.col(col), F.lit(target))).select(col).distinct().orderBy(col)


def rates_by_day(fx: DataFrame) -> DataFrame:
    """(pair, date, rate) of the rate history."""
    return fx.where(F.col("field") == "PX_LAST").select(
        F.col("ticker").alias("pair"), "date", F.col("value").alias("rate")
    )


def fx_join_long(hist: DataFrame, ref: DataFrame, fx: DataFrame, target: str, missing_rate: str = "keep") -> DataFrame:
    """Convert long history at the rate of the same day: value / (rate * factor).

    Without a usable rate (absent or zero) the value stays (``keep``) or
    becomes null (``null``). ``local`` as target, a table without dates and
    tickers already in the target currency stay as they are.
    """
    if missing_rate not in ("keep", "null"):
        raise ValueError("missing_rate must be keep or null")
    if target.lower() == "local" or "date" not in hist.columns:
        return hist
    terms = fx_terms(ref, target).select("ticker", "pair", "factor")
    joined = hist.join(terms, "ticker", "left").join(rates_by_day(fx), ["pair", "date"], "left")
    number = F.col("value").try_cast("double")
    usable = F.col("rate").isNotNull() & (F.col("rate") != 0) & number.isNotNull()
    fallback = F.col("value") if missing_rate == "keep" else F.when(F.col("pair").isNull(), F.col("value"))
    value = F.when(usable, (number / (F.col("rate") * F.col("factor"))).cast(hist.schema["value"].dataType))
    return joined.withColumn("value", value.otherwise(fallback)).select(*hist.columns)


def fx_join_wide(panel: DataFrame, ref: DataFrame, fx: DataFrame, target: str) -> DataFrame:
    """Convert a wide panel column by column.

    A day without a rate gives null; a column none of whose days has a rate
    stays as it is. Rates next to zero count as missing.
    """
    cols = panel_columns(panel.columns)
    names = {c: c.split("|", 1)[0] for c in cols}
    long = melt_wide_panel(panel)
    terms = fx_terms(ref, target).where("needs_conversion").select("ticker", "pair", "factor")
    rates = rates_by_day(fx).where(F.abs("rate") > 2.220446049250313e-16)
    rated = (
        long.join(terms, "ticker", "left").join(rates, ["pair", "date"], "left")
        .withColumn("column", F.concat_ws("|", "ticker", "field"))
        .withColumn("converted", F.col("value") / (F.col("rate") * F.col("factor")))
    )
    found = rated.groupBy("column").agg(
        F.max(F.col("pair").isNotNull() & F.col("rate").isNotNull()).alias("_any")
    )
    chosen = rated.join(found, "column").withColumn(
        "value", F.when(F.col("_any"), F.col("converted")).otherwise(F.col("value"))
    )
    wide = chosen.groupBy("date").agg(*[
        F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in names
    ])
    rest = [c for c in panel.columns if c not in names and c != "date"]
    if rest:
        wide = panel.select("date", *rest).join(wide, "date")
    return wide.select(*panel.columns)


def currency_series(hist: DataFrame, ref: DataFrame, fx: DataFrame, ticker: str, ccy: str) -> DataFrame:
    """History of one ticker in a currency."""
    return fx_join_long(hist.where(F.col("ticker") == ticker), ref, fx, ccy)


def missing_tickers(tickers: DataFrame, found: DataFrame) -> DataFrame:
    """Requested tickers without a row in ``found``."""
    return tickers.join(found.select("ticker"), "ticker", "left_anti")


def unknown_fields(fields: DataFrame, catalog: DataFrame) -> DataFrame:
    known = catalog.select(F.upper("field").alias("_known"))
    return fields.join(known, F.upper(fields["field"]) == F.col("_known"), "left_anti")


def validate_fields(fields: DataFrame, catalog: DataFrame, mode: str = "strict") -> DataFrame:
    """Unknown fields: raise (``strict``), return them (``lenient``) or skip the check (``disabled``)."""
    if mode not in ("strict", "lenient", "disabled"):
        raise ValueError("mode must be strict, lenient or disabled")
    if mode == "disabled":
        return fields.limit(0)
    unknown = unknown_fields(fields, catalog)
    if mode == "strict":
        # only names for the message travel to the driver, as many as the request has fields
        names = [r["field"] for r in unknown.select("field").distinct().collect()]
        if names:
            raise ValueError(f"unknown fields: {', '.join(sorted(names))}")
    return unknown


def vwap_volume_self_join(hist: DataFrame, price: str = "EQY_WEIGHTED_AVG_PX", volume: str = "VOLUME") -> DataFrame:
    """Price and volume of the same ticker and day side by side; rows with both only.

    A conditional aggregate: one shuffle instead of a self join.
    """
    pair = hist.where(F.col("field").isin(price, volume)).groupBy("ticker", "date").agg(
        F.max(F.when(F.col("field") == price, F.col("value"))).alias("vwap"),
        F.max(F.when(F.col("field") == volume, F.col("value"))).alias("volume"),
    )
    return pair.where(F.col("vwap").isNotNull() & F.col("volume").isNotNull())


def market_rule_join(df: DataFrame) -> DataFrame:
    """Add ``rule``: by MIC, else by exchange code, else null.

    The rules are constants of a few dozen entries, so they travel with the
    plan as literal maps and need no join.
    """
    by_mic = F.try_element_at(refdata.rule_map(refdata.MIC_RULES), F.trim("mic"))
    by_code = F.try_element_at(refdata.rule_map(refdata.EXCHANGE_RULES), F.trim("exch_code"))
    return df.withColumn("rule", F.coalesce(by_mic, by_code))


def infer_timezone(country: Column) -> Column:
    """Zone of an ISO country code; null if unknown."""
    return F.try_element_at(refdata.literal_map(refdata.COUNTRY_ZONES), F.upper(F.trim(country)))


def timezone_join(df: DataFrame, iana: str = "iana_tz", country: str = "country") -> DataFrame:
    """Zone of a ticker: its IANA field, else its country's, else UTC; with the source named."""
    staged = df.withColumns({"_own": values.clean_value(F.col(iana)), "_zone": infer_timezone(F.col(country))})
    return staged.withColumns({
        "timezone": F.coalesce("_own", "_zone", F.lit("UTC")),
        "tz_source": F.when(F.col("_own").isNotNull(), "vendor").when(F.col("_zone").isNotNull(), "inferred")
        .otherwise("fallback"),
    }).drop("_own", "_zone")


def exchange_resolve(
    tickers: DataFrame, overrides: DataFrame, cached: DataFrame, source: DataFrame, attributes: Sequence[str]
) -> DataFrame:
    """Exchange facts per ticker by precedence: override, cache, source, fallback.

    The first layer that knows a ticker supplies all attributes; an override
    alone patches single attributes on top of the layer below.
    """
    layers = [("override", overrides), ("cache", cached), ("source", source)]
    tagged = None
    for rank, (name, df) in enumerate(layers):
        part = df.select("ticker", F.lit(rank).alias("_rank"), F.struct(*attributes).alias("_facts"))
        tagged = part if tagged is None else tagged.unionByName(part)
    facts = tagged.groupBy("ticker").agg(
        F.max(F.when(F.col("_rank") == 0, F.col("_facts"))).alias("_patch"),
        F.min(F.when(F.col("_rank") > 0, F.struct("_rank", "_facts"))).alias("_base"),
    )
    out = tickers.join(facts, "ticker", "left")
    cols = [F.coalesce(F.col(f"_patch.{a}"), F.col(f"_base._facts.{a}")).alias(a) for a in attributes]
    origin = (
        F.when(F.col("_patch").isNotNull(), "override").when(F.col("_base._rank") == 1, "cache")
        .when(F.col("_base._rank") == 2, "source").otherwise("fallback")
    )
    return out.select("ticker", *cols, origin.alias("source"))


def override_patch(log: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Current override per ticker from a log (ticker, seq, attributes).

    Later non-null attributes overwrite earlier ones; an entry with no
    attribute or a blank ticker is refused (left out).
    """
    any_set = F.coalesce(*attributes).isNotNull() if len(attributes) == 1 else F.greatest(
        *[F.col(a).isNotNull() for a in attributes]
    )
    valid = log.where((F.trim("ticker") != "") & any_set)
    # max_by skips rows without an order value, so null attributes never win
    return valid.groupBy("ticker").agg(*[
        F.max_by(a, F.when(F.col(a).isNotNull(), F.col("seq"))).alias(a) for a in attributes
    ])


def clear_overrides(current: DataFrame, tickers: DataFrame) -> DataFrame:
    return current.join(tickers.select("ticker"), "ticker", "left_anti")


def zip_columns(df: DataFrame, ids: str, vals: str, keys: Sequence[str]) -> DataFrame:
    """Two arrays paired by position; the shorter one is padded with null."""
    zipped = F.arrays_zip(F.col(ids).alias("id"), F.col(vals).alias("value"))
    return df.select(*keys, F.posexplode(zipped).alias("pos", "_z")).select(*keys, "pos", "_z.id", "_z.value")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row per key: a partial maximum per task, so a hot key costs no more than another."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows per key; Spark cuts each task to n per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
