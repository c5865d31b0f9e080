"""Futures and credit-index ticker grammar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe import refdata

_CODES = refdata.MONTH_CODES
# one index digit from 1 to 9, behind a prefix that does not end in a digit
_GENERIC = r"^(.*\D)([1-9])\D*$"
_SPECIFIC = r"^.{2,}[FGHJKMNQUVXZ][0-9]$|^.+[FGHJKMNQUVXZ][0-9]{2}$"
_TRAILING_3 = r"[0-9]{3}$"
_CDX = r"^(.*?)\s(GEN|S\d+)\s(?:V(\d+)\s)?(\S+)"


def tokens(ticker: Column) -> Column:
    return F.split(F.trim(ticker), r"\s+")


def month_code(month: Column) -> Column:
    """Letter of a month number 1..12, else null."""
    return F.when(month.between(1, 12), F.substring(F.lit(_CODES), month.cast("int"), F.lit(1)))


def month_number(code: Column) -> Column:
    """Month number of a letter, else null."""
    n = F.instr(F.lit(_CODES), F.upper(code))
    return F.when((F.length(code) == 1) & (n > 0), n)


def month_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in refdata.MONTH_NAMES]), month_number(code))


def parse_ticker(ticker: Column) -> Column:
    """struct<prefix,index,asset,exchange> of a generic ticker; null if it does not parse."""
    tok = tokens(ticker)
    asset = F.element_at(tok, -1)
    n = F.size(tok)
    equity = asset == "Equity"
    base = F.when(equity, tok[0]).otherwise(F.array_join(F.slice(tok, F.lit(1), F.greatest(n - 1, F.lit(0))), " "))
    exchange = F.when(equity, F.array_join(F.slice(tok, F.lit(2), F.greatest(n - 2, F.lit(0))), " "))
    known = (equity & (n >= 3)) | (asset.isin("Index", "Curncy", "Comdty", "Corp") & (n >= 2))
    return F.when(
        known & base.rlike(_GENERIC),
        F.struct(
            F.regexp_extract(base, _GENERIC, 1).alias("prefix"),
            F.regexp_extract(base, _GENERIC, 2).cast("int").alias("index"),
            asset.alias("asset"),
            exchange.alias("exchange"),
        ),
    )


def is_specific_contract(ticker: Column) -> Column:
    first = tokens(ticker)[0]
    return first.rlike(_SPECIFIC) & ~first.rlike(_TRAILING_3)


def specific_parts(ticker: Column) -> Column:
    """struct<root,month,year> of a specific contract's first token."""
    pattern = r"^(.+)([FGHJKMNQUVXZ])([0-9]{1,2})$"
    first = tokens(ticker)[0]
    return F.when(
        is_specific_contract(ticker),
        F.struct(
            F.regexp_extract(first, pattern, 1).alias("root"),
            month_number(F.regexp_extract(first, pattern, 2)).alias("month"),
            F.regexp_extract(first, pattern, 3).cast("int").alias("year"),
        ),
    )


def contract_index(ticker: Column) -> Column:
    return F.greatest(parse_ticker(ticker)["index"] - 1, F.lit(0))


def candidate_count(ticker: Column) -> Column:
    extra = F.when(parse_ticker(ticker)["asset"] == "Comdty", 4).otherwise(2)
    return F.greatest(contract_index(ticker) + extra, F.lit(3))


def with_generic_index(ticker: Column, n: int) -> Column:
    """The generic ticker with its index digit replaced."""
    tok = tokens(ticker)
    p = parse_ticker(ticker)
    tail = F.when(p["asset"] == "Equity", F.concat_ws(" ", p["exchange"], p["asset"])).otherwise(p["asset"])
    return F.when(F.size(tok) >= 2, F.concat(p["prefix"], F.lit(str(n)), F.lit(" "), tail))


def build_futures_ticker(parts: Column, month: Column, one_digit_year: Column) -> Column:
    """prefix + month letter + year + asset; an equity future keeps its exchange."""
    year = F.when(one_digit_year, (F.year(month) % 10).cast("string")).otherwise(
        F.lpad((F.year(month) % 100).cast("string"), 2, "0")
    )
    exchange = F.when(parts["asset"] == "Equity", F.concat(F.coalesce(parts["exchange"], F.lit("US")), F.lit(" ")))
    return F.concat(
        parts["prefix"], month_code(F.month(month)), year, F.lit(" "),
        F.coalesce(exchange, F.lit("")), parts["asset"],
    )


def contract_months(date: Column, freq: str, count: Column) -> Column:
    """First days of the next ``count`` contract months from the month of ``date``."""
    start = F.trunc(date, "month")
    if freq == "quarterly":
        start, step = F.add_months(start, F.pmod(-F.month(date), F.lit(3)).cast("int")), 3
    elif freq == "monthly":
        step = 1
    else:
        raise ValueError(f"unknown roll frequency {freq!r}: monthly or quarterly")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.add_months(start, (i * step).cast("int")))


def parse_cdx(ticker: Column) -> Column:
    """struct<index,series,version,tenor,asset,is_generic,series_num>; null if not a credit index."""
    tok = tokens(ticker)
    t = F.array_join(tok, " ")
    series = F.regexp_extract(t, _CDX, 2)
    return F.when(
        (F.size(tok) >= 5) & t.rlike(_CDX),
        F.struct(
            F.regexp_extract(t, _CDX, 1).alias("index"),
            series.alias("series"),
            F.regexp_extract(t, _CDX, 3).try_cast("int").alias("version"),
            F.regexp_extract(t, _CDX, 4).alias("tenor"),
            F.element_at(tok, -1).alias("asset"),
            (series == "GEN").alias("is_generic"),
            F.substring(series, 2, 10).try_cast("int").alias("series_num"),
        ),
    )


def build_cdx(parts: Column, series_num: Column) -> Column:
    return F.concat(
        parts["index"], F.lit(" S"), series_num.cast("string"), F.lit(" "), parts["tenor"], F.lit(" "), parts["asset"]
    )


def previous_series(ticker: Column) -> Column:
    """Ticker of the series before; null for a generic ticker or series 1."""
    p = parse_cdx(ticker)
    return F.when(~p["is_generic"] & (p["series_num"] > 1), build_cdx(p, p["series_num"] - 1))


def gen_to_specific(ticker: Column, series: Column) -> Column:
    p = parse_cdx(ticker)
    return F.when(p.isNotNull(), build_cdx(p, series))


def strip_version(ticker: Column) -> Column:
    return F.regexp_replace(ticker, r"(\sS\d+)\sV\d+(?=\s|$)", "$1")


def with_version(ticker: Column, version: Column) -> Column:
    """Put ``V{n}`` behind the series token when n > 1."""
    marked = F.regexp_replace(strip_version(ticker), r"(\sS\d+)(?=\s|$)", "$1 V#")
    return F.when(version > 1, F.replace(marked, F.lit("V#"), F.concat(F.lit("V"), version.cast("string")))).otherwise(ticker)


def parse_series_number(text: Column) -> Column:
    """Whole number from 1 up, also written ``45.0``; null otherwise."""
    n = F.trim(text).try_cast("double")
    return F.when((n >= 1) & (n == F.rint(n)), n.try_cast("int"))


def tenor_tickers(ticker: Column, tenors: list[str]) -> Column:
    """One ticker per tenor, replacing the first known tenor token; itself if it has none."""
    known = "|".join(refdata.CDX_TENORS)
    pattern = rf"^((?:(?!(?:{known})(?:\s|$))\S+\s)*)({known})(?=\s|$)"
    each = F.array(*[F.regexp_replace(ticker, pattern, f"$1{t}") for t in tenors])
    return F.when(ticker.rlike(pattern), each).otherwise(F.array(ticker))
