"""Scalar functions on the published sample cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from marketframe.functions import contracts, currency, dates, values
from marketframe.operators import calendars, joins, predicates


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("text, want", [
    ("2024-01-15", datetime.date(2024, 1, 15)), ("20240115", datetime.date(2024, 1, 15)), ("2024/01/15", datetime.date(2024, 1, 15)),
    ("15-01-2024", datetime.date(2024, 1, 15)), (" 15/01/2024 ", datetime.date(2024, 1, 15)), ("2024-02-30", None), ("x", None),
])
def test_parse_date(spark, text, want):
    assert one(spark, dates.parse_date(lit(text))) == want


def test_parse_any_date(spark):
    assert one(spark, dates.parse_any_date(lit("2024-03-15T10:00:00"))) == datetime.date(2024, 3, 15)
    assert one(spark, dates.parse_any_date(lit("  "))) is None
    assert one(spark, dates.parse_any_date(lit("not-a-date"))) is None


@pytest.mark.parametrize("text, n, want", [("23:50", 20, "00:10"), ("00:10", -20, "23:50"), ("09:30", -330, "04:00"), ("25:00", 1, None)])
def test_add_minutes(spark, text, n, want):
    assert one(spark, dates.add_minutes(lit(text), n)) == want


@pytest.mark.parametrize("text, want", [("9:05", "09:05"), ("0930", "09:30"), ("09:30:59", "09:30"), ("24:00", None), ("9:60", None), ("930", None), ("", None)])
def test_parse_hhmm(spark, text, want):
    assert one(spark, dates.parse_hhmm(lit(text))) == want


def test_date_offset(spark):
    now = F.lit("2024-03-31 12:00:00").cast("timestamp")
    for text, want in (("-2d", "2024-03-29 12:00:00"), ("1w", "2024-04-07 12:00:00"), ("-1m", "2024-03-01 12:00:00"), ("-4h", "2024-03-31 08:00:00"), ("2x", None)):
        got = one(spark, F.date_format(dates.date_offset(lit(text), now), "yyyy-MM-dd HH:mm:ss"))
        assert got == want


@pytest.mark.parametrize("text, want", [
    ("2025-11-14 09:30:00", "2025-11-14 14:30:00"), ("2024-03-10 02:30:00", None), ("2024-11-03 01:30:00", None),
    ("2024-03-10 03:30:00", "2024-03-10 07:30:00"), ("2024-11-03 00:30:00", "2024-11-03 04:30:00"), ("2024-11-03 02:30:00", "2024-11-03 07:30:00"),
    ("2025-07-01T10:00:00+02:00", "2025-07-01 08:00:00"), ("2025-07-01", "2025-07-01 04:00:00"), ("junk", None),
])
def test_wall_to_utc(spark, text, want):
    got = one(spark, F.date_format(dates.wall_to_utc(lit(text), lit("America/New_York")), "yyyy-MM-dd HH:mm:ss"))
    assert got == want


def test_timezone_alias(spark):
    cases = {"NY": "America/New_York", "ln": "Europe/London", "UTC": "UTC", "exchange": "Asia/Tokyo", "Asia/Hong_Kong": "Asia/Hong_Kong", "Mars": None}
    for name, want in cases.items():
        assert one(spark, dates.timezone_alias(lit(name), lit("Asia/Tokyo"))) == want


@pytest.mark.parametrize("ticker, specific", [
    ("UXZ5 Index", True), ("UXZ24 Index", True), ("ESAM24 Index", True), ("ESH24 Index", True), ("CLZ24 Comdty", True), ("ES1 Index", False),
    ("UX1 Index", False), ("ESA1 Index", False), ("ES2 Index", False), ("CL1 Comdty", False), ("H24 Index", False), ("ESH245 Index", False),
])
def test_specific_contracts(spark, ticker, specific):
    assert one(spark, contracts.is_specific_contract(lit(ticker))) is specific


def test_parse_ticker(spark):
    p = one(spark, contracts.parse_ticker(lit("ES1 Index")))
    assert (p.prefix, p["index"], p.asset, p.exchange) == ("ES", 1, "Index", None)
    p = one(spark, contracts.parse_ticker(lit("SPY2 US Equity")))
    assert (p.prefix, p["index"], p.asset, p.exchange) == ("SPY", 2, "Equity", "US")
    for bad in ("ES Index", "ES10 Index", "ES0 Index"):
        assert one(spark, contracts.parse_ticker(lit(bad))) is None
    assert one(spark, contracts.parse_ticker(lit("SPY1 Equity"))) is None


def test_candidates(spark):
    day = lit("2024-01-15").cast("date")
    months = lambda f, n: [d.month for d in one(spark, contracts.contract_months(day, f, lit(n)))]
    assert months("monthly", 3) == [1, 2, 3]
    assert months("quarterly", 4) == [3, 6, 9, 12]
    assert one(spark, contracts.candidate_count(lit("ES1 Index"))) == 3
    assert one(spark, contracts.candidate_count(lit("CL3 Comdty"))) == 6
    with pytest.raises(ValueError):
        contracts.contract_months(day, "daily", lit(1))


def test_credit_indices(spark):
    p = one(spark, contracts.parse_cdx(lit("CDX IG CDSI GEN 5Y Corp")))
    assert (p["index"], p.series, p.tenor, p.asset, p.is_generic, p.series_num) == ("CDX IG CDSI", "GEN", "5Y", "Corp", True, None)
    assert one(spark, contracts.previous_series(lit("CDX IG CDSI S45 5Y Corp"))) == "CDX IG CDSI S44 5Y Corp"
    assert one(spark, contracts.previous_series(lit("CDX IG CDSI S1 5Y Corp"))) is None
    assert one(spark, contracts.previous_series(lit("CDX IG CDSI GEN 5Y Corp"))) is None
    assert one(spark, contracts.gen_to_specific(lit("CDX IG CDSI GEN 5Y Corp"), lit(45))) == "CDX IG CDSI S45 5Y Corp"
    assert one(spark, contracts.with_version(lit("CDX IG CDSI S45 V2 5Y Corp"), lit(3))) == "CDX IG CDSI S45 V3 5Y Corp"
    assert one(spark, contracts.with_version(lit("CDX IG CDSI S45 5Y Corp"), lit(1))) == "CDX IG CDSI S45 5Y Corp"
    assert one(spark, contracts.strip_version(lit("CDX IG CDSI S45 V2 5Y Corp"))) == "CDX IG CDSI S45 5Y Corp"
    assert one(spark, contracts.tenor_tickers(lit("CDX IG CDSI GEN 5Y Corp"), ["3Y", "10Y"])) == ["CDX IG CDSI GEN 3Y Corp", "CDX IG CDSI GEN 10Y Corp"]
    assert one(spark, contracts.tenor_tickers(lit("ITRX EUR Corp"), ["3Y"])) == ["ITRX EUR Corp"]


@pytest.mark.parametrize("text, want", [("45", 45), ("45.0", 45), ("45.5", None), ("abc", None), ("0", None)])
def test_series_number(spark, text, want):
    assert one(spark, contracts.parse_series_number(lit(text))) == want


def test_currency(spark):
    assert one(spark, currency.fx_pair(lit("GBp"), lit("usd"))) == "USDGBP Curncy"
    assert one(spark, currency.fx_factor(lit("GBp"))) == 100.0
    same = one(spark, currency.ccy_pair(lit("GBp"), lit("GBP")))
    assert (same.ticker, same.factor) == ("", 100.0)
    assert one(spark, currency.ccy_pair(lit("GBP"), lit("GBp"))).factor == 0.01
    other = one(spark, currency.ccy_pair(lit("GBp"), lit("USD")))
    assert (other.ticker, other.factor, other.power) == ("USDGBP Curncy", 100.0, 1.0)


def test_values(spark):
    assert one(spark, values.parse_amount(lit("1,234.5"))) == 1234.5
    assert one(spark, values.parse_level(lit("2.0"))) == 2
    assert one(spark, values.parse_level(lit("2.5"))) is None
    assert one(spark, values.clean_value(lit(" nan "))) is None
    assert one(spark, values.yield_flag(lit("yield to worst"))) == 5
    assert one(spark, values.yield_flag(lit("10"))) is None
    assert one(spark, values.dividend_field(lit("split"))) == "Eqy_DVD_Hist_Splits"
    assert one(spark, values.dividend_field(lit("Custom"))) == "Custom"
    assert one(spark, values.engine_type(lit("Integer"))) == "int64"


def test_coerce(spark):
    to = lambda v, a, b: one(spark, values.coerce(v, a, b))
    assert to(lit("1.5"), "string", "float64") is None
    assert to(lit(True), "bool", "float64") == 1.0
    assert to(lit(2**32 + 7).cast("bigint"), "int64", "int32") == 7
    assert to(lit(2**31).cast("bigint"), "int64", "int32") == -(2**31)
    assert to(lit("2024-01-02 03:04:05.5").cast("timestamp"), "timestamp", "string") == "2024-01-02T03:04:05.500000Z"
    assert to(lit("2024-01-02 03:04:05.5").cast("timestamp"), "timestamp", "time64") == "03:04:05.500000"


SESSIONS = [
    ("09:30", "16:00", "XNYS", "US", {"day": "09:30-16:00", "pre": "04:00-09:30", "post": "16:01-20:00", "allday": "04:00-20:00"}),
    ("09:00", "15:00", "XTKS", "", {"am": "09:00-11:30", "pm": "12:30-15:00", "pre": "08:00-09:00", "post": "15:01-15:30"}),
    ("18:00", "17:00", "XCME", "", {"day": "18:00-17:00", "allday": "18:00-17:00", "pre": None, "post": None, "am": None}),
    ("10:00", "11:00", "", "??", {"day": "10:00-11:00", "allday": "10:00-11:00", "pre": None}),
    ("bad", "11:00", "XNYS", "", {"day": None, "allday": None, "pre": None}),
]


@pytest.mark.parametrize("start, end, mic, code, want", SESSIONS)
def test_sessions(spark, start, end, mic, code, want):
    df = spark.createDataFrame([(mic, code, start, end)], "mic string, exch_code string, day_start string, day_end string")
    got = calendars.with_sessions(df).first().sessions
    for name, text in want.items():
        window = got[name]
        assert (f"{window.start}-{window.end}" if window else None) == text


def test_market_timing(spark):
    df = spark.createDataFrame([("XNYS", "US", "09:30", "16:00", datetime.date(2025, 11, 14), "America/New_York")],
                               "mic string, exch_code string, day_start string, day_end string, date date, timezone string")
    rows = calendars.with_sessions(df)
    timing = lambda t, z: calendars.market_timing(rows, "x", t, z).first().x
    assert timing("EOD", "local") == "2025-11-14 16:00"
    assert timing("EOD", "Europe/London") == "2025-11-14 21:00:00+00:00"
    assert timing("FINISHED", "local") == "2025-11-14 20:00"
    assert timing("BOD", "Asia/Tokyo") == "2025-11-14 23:30:00+09:00"


def test_unknown_session_is_refused():
    with pytest.raises(ValueError, match="available"):
        predicates.session_bounds("lunch", F.lit(1))


def test_session_grammar_is_checked(spark):
    with pytest.raises(ValueError, match="grammar"):
        predicates.session_bounds("day_open", F.col("sessions"))


def test_override_patch_keeps_earlier_attributes(spark):
    log = spark.createDataFrame(
        [("A", 1, "UTC", None), ("A", 2, None, "XNYS"), ("A", 3, "Asia/Tokyo", None), (" ", 4, "x", None), ("B", 5, None, None)],
        "ticker string, seq int, timezone string, mic string")
    out = joins.override_patch(log, ["timezone", "mic"])
    assert [tuple(r) for r in out.collect()] == [("A", "Asia/Tokyo", "XNYS")]
    assert joins.clear_overrides(out, spark.createDataFrame([("A",)], "ticker string")).count() == 0
