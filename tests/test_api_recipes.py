"""Recipes at the entry point: each call gives the rows of its recipe, with the client's own tables."""

import datetime

import pytest

from marketframe.api import MarketData
from marketframe.plans import recipes

D, T = datetime.date, datetime.datetime
SNAPSHOT = "ticker string, field string, value string"
HISTORY = "ticker string, date date, field string, value double"


def test_vwap_of_a_day_and_of_a_time_window(spark):
    at = lambda d, h: T(2024, 1, d, h)
    rows = [("A", at(2, 10), "TRADE", 10.0, 1, 1), ("A", at(2, 12), "TRADE", 20.0, 3, 2), ("A", at(2, 12), "BID", 99.0, 9, 3), ("A", at(3, 10), "TRADE", 50.0, 5, 4), ("B", at(2, 10), "TRADE", 1.0, 1, 5)]
    md = MarketData(spark, ticks=spark.createDataFrame(rows, "ticker string, time timestamp, type string, value double, size bigint, event_id bigint"))
    day = md.vwap("A", dt="2024-01-02").collect()
    assert [(r.ticker, r.vwap, r.volume, r.turnover) for r in day] == [("A", 17.5, 4, 70.0)]
    assert md.vwap("A", dt="2024-01-02", start_time="11:00", end_time="13:00").first().vwap == 20.0
    with pytest.raises(ValueError, match="dt"):
        md.vwap("A")


def test_earnings_by_choice(spark):
    row = "struct<pos:int,level:int,segment:string,`Period 1 Value`:double,`Period 1 Header`:string>"
    data = lambda *figures: [(i, 1, f"s{i}", v, None) for i, v in enumerate(figures)]
    header = [(None, None, None, None, "FY 2023")]
    rows = [("A", "PG_Bulk_Header", "G", None, header), ("A", "PG_Bulk_Header", "P", None, [(None, None, None, None, "FY 2020")]),
            ("A", "PG_Revenue", "G", "USD", data(30.0, 10.0)), ("A", "PG_Revenue", "G", "EUR", data(3.0, 1.0)),
            ("A", "PG_Revenue", "P", "USD", data(5.0)), ("A", "PG_Assets", "G", "USD", data(7.0)), ("B", "PG_Revenue", "G", "USD", data(9.0))]
    bulk = spark.createDataFrame(rows, f"ticker string, field string, Product_Geo_Override string, Eqy_Fund_Crncy string, rows array<{row}>")
    md = MarketData(spark, bulk=bulk)
    got = md.earnings("A", ccy="USD").orderBy("pos")
    assert [c for c in got.columns if c.startswith("fy")] == ["fy2023", "fy2023_pct"] and not any("Header" in c for c in got.columns)
    assert [(r.segment, r.fy2023, r.fy2023_pct) for r in got.collect()] == [("s0", 30.0, 75.0), ("s1", 10.0, 25.0)]
    assert [r.fy2023 for r in md.earnings("A", ccy="EUR").orderBy("pos").collect()] == [3.0, 1.0]
    assert [r.fy2020 for r in md.earnings("A", by="product", ccy="USD").collect()] == [5.0]
    assert [r.fy2023 for r in md.earnings("A", typ="Assets").collect()] == [7.0]
    assert recipes.earning_choices("p", "USD", 2, 2023, 4) == (
        {"Product_Geo_Override": "P", "Eqy_Fund_Year": "2023", "Number_Of_Periods": "4"},
        {"Product_Geo_Override": "P", "Eqy_Fund_Year": "2023", "Number_Of_Periods": "4", "Eqy_Fund_Crncy": "USD", "PG_Hierarchy_Level": "2"})
    with pytest.raises(ValueError, match="Product"):
        md.earnings("A", by="region")


def test_rolls_for_names_and_dates(spark):
    chain = spark.createDataFrame([("ES1 Index", "ESH24 Index", D(2024, 3, 15)), ("ES1 Index", "ESM24 Index", D(2024, 6, 21))], "gen_ticker string, contract string, last_trade_date date")
    hist = spark.createDataFrame([("ESH24 Index", D(2024, 3, 4), "VOLUME", 1.0), ("ESM24 Index", D(2024, 3, 4), "VOLUME", 9.0)], HISTORY)
    md = MarketData(spark, contracts=chain, history=hist)
    got = {(r.gen_ticker, str(r.dt)): r.contract for r in md.futures_contract(["ES1 Index", "ES2 Index"], ["2024-02-01", "2024-04-01"]).collect()}
    assert got[("ES1 Index", "2024-02-01")] == "ESH24 Index" and got[("ES2 Index", "2024-02-01")] == "ESM24 Index"
    assert got[("ES1 Index", "2024-04-01")] == "ESM24 Index"
    active = {str(r.dt): r.contract for r in md.futures_contract("ES1 Index", ["2024-02-01", "2024-03-05"], active=True).collect()}
    assert active == {"2024-02-01": "ESH24 Index", "2024-03-05": "ESM24 Index"}
    frame = md._points("ES1 Index", "2024-02-01")
    assert md.futures_contract(frame).first().contract == "ESH24 Index"
    with pytest.raises(ValueError, match="dates"):
        md.futures_contract("ES1 Index")


def test_credit_index(spark):
    gen = "CDX IG CDSI GEN 5Y Corp"
    facts = [(gen, "ROLLING_SERIES", "45"), (gen, "VERSION", "1"), (gen, "CDS_FIRST_ACCRUAL_START_DATE", "2025-09-20")]
    hist = spark.createDataFrame([("CDX IG CDSI S44 5Y Corp", D(2025, 10, 1), "PX_LAST", 1.0)], HISTORY)
    md = MarketData(spark, snapshot=spark.createDataFrame(facts, SNAPSHOT), history=hist)
    got = {str(r.dt): r.contract for r in md.credit_index(gen, ["2025-09-01", "2025-10-02"]).collect()}
    assert got == {"2025-09-01": "CDX IG CDSI S44 5Y Corp", "2025-10-02": "CDX IG CDSI S45 5Y Corp"}
    assert md.credit_index(gen, "2025-10-02", active=True).first().contract == "CDX IG CDSI S44 5Y Corp"


def test_types_from_the_catalog(spark):
    snapshot = spark.createDataFrame([("A", "SIZE", "7"), ("A", "NAME", "Alpha"), ("A", "RATE", "0.5")], SNAPSHOT)
    catalog = spark.createDataFrame([("1", "SIZE", "Integer", None, "", ""), ("2", "RATE", "Double", None, "", "")], "id string, mnemonic string, datatype string, ftype string, description string, category string")
    row = MarketData(spark, snapshot=snapshot, catalog=catalog).reference("A", ["SIZE", "NAME", "RATE"], "semi_long").first()
    assert (row.SIZE, row.NAME, row.RATE) == (7, "Alpha", 0.5)
    own = MarketData(spark, snapshot=snapshot, catalog=catalog, field_types={"SIZE": "string"}).reference("A", ["SIZE"], "semi_long")
    assert own.first().SIZE == "7"


def test_bonds_options_funds_and_conversion(spark):
    bonds = spark.createDataFrame([("b1", "n1", "X US Equity", "Corporates", "USD", D(2030, 1, 1), "c1"), ("b2", "n2", "X US Equity", "Corporates", "EUR", D(2020, 1, 1), "c2"), ("b3", "n3", "X US Equity", "Preferreds", "USD", D(2030, 1, 1), "c3")],
                                  "id string, name string, issuer string, asset_class string, crncy string, maturity date, consolidated_id string")
    options = spark.createDataFrame([("o1", "X", "Call", D(2024, 3, 15), 10.0, 11.0), ("o2", "X", "Put", D(2024, 3, 15), 20.0, 11.0), ("o3", "Y", "Call", D(2024, 3, 15), 10.0, 11.0)],
                                    "id string, underlying string, put_call string, expire_dt date, strike_px double, undl_px double")
    snapshot = spark.createDataFrame([("A", "CRNCY", "EUR")], SNAPSHOT)
    fx = spark.createDataFrame([("EURUSD Curncy", D(2024, 1, 2), "PX_LAST", 2.0)], HISTORY)
    md = MarketData(spark, snapshot=snapshot, fx=fx, bonds=bonds, options=options)
    assert [r.id for r in md.corporate_bonds("X").collect()] == ["b1"]
    assert {r.id for r in md.corporate_bonds("X", ccy=None).collect()} == {"b1", "b2"}
    assert [r.id for r in md.preferreds("X").collect()] == ["b3"]
    assert [r.id for r in md.option_chain("X", put_call="C").collect()] == ["o1"]
    assert [r.id for r in md.option_screen("X", strike_px=(15, None), columns=("id",)).collect()] == ["o2"]
    with pytest.raises(ValueError, match="funds"):
        md.fund_holdings("F")
    with pytest.raises(ValueError, match="unknown bundle"):
        md.bundle("nothing")


def test_converted_frames(spark):
    snapshot = spark.createDataFrame([("A", "CRNCY", "EUR")], SNAPSHOT)
    hist = spark.createDataFrame([("A", D(2024, 1, 2), "PX_LAST", 4.0)], HISTORY)
    md = MarketData(spark, snapshot=snapshot, fx=spark.createDataFrame([("USDEUR Curncy", D(2024, 1, 2), "PX_LAST", 2.0)], HISTORY))
    assert [r.value for r in md.converted(hist, "USD").collect()] == [2.0]
    assert md.converted(hist, "EUR").first().value == 4.0


def test_zones_of_request_and_output(spark):
    ticks = [("A US Equity", T(2024, 1, 2, h, 30), "TRADE", float(h), 1, h) for h in (4, 6, 23)] + [("A US Equity", T(2024, 1, 3, 4, 30), "TRADE", 28.0, 1, 28)]
    exchanges = spark.createDataFrame([("A US Equity", "America/New_York", None), ("B JP Equity", None, "JP")], "ticker string, iana_tz string, country string")
    md = MarketData(spark, ticks=spark.createDataFrame(ticks, "ticker string, time timestamp, type string, value double, size bigint, event_id bigint"), exchanges=exchanges)
    hours = lambda **kw: [r.open for r in md.bars("A US Equity", dt="2024-01-02", interval=60, **kw).orderBy("time").collect()]
    assert hours() == [4.0, 6.0, 23.0]
    # New York's day runs from 05:00 to 05:00 UTC
    for label in ("NY", "America/New_York", "exchange", "A US Equity"):
        assert hours(request_tz=label) == [6.0, 23.0, 28.0], label
    shown = md.trades("A US Equity", "2024-01-02 23:00:00", "2024-01-03 00:00:00", output_tz="B JP Equity").collect()
    assert [(r.time.hour, r.local_time.day, r.local_time.hour) for r in shown] == [(23, 3, 8)]
    assert "local_time" not in md.trades("A US Equity", "2024-01-02", "2024-01-03").columns
    with pytest.raises(ValueError, match="single"):
        md.bars(["A US Equity", "B JP Equity"], dt="2024-01-02", request_tz="exchange")
    with pytest.raises(ValueError, match="no exchange"):
        md.bars("A US Equity", dt="2024-01-02", output_tz="Z US Equity")
    with pytest.raises(ValueError, match="unknown zone"):
        md.bars("A US Equity", dt="2024-01-02", output_tz="Mars")
