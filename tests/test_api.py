"""The entry point and its output formats."""

import datetime

import pytest

from marketframe.api import FORMATS, MarketData, to_client

D = datetime.date


@pytest.fixture(scope="module")
def md(spark):
    hist = [("A US Equity", D(2024, 1, d), f, v) for d in (2, 3, 9) for f, v in (("PX_LAST", 10.0 * d), ("VOLUME", 5.0))]
    return MarketData(
        spark,
        snapshot=spark.createDataFrame([("A US Equity", "NAME", "Alpha"), ("A US Equity", "SIZE", "7")], "ticker string, field string, value string"),
        history=spark.createDataFrame(hist, "ticker string, date date, field string, value double"),
        ticks=spark.createDataFrame(
            [("A US Equity", datetime.datetime(2024, 1, 2, 10, 0, i), "TRADE", float(i), 1, i) for i in range(5)],
            "ticker string, time timestamp, type string, value double, size bigint, event_id bigint"),
        field_types={"SIZE": "int64", "NAME": "string"},
    )


def test_reference_formats(md):
    get = lambda f: md.reference("A US Equity", ["NAME", "SIZE"], f)
    assert get("long").columns == ["ticker", "field", "value"]
    assert get("semi_long").first().SIZE == 7
    assert get("wide").first().SIZE == "7"
    assert {r.dtype for r in get("long_metadata").collect()} == {"int64", "string"}
    assert [r.value_i64 for r in get("long_typed").where("field = 'SIZE'").collect()] == [7]
    assert '"NAME":"Alpha"' in get("json").first().json
    assert md.reference(["A US Equity"], ["SIZE"]).schema["value"].dataType.simpleString() == "double"
    with pytest.raises(ValueError, match=FORMATS[0]):
        get("tidy")


def test_daily(md):
    assert md.daily("A US Equity").schema["value"].dataType.simpleString() == "double"
    wide = md.daily(["A US Equity"], ["PX_LAST", "VOLUME"], "2024-01-01", "2024-01-31", "semi_long").orderBy("date").collect()
    assert [(r.date.day, r.PX_LAST, r.VOLUME) for r in wide] == [(2, 20.0, 5.0), (3, 30.0, 5.0), (9, 90.0, 5.0)]
    weekly = md.daily("A US Equity", period="W").orderBy("date").collect()
    assert [r.date.day for r in weekly] == [3, 9]
    assert md.daily("A US Equity", fill="P", days="A").count() == 8
    short = md.daily("A US Equity", Per="W", Fill="P", Days="A")
    assert short.collect() == md.daily("A US Equity", period="W", fill="P", days="A").collect()
    with pytest.raises(ValueError, match="Per"):
        md.daily("A US Equity", Period="W")


def test_bars_and_request(md):
    bar = md.bars("A US Equity", dt="2024-01-02").first()
    assert (bar.open, bar.close, bar.numEvents) == (0.0, 4.0, 5)
    with pytest.raises(ValueError):
        md.bars("A US Equity")
    assert md.request("history", {"field": "VOLUME"}, ["date", "value"]).count() == 3
    with pytest.raises(ValueError, match="holdings"):
        md.portfolio("X", ["a"])


def test_whole_days_and_days_before_the_first_point(spark, md):
    late = spark.createDataFrame([("A US Equity", datetime.datetime(2024, 1, 2, 23, 59, 59, 500_000), "TRADE", 9.0, 1, 1)], md.ticks.schema)
    assert MarketData(spark, ticks=late).bars("A US Equity", dt="2024-01-02").count() == 1
    filled = md.daily("A US Equity", start="2024-01-05", end="2024-01-10", fill="P", days="A").orderBy("date").collect()
    assert [(r.date.day, r.value) for r in filled] == [(5, 30.0), (6, 30.0), (7, 30.0), (8, 30.0), (9, 90.0), (10, 90.0)]


def test_adjusted_range(spark):
    hist = spark.createDataFrame([("A", D(2024, 1, d), f, 10.0) for d in (2, 3) for f in ("PX_LAST", "EQY_WEIGHTED_AVG_PX", "VOLUME", "PE_RATIO")], "ticker string, date date, field string, value double")
    actions = spark.createDataFrame([("A", D(2024, 1, 3), "split", 0.5), ("B", D(2024, 1, 9), "split", 0.1)], "ticker string, date date, kind string, factor double")
    got = MarketData(spark, history=hist).daily("A", ["PX_LAST", "EQY_WEIGHTED_AVG_PX", "VOLUME", "PE_RATIO"], "2024-01-01", "2024-01-31", adjust="all", actions=actions).collect()
    assert {(r.field, r.value) for r in got if r.date.day == 2} == {("PX_LAST", 5.0), ("EQY_WEIGHTED_AVG_PX", 5.0), ("VOLUME", 20.0), ("PE_RATIO", 10.0)}
    assert {r.value for r in got if r.date.day == 3} == {10.0}


def test_handover_is_bounded(md):
    assert len(to_client(md.daily("A US Equity"))) == 3
    assert to_client(md.daily("A US Equity"), "arrow").num_rows == 3
    with pytest.raises(ValueError, match="more than"):
        to_client(md.daily("A US Equity"), max_rows=2)
    with pytest.raises(ValueError):
        to_client(md.daily("A US Equity"), "polars")


def test_name_tables(spark):
    from marketframe import refdata
    from marketframe.operators import studies

    assert dict(map(tuple, refdata.name_frame(spark, "month_codes").collect()))["H"] == "Mar"
    assert refdata.name_frame(spark, "dividend_types").count() == 10
    with pytest.raises(ValueError):
        refdata.name_frame(spark, "other")
    assert studies.ta_study_params("Stoch")["period_k"] == 14 and "rsi" in studies.ta_studies()
    with pytest.raises(ValueError, match="available"):
        studies.study(spark.range(1), "nope")
