"""Doubled cells, per-field adjustment, screen parameters, whole days and headers of several documents."""

import pytest

from marketframe.operators import joins, jsonq, predicates, scan, shape


def test_later_row_wins(spark):
    ref = spark.createDataFrame([("A", "CRNCY", "USD", 0), ("A", "CRNCY", "GBP", 1), ("A", "PX", "9", 0), ("A", "PX", "10", 1)], "ticker string, field string, value string, pos int")
    assert [r["crncy"] for r in joins.fx_terms(ref, "USD").collect()] == ["GBP"]
    with pytest.raises(Exception, match="several currencies"):
        joins.currency_lookup(ref.drop("pos")).collect()
    tickers = spark.createDataFrame([("A",)], "ticker string")
    assert [r["value"] for r in scan.ref_scan(ref, tickers, ["PX"]).collect()] == ["10"]
    assert shape.format_semi_long(ref, ["ticker"], ["PX"]).first()["PX"] == "10"
    hist = ref.selectExpr("*", "DATE '2024-01-02' AS date")
    assert [r["value"] for r in scan.hist_scan(hist, ["A"], ["PX"]).collect()] == ["10"]


def test_adjustment_is_per_field(spark):
    hist = spark.sql("SELECT 'A' ticker, DATE '2024-01-02' date, field, value FROM VALUES ('PX_LAST', 100.0D), ('VOLUME', 1000.0D), ('EPS', 3.0D) t(field, value)")
    actions = spark.sql("SELECT 'A' ticker, DATE '2024-02-01' date, kind, factor FROM VALUES ('split', 0.5D), ('cash', 0.9D) t(kind, factor)")
    got = {r["field"]: r["value"] for r in scan.hist_adjust(hist, actions, "all").collect()}
    assert got == {"PX_LAST": pytest.approx(45.0), "VOLUME": pytest.approx(2000.0), "EPS": 3.0}
    assert set(scan.hist_adjust(hist, actions, "all").columns) == set(hist.columns)


def test_screen_parameters_are_whole_names(spark):
    df = spark.createDataFrame([("x", "y'\\z"), ("x", "q")], "a string, b string")
    s = predicates.Screens()
    s.save("p", "a = :cc AND b = :ccy")
    assert s.run(df, "p", cc="x", ccy="y'\\z").count() == 1
    assert s.run(df, "p", cc=":ccy", ccy="q").count() == 0
    with pytest.raises(TypeError):
        s.run(df, "p", cc="x", ccy=["q"])


def test_whole_days(spark):
    ticks = spark.sql("SELECT 'A' ticker, 'BID' type, 1.0D value, 1L size, time FROM VALUES (TIMESTAMP '2024-01-10 23:59:59.5'), (TIMESTAMP '2024-01-11 00:00:00') t(time)")
    assert scan.bars_scan(ticks.drop("type"), None, dt="2024-01-10").count() == 1
    assert scan.quotes_scan(ticks, None, "2024-02-01", start="2024-01-10", end="2024-01-10").count() == 1
    with pytest.raises(ValueError):
        scan.quotes_scan(ticks, None, "2024-02-01", start="2024-01-10")


def test_headers_of_several_documents(spark):
    docs = spark.createDataFrame([(1, '{"results":[{"a":"1","b":"2"}]}'), (2, '{"results":[{"c":"3","d":"4"}]}')], "k int, doc string")
    got = {r["k"]: r.asDict() for r in jsonq.search_grid(docs, "doc", ["k"]).collect()}
    assert (got[1]["a"], got[1]["b"], got[2]["c"], got[2]["d"]) == ("1", "2", "3", "4") and got[1]["c"] is None


def test_headers_rename_columns(spark):
    data = spark.createDataFrame([("A", 1, 2, 3)], "ticker string, `Period 1 Value` int, `Period 2 Value` int, Other int")
    header = spark.createDataFrame([(None, "FY 2023", " - "), ("FY 2023", "FY 2024", "x")], "`Period 1 Header` string, `Period 2 Header` string, unused string")
    assert shape.earning_header_rename(data, header.coalesce(1)).columns == ["ticker", "fy2023", "Period 2 Value", "Other"]
