"""Operators on the published sample inputs."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from marketframe.operators import aggregate, joins, jsonq, predicates, scan, shape, status
from marketframe.plans import bundles, futures, recipes

D = datetime.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pivot(spark):
    df = spark.createDataFrame(
        [("AAPL", "PX_LAST", "1", 0), ("AAPL", "PX_LAST", "150.0", 1), ("AAPL", "VOLUME", "1000000", 2), ("MSFT", "PX_LAST", "300.0", 3),
         ("MSFT", "VOLUME", "5", 4), ("MSFT", "VOLUME", None, 5)], "ticker string, field string, value string, pos int")
    wide = shape.pivot_to_wide(df)
    assert wide.columns == ["ticker", "PX_LAST", "VOLUME"]
    assert rows(wide) == [("AAPL", "150.0", "1000000"), ("MSFT", "300.0", None)]
    assert shape.pivot_to_wide(wide) is wide
    empty = df.limit(0)
    assert shape.pivot_to_wide(empty).columns == empty.columns


def test_pivot_of_melt_is_identity(spark):
    df = spark.createDataFrame([("A", {"x": "1", "y": "2"}), ("B", {"x": "3", "y": "4"})], "ticker string, fields map<string,string>")
    long = shape.melt_snapshot(df)
    assert rows(shape.format_semi_long(long, ["ticker"], ["x", "y"])) == [("A", "1", "2"), ("B", "3", "4")]


def test_earnings(spark):
    data = spark.createDataFrame(
        [("A", "F", 0, "1", 100.0, 10.0), ("A", "F", 1, "1", 200.0, 30.0), ("A", "F", 2, "2", 50.0, 1.0), ("A", "F", 3, "2", 50.0, 3.0)],
        ["ticker", "field", "pos", "level", "Period 1 Value", "Period 2 Value"])
    header = spark.createDataFrame([("FY 2023", "FY-2024")], ["Period 1 Header", "Period 2 Header"])
    out = recipes.earnings(data, header).orderBy("pos")
    assert out.columns == ["ticker", "field", "pos", "level", "fy2023", "fy2023_pct", "fy2024", "fy2024_pct"]
    assert [round(r.fy2023_pct, 2) for r in out.collect()] == [33.33, 66.67, 50.0, 50.0]
    assert [round(r.fy2024_pct, 2) for r in out.collect()] == [25.0, 75.0, 25.0, 75.0]


def test_header_rename_skips_clashes(spark):
    data = spark.createDataFrame([("A", 1, 2)], ["ticker", "a Value", "fy2023"])
    header = spark.createDataFrame([("FY 2023",)], ["a Header"])
    assert shape.earning_header_rename(data, header).columns == ["ticker", "a Value", "fy2023"]


def test_panel_columns():
    cols = ["date", "AAPL US Equity|PX_LAST", "VOD LN Equity|PX_LAST", "MSFT US Equity", "value"]
    assert shape.panel_columns(cols) == cols[1:4]


def fx_inputs(spark):
    ref = spark.createDataFrame(
        [("A US Equity", "CRNCY", "USD"), ("V LN Equity", "crncy", " GBp "), ("G LN Equity", "CRNCY", "GBP"), ("X FP Equity", "CRNCY", "EUR")],
        "ticker string, field string, value string")
    fx = spark.createDataFrame(
        [("USDGBP Curncy", D(2024, 1, 2), "PX_LAST", 1.25), ("USDGBP Curncy", D(2024, 1, 3), "PX_LAST", 0.0)],
        "ticker string, date date, field string, value double")
    return ref, fx


def test_fx_long(spark):
    ref, fx = fx_inputs(spark)
    hist = spark.createDataFrame(
        [(t, D(2024, 1, d), "PX_LAST", v) for t, v in (("A US Equity", 10.0), ("V LN Equity", 72.5), ("G LN Equity", 5.0), ("X FP Equity", 7.0)) for d in (2, 3)],
        "ticker string, date date, field string, value double")
    got = {(r.ticker[0], r.date.day): r.value for r in joins.fx_join_long(hist, ref, fx, "USD").collect()}
    assert got[("V", 2)] == pytest.approx(0.58) and got[("G", 2)] == 4.0
    assert got[("V", 3)] == 72.5 and got[("X", 2)] == 7.0 and got[("A", 2)] == 10.0
    null = {(r.ticker[0], r.date.day): r.value for r in joins.fx_join_long(hist, ref, fx, "USD", "null").collect()}
    assert null[("V", 3)] is None and null[("X", 2)] is None and null[("A", 3)] == 10.0
    assert joins.fx_join_long(hist, ref, fx, "local") is hist
    # pence stay pence when the target differs only in case
    gbp = {(r.ticker[0], r.date.day): r.value for r in joins.fx_join_long(hist, ref, fx, "GBP").collect()}
    assert gbp[("V", 2)] == 72.5
    with pytest.raises(ValueError):
        joins.fx_join_long(hist, ref, fx, "USD", "drop")


def test_fx_wide(spark):
    ref, fx = fx_inputs(spark)
    panel = spark.createDataFrame(
        [(D(2024, 1, 2), 72.5, 7.0, 1), (D(2024, 1, 3), 73.0, 8.0, 2)], ["date", "V LN Equity|PX_LAST", "X FP Equity|PX_LAST", "value"])
    out = joins.fx_join_wide(panel, ref, fx, "USD").orderBy("date").collect()
    assert out[0][1] == pytest.approx(0.58) and out[1][1] is None
    assert [r[2] for r in out] == [7.0, 8.0] and [r[3] for r in out] == [1, 2]


def test_fx_requirements(spark):
    ref, _ = fx_inputs(spark)
    assert rows(joins.fx_requirements(ref, "USD")) == [("USDEUR Curncy",), ("USDGBP Curncy",)]


def test_date_span(spark):
    df = spark.createDataFrame([(D(2024, 1, 10),), (None,), (D(2024, 1, 2),)], "date date")
    assert rows(aggregate.date_span(df, "2020-01-01", "2021-01-01")) == [(D(2024, 1, 2), D(2024, 1, 10))]
    assert rows(aggregate.date_span(df.limit(0), "2020-01-01", "2021-01-01")) == [(D(2020, 1, 1), D(2021, 1, 1))]


def test_valid_contracts(spark):
    df = spark.createDataFrame([("ESM24", "2024-06-21"), ("ESH24", "2024-03-15"), ("ESZ23", "2023-12-15"), ("BAD", "not-a-date"), ("EQ", "2024-01-15")], ["ticker", "maturity"])
    out = aggregate.sort_by_maturity(predicates.valid_contracts(df, F.lit("2024-01-15").cast("date")), "expiry", "ticker")
    assert [r.ticker for r in out.collect()] == ["ESH24", "ESM24"]


def test_cycle_filter(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 8)], "month int")
    months = lambda c: [r.month for r in predicates.cycle_filter(df, c).orderBy("month").collect()]
    assert months("HMUZ") == [3, 6] and months("fhknqux") == [1, 3, 5, 7]


def test_latest_point(spark):
    hist = spark.createDataFrame(
        [("ESH24", D(2024, 1, 2), "VOLUME", "100", 0), ("ESH24", D(2024, 1, 3), "volume", "250", 1), ("ESH24", D(2024, 1, 4), "VOLUME", " ", 2),
         ("ESM24", D(2024, 1, 3), "VOLUME", "170", 3), ("ESM24", D(2024, 1, 3), "VOLUME", "175", 4)], "ticker string, date date, field string, value string, pos int")
    out = aggregate.latest_point(hist, "VOLUME", F.lit("2024-01-10").cast("date"), 10, "pos")
    assert rows(out) == [("ESH24", D(2024, 1, 3), 250.0), ("ESM24", D(2024, 1, 3), 175.0)]


def chain_inputs(spark):
    chain = spark.createDataFrame(
        [("ES1 Index", "ESH24 Index", D(2024, 3, 15)), ("ES1 Index", "ESM24 Index", D(2024, 6, 21)), ("ES1 Index", "ESZ23 Index", D(2023, 12, 15))],
        "gen_ticker string, contract string, last_trade_date date")
    points = spark.createDataFrame([("ES1 Index", D(2024, 1, 15)), ("ES2 Index", D(2024, 1, 15)), ("ES1 Index", D(2024, 3, 10)), ("ES2 Index", D(2024, 4, 1)), ("ESH24 Index", D(2024, 1, 1))], "gen_ticker string, dt date")
    return chain, points


def test_fut_ticker(spark):
    chain, points = chain_inputs(spark)
    got = {(r.gen_ticker, r.dt): r.contract for r in futures.fut_ticker(points, chain).collect()}
    assert got == {("ES1 Index", D(2024, 1, 15)): "ESH24 Index", ("ES2 Index", D(2024, 1, 15)): "ESM24 Index", ("ES1 Index", D(2024, 3, 10)): "ESH24 Index", ("ES2 Index", D(2024, 4, 1)): None}


@pytest.mark.parametrize("front, second, want", [("100", "90", "ESH24 Index"), ("90", "100", "ESM24 Index"), ("90", "90", "ESH24 Index"), (None, "1", "ESM24 Index"), ("x", None, "ESH24 Index")])
def test_active_futures(spark, front, second, want):
    chain, points = chain_inputs(spark)
    hist = spark.createDataFrame([("ESH24 Index", D(2024, 3, 8), "VOLUME", front), ("ESM24 Index", D(2024, 3, 9), "VOLUME", second)], "ticker string, date date, field string, value string")
    got = {(r.gen_ticker, r.dt): r.contract for r in futures.active_futures(points, chain, hist).collect()}
    assert got[("ES1 Index", D(2024, 3, 10))] == want
    assert got[("ES1 Index", D(2024, 1, 15))] == "ESH24 Index"  # before the expiry month
    assert got[("ES2 Index", D(2024, 4, 1))] == "ESM24 Index"  # only one contract left


def test_active_cdx(spark):
    g = "CDX IG CDSI GEN 5Y Corp"
    ref = spark.createDataFrame([(g, "ROLLING_SERIES", "45.0"), (g, "VERSION", "2"), (g, "CDS_FIRST_ACCRUAL_START_DATE", "2025-09-22")], "ticker string, field string, value string")
    points = spark.createDataFrame([(g, D(2025, 9, 1)), (g, D(2025, 10, 1))], "gen_ticker string, dt date")
    s = lambda n: f"CDX IG CDSI S{n} 5Y Corp"
    assert {r.dt.month: r.contract for r in futures.cdx_ticker(points, ref, True).collect()} == {9: s(44), 10: "CDX IG CDSI S45 V2 5Y Corp"}
    hist = spark.createDataFrame([(s(45), D(2025, 9, 25), "PX_LAST", 1.0), (s(44), D(2025, 9, 28), "PX_LAST", 1.0)], "ticker string, date date, field string, value double")
    assert {r.dt.month: r.contract for r in futures.active_cdx(points, ref, hist).collect()} == {9: s(44), 10: s(44)}
    assert {r.dt.month: r.contract for r in futures.active_cdx(points, ref, hist.limit(0)).collect()}[10] == s(45)


def test_explode_columns(spark):
    df = spark.createDataFrame([([[1, 2], [3]], ["a"])], "x array<array<int>>, y array<string>")
    lists = spark.createDataFrame([([1, 2], ["a", "b"]), ([3], ["c"])], "col1 array<int>, col2 array<string>")
    assert shape.explode_columns(lists, ["col1", "col2"]).count() == 5
    assert shape.explode_columns(lists, ["nope"]).count() == 0
    assert shape.explode_columns(df, ["x"]).count() == 2


def test_flat_quotes(spark):
    flat = spark.createDataFrame(
        [("tickData[0].time", "string", "2024-01-01T10:00:00", None), ("tickData[0].type", "string", "BID", None), ("tickData[0].value", "number", "", 123.45),
         ("tickData[0].size", "number", "1000", 1000.0), ("tickData[0].brokerBuyCode", "string", "ABCD", None), ("other.path", "string", "x", None)],
        "path string, type string, value_str string, value_num double").withColumn("ticker", F.lit("T"))
    out = shape.reshape_flat_quotes(flat, ["ticker"], ["time", "type", "value", "size", "brokerBuyCode", "spreadPrice"])
    assert rows(out) == [("T", 0, "2024-01-01T10:00:00", "BID", "123.45", "1000", "ABCD", None)]


def leaves(v, path=""):
    if isinstance(v, dict):
        return [x for k, c in v.items() for x in leaves(c, f"{path}.{k}" if path else k)]
    if isinstance(v, list):
        return [x for i, c in enumerate(v) for x in leaves(c, f"{path}[{i}]")]
    kind = "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string"
    text = None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
    return [(path, kind, text, float(v) if kind == "number" else None)]


@pytest.mark.parametrize("joined", [6, 2, 0])
def test_flatten_documents_of_any_depth(spark, joined):
    r = random.Random(joined)

    def document(depth):
        if depth == 0 or r.random() < 0.1:
            return r.choice([None, True, False, 7, -3, 2.5, "", "x", 'q"u\\o{te}, [y]: 1', "é\n\t☃", {}, []])
        n = r.randrange(1, 3)
        return {r.choice(["a", "b c", 'k"\\', "é", "x.y"]) + str(i): document(depth - 1) for i in range(n)} if r.random() < 0.5 else [document(depth - 1) for _ in range(n)]

    docs = [document(r.randrange(16)) for _ in range(60)] + [{"a": 1}, 5, "text", [], {}, [[[[[[[[[[]]]]]]]]]], [[[[[[[list(range(1500))]]]]]]]]
    nested = 1
    for i in range(14):
        nested = {"a": nested} if i % 2 else [nested, {}]
    docs.append(nested)
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(-1, None)], "id int, j string").repartition(3)
    got = sorted(map(tuple, jsonq.flatten_tree(df, "j", ["id"], joined).collect()), key=str)
    assert got == sorted([(i, *x) for i, d in enumerate(docs) for x in leaves(d)], key=str)


def test_json_results_number_rule(spark):
    doc = '{"results":{"a":{"idColumn":{"values":["x",null,"z"]},"valuesColumn":{"values":["1","q",2]}},"b":{"valuesColumn":{"values":["t"]}}}}'
    out = jsonq.json_query_result(spark.createDataFrame([(doc,)], "j string"), "j", ["a", "b"])
    assert rows(out.drop("pos")) == [("", None, None), ("x", 1.0, "t"), ("z", 2.0, None)]


def test_json_results_are_named_and_typed_by_the_document(spark):
    docs = [(1, '{"results":{"a":{"idColumn":{"values":["x"]},"valuesColumn":{"values":["n/a"]}},"b":{"valuesColumn":{"values":[1,2]}}}}'),
            (2, '{"results":{"c":{"valuesColumn":{"values":["t"]}},"a":{"idColumn":{"values":["y","z"]},"valuesColumn":{"values":[2.5,"bad"]}}}}'), (3, '{"results":{}}'), (4, None)]
    df = spark.createDataFrame(docs, "id int, j string")
    assert jsonq.result_columns(df, "j") == {"a": "variant", "c": "string", "b": "double"}
    out = jsonq.json_query_result(df, "j", keys=["id"])
    assert out.columns == ["id", "pos", "ticker", "a", "c", "b"]
    got = rows(out.withColumn("a", F.to_json("a")))
    assert got == [(1, 0, "x", '"n/a"', None, 1.0), (1, 1, "", None, None, 2.0), (2, 0, "y", "2.5", "t", None), (2, 1, "z", None, None, None)]
    long = jsonq.json_query_values(df, "j", ["id"]).withColumn("value", F.to_json("value"))
    assert rows(long) == [(1, 0, "x", "a", '"n/a"'), (1, 0, "x", "b", "1.0"), (1, 1, "", "a", None), (1, 1, "", "b", "2.0"),
                          (2, 0, "y", "a", "2.5"), (2, 0, "y", "c", '"t"'), (2, 1, "z", "a", None), (2, 1, "z", "c", None)]


def test_clock_ends_at_its_instant(spark):
    at = lambda *t: datetime.datetime(2024, 1, 2, *t)
    df = spark.createDataFrame([(t,) for t in (at(9, 29, 59), at(9, 30), at(15, 59, 59, 999_999), at(16, 0), at(16, 0, 0, 1), at(16, 0, 59), at(23, 0))], "time timestamp")
    kept = lambda *w: df.where(aggregate.clock_between(F.col("time"), *w)).count()
    assert (kept("09:30", "16:00"), kept(None, "16:00"), kept("16:00", None), kept("22:00", "09:30"), kept("16:00:00", "16:00:59"), kept(None, None)) == (3, 4, 4, 3, 3, 7)


def test_all_unknown_fields_are_named_and_doubled_types_decided(spark):
    fields = spark.createDataFrame([(f"F{i}",) for i in range(40)], "field string")
    catalog = spark.createDataFrame([("f0", "Double", 1), ("F0", "String", 0), ("F1", "Date", 2)], "field string, type string, pos int")
    with pytest.raises(ValueError) as e:
        joins.validate_fields(fields, catalog)
    assert all(f"F{i}" in str(e.value) for i in range(2, 40))
    kinds = {r.field: r.type for r in shape.resolve_field_types(fields.limit(2), {}, catalog.repartition(3)).collect()}
    assert kinds == {"F0": "float64", "F1": "date32"}


def test_json_errors_are_fatal_without_results(spark):
    df = spark.createDataFrame([('{"results":{},"responseExceptions":[{"message":"m","node":"n"}]}',), ('{"results":{"a":1},"responseExceptions":[]}',)], "j string")
    assert rows(jsonq.json_query_errors(df, "j")) == [("m (in n)", True)]


def test_search_grid_without_rows(spark):
    df = spark.createDataFrame([('{"results":[]}',)], "j string")
    assert jsonq.search_grid(df, "j").columns == ["pos", "ticker"]


def test_ref_scan(spark):
    ref = spark.createDataFrame([("A", "X", "1"), ("B", "Y", "2")], "ticker string, field string, value string")
    asked = spark.createDataFrame([("A",), ("B",), ("Z",)], "ticker string")
    assert rows(scan.ref_scan(ref, asked, ["X"])) == [("A", "X", "1"), ("B", "X", None)]
    assert ("Z", "__SECURITY_ERROR__", "Unknown security") in rows(scan.ref_scan(ref, asked, ["X"], include_errors=True))
    with pytest.raises(ValueError, match="failed"):
        scan.require_known(ref, asked.where("ticker = 'Z'"))
    with pytest.raises(ValueError):
        scan.ref_scan(ref, asked, [])


def test_bars_scan_needs_a_range(spark):
    with pytest.raises(ValueError):
        scan.bars_scan(spark.createDataFrame([], "ticker string, time timestamp"), None)


def test_hist_scan_default_range(spark):
    hist = spark.createDataFrame([("A", D(2024, 1, 1), "PX_LAST", 1.0), ("A", D(2024, 3, 1), "PX_LAST", 2.0)], "ticker string, date date, field string, value double")
    assert rows(scan.hist_scan(hist, ["A"], end="2024-03-10")) == [("A", D(2024, 3, 1), "PX_LAST", 2.0)]


def test_turnover_falls_back_to_price_times_volume(spark):
    ref, fx = fx_inputs(spark)
    h = [("V LN Equity", "TURNOVER", 125.0), ("A US Equity", "VOLUME", 10.0), ("A US Equity", "EQY_WEIGHTED_AVG_PX", 3.0), ("V LN Equity", "VOLUME", 9.0)]
    hist = spark.createDataFrame([(t, D(2024, 1, 2), f, v) for t, f, v in h], "ticker string, date date, field string, value double")
    out = recipes.turnover(hist, ref, fx, factor=1.0)
    assert rows(out) == [("A US Equity", D(2024, 1, 2), "TURNOVER", 30.0), ("V LN Equity", D(2024, 1, 2), "TURNOVER", 1.0)]


def test_renames_refuse_doubles(spark):
    df = spark.createDataFrame([(1, 2)], ["Weight", "% Weight"])
    with pytest.raises(ValueError, match="weight"):
        shape.rename_etf_columns(df)


def test_validate_fields(spark):
    catalog = spark.createDataFrame([("PX_LAST",)], "field string")
    asked = spark.createDataFrame([("px_last",), ("FOO",)], "field string")
    assert rows(joins.validate_fields(asked, catalog, "lenient")) == [("FOO",)]
    assert joins.validate_fields(asked, catalog, "disabled").count() == 0
    with pytest.raises(ValueError, match="FOO"):
        joins.validate_fields(asked, catalog)


def test_generic_messages(spark):
    df = spark.createDataFrame([("ESH24 Index",), ("ES1 Index",)], "ticker string")
    got = {r.ticker: r.error for r in predicates.validate_generic(df).collect()}
    assert "ESH24 Index" in got["ESH24 Index"] and "generic" in got["ESH24 Index"] and got["ES1 Index"] is None


def test_screens(spark):
    s = predicates.Screens()
    s.save("big", "v > 1")
    df = spark.createDataFrame([(1,), (2,)], "v int")
    assert rows(predicates.screen(df, s, "big")) == [(2,)]
    with pytest.raises(ValueError, match="saved"):
        predicates.screen(df, s, "other")
    with pytest.raises(ValueError):
        s.save("none", " ")


def test_bundles_know_their_fields(spark):
    ref = spark.createDataFrame([("A", "CPN", "1.5"), ("A", "MATURITY", "2030-01-01"), ("A", "NAME", "n")], "ticker string, field string, value string")
    row = bundles.field_bundle(ref, "bond_info").first()
    assert (row.CPN, row.MATURITY, row.NAME, row.RTG_SP) == (1.5, D(2030, 1, 1), "n", None)
    with pytest.raises(ValueError):
        bundles.field_bundle(ref, "nope")


def test_event_history_is_bounded(spark):
    ev = spark.range(500).select(F.timestamp_seconds("id").alias("event_time"), F.col("id").alias("seq"), F.lit("A").alias("topic"))
    assert status.event_history(ev).count() == 128


def test_data_loss_split(spark):
    df = spark.createDataFrame([("SUMMARY", "DATALOSS"), ("SUMMARY", None), (None, None)], "MKTDATA_EVENT_TYPE string, MKTDATA_EVENT_SUBTYPE string")
    kept, lost = status.data_loss_split(df)
    assert (kept.count(), lost.count()) == (2, 1)


def test_bars_order(spark):
    t = lambda s: datetime.datetime(2024, 1, 1, 10, 0, s)
    ticks = spark.createDataFrame([("A", t(1), "TRADE", 5.0, 1, 1), ("A", t(1), "TRADE", 7.0, 1, 2), ("A", t(59), "TRADE", 6.0, 2, 3), ("A", t(30), "BID", 99.0, 2, 4)],
                                  "ticker string, time timestamp, type string, value double, size bigint, event_id bigint")
    bar = aggregate.bars_from_ticks(ticks, 1).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.numEvents) == (5.0, 7.0, 5.0, 6.0, 4.0, 3)
    unique = aggregate.bars_from_ticks(ticks.where("event_id <> 2"), 1, seq=None)
    assert (unique.first().open, unique.first().close) == (5.0, 6.0)
    with pytest.raises(ValueError):
        aggregate.bars_from_ticks(ticks, 0)


def test_preview_json(spark):
    df = spark.createDataFrame([(1, "abcdef", 2**60, float("nan")), (2, "ab", 5, 1.5)], "k int, s string, n bigint, d double")
    out = [r.json for r in shape.preview_json(df, 2, 3, [F.col("k")]).collect()]
    assert '"s":"abc…"' in out[0] and '"n__text":"1152921504606846976"' in out[0] and '"d__text":"NaN"' in out[0]
    assert '"n":5' in out[1] and '"d":1.5' in out[1]


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "hist")
    spark.createDataFrame([("A", D(2024, 1, 1), "PX_LAST", 1.0, "x")], "ticker string, date date, field string, value double, note string").write.parquet(path)
    hist = spark.read.parquet(path)
    plan = scan.hist_scan(hist, ["A", "B"], ["PX_LAST"], "2024-01-01", "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-01)" in plan and "In(ticker, [A,B])" in plan and "note" not in plan
    ticks = spark.createDataFrame([], "ticker string, time timestamp, type string, value double, size bigint, event_id bigint, junk string")
    ticks.write.parquet(str(tmp_path / "ticks"))
    scanned = scan.ticks_scan(spark.read.parquet(str(tmp_path / "ticks")), "A", "2024-01-01", "2024-01-02")
    plan = aggregate.bars_from_ticks(scanned, 5)._jdf.queryExecution().optimizedPlan().toString()
    # every condition sits directly on the relation, where the reader takes it over
    below = plan[plan.rindex("Filter"):]
    assert all(x in below for x in ("TRADE", "ticker", "2024-01-01")) and "Relation" in below
    plan = aggregate.bars_from_ticks(scanned, 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan and "junk" not in plan


def test_large_lookups_are_not_broadcast_by_hint():
    import pathlib

    import marketframe

    files = [p for p in pathlib.Path(marketframe.__file__).parent.rglob("*.py")]
    code = "".join(p.read_text() for p in files)
    assert "crossJoin" not in code and "localCheckpoint" not in code
    # the optional subpackage broadcasts a model and counted seeds; its own tests cover that
    assert "broadcast(" not in "".join(p.read_text() for p in files if "llm" not in p.parts)
