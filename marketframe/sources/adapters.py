"""Adapters: general tables read as the canonical market-data tables.

Each adapter makes one pass over one table with the columns it needs. They
exist so that every operator can be run and checked on shared data; operators
never depend on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.operators.series import with_running


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _ticker(prefix: str, key: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(" US Equity"))


def ticks(spark: SparkSession, path: str) -> DataFrame:
    """Event stream as trades and quotes."""
    kind = F.col("event_type")
    return table(spark, path, "events").select(
        _ticker("U", "user_id").alias("ticker"),
        F.col("ts").cast("timestamp").alias("time"),
        F.when(kind == "purchase", F.lit("TRADE")).when(kind == "click", F.lit("BID"))
        .when(kind == "view", F.lit("ASK")).otherwise(F.upper(kind)).alias("type"),
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("size"),
        "event_id",
    )


def hist_wide(spark: SparkSession, path: str) -> DataFrame:
    """Daily price, volume and turnover; every fifth ticker has no turnover of its own."""
    grouped = table(spark, path, "lineitem").groupBy(
        "l_partkey", F.col("l_shipdate").cast("date").alias("date")
    ).agg(F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("volume"))
    return grouped.select(
        _ticker("P", "l_partkey").alias("ticker"),
        "date",
        (F.col("amount") / F.col("volume")).alias("px_last"),
        "volume",
        F.when(F.col("l_partkey") % 5 != 0, F.col("amount")).alias("turnover"),
    )


def hist_long(spark: SparkSession, path: str) -> DataFrame:
    """Daily history as (ticker, date, field, value) rows."""
    pair = lambda name, col: F.struct(F.lit(name).alias("field"), F.col(col).alias("value"))
    rows = F.filter(
        F.array(pair("PX_LAST", "px_last"), pair("EQY_WEIGHTED_AVG_PX", "px_last"),
                pair("VOLUME", "volume"), pair("TURNOVER", "turnover")),
        lambda r: (r["field"] != "TURNOVER") | r["value"].isNotNull(),
    )
    return hist_wide(spark, path).select("ticker", "date", F.inline(rows))


def ohlc(spark: SparkSession, path: str) -> DataFrame:
    """Daily bars: high and low derive from the price and the volume."""
    h = hist_wide(spark, path)
    return h.select(
        "ticker", "date",
        (F.col("px_last") * (1 + (F.col("volume") % 3 - 1) / 100)).alias("open"),
        (F.col("px_last") * (1 + (F.col("volume") % 7 + 1) / 100)).alias("high"),
        (F.col("px_last") * (1 - (F.col("volume") % 5 + 1) / 100)).alias("low"),
        F.col("px_last").alias("close"), "volume",
    )


def ref_long(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot rows; the sector is missing for every seventh ticker."""
    p = table(spark, path, "part")
    ccy = F.element_at(
        F.array(*[F.lit(c) for c in ("USD", "GBP", "GBp", "EUR", "JPY")]), (F.col("p_partkey") % 5 + 1).cast("int")
    )
    pair = lambda name, col: F.struct(F.lit(name).alias("field"), col.alias("value"))
    rows = F.filter(
        F.array(
            pair("NAME", F.col("p_name")), pair("CRNCY", ccy),
            pair("SECTOR", F.when(F.col("p_partkey") % 7 != 0, F.col("p_type"))),
            pair("OPEN_INT", F.col("p_size").cast("string")),
        ),
        lambda r: (r["field"] != "SECTOR") | r["value"].isNotNull(),
    )
    return p.select(_ticker("P", "p_partkey").alias("ticker"), F.inline(rows))


def fx_long(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates of three pairs on order dates; zero on the 13th."""
    pairs = F.array(*[
        F.struct(F.lit(pair).alias("ticker"), F.lit(base).alias("base"))
        for pair, base in (("USDGBP Curncy", 0.5), ("USDEUR Curncy", 0.75), ("USDJPY Curncy", 128.0))
    ])
    days = table(spark, path, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    rate = F.when(F.day("date") == 13, F.lit(0.0)).otherwise(F.col("base") + F.day("date") * 0.25)
    return days.select("date", F.inline(pairs)).select(
        "ticker", "date", F.lit("PX_LAST").alias("field"), rate.alias("value")
    )


def chain(spark: SparkSession, path: str) -> DataFrame:
    """Generic futures roots with their monthly contracts and last trade dates."""
    o = table(spark, path, "orders")
    month, year = F.month("o_orderdate"), F.year("o_orderdate")
    grouped = o.groupBy(
        (F.col("o_custkey") % 20).alias("root"), month.alias("m"), year.alias("y")
    ).agg(F.max(F.col("o_orderdate").cast("date")).alias("last_trade_date"))
    stem = F.concat(F.lit("B"), F.col("root").cast("string"), F.lit("A"))
    return grouped.select(
        F.concat(stem, F.lit("1 Index")).alias("gen_ticker"),
        F.concat(
            stem, F.substring(F.lit(refdata.MONTH_CODES), F.col("m"), F.lit(1)),
            F.substring(F.col("y").cast("string"), 3, 2), F.lit(" Index"),
        ).alias("contract"),
        "last_trade_date",
    )


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Positional two-level hierarchy: level 1 rows followed by their level 2 rows."""
    li = table(spark, path, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("k"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice",
    )
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    # buckets of 4096 order keys: running positions without one task per ticker
    placed = with_running(
        li, ["k"], order, F.expr("l_orderkey div 4096"), {"pos": F.lit(1).cast("bigint")}
    )
    return placed.select(
        _segment_ticker().alias("ticker"), "pos",
        F.when(F.col("l_linenumber") == 1, 1).otherwise(2).alias("level"),
        F.col("l_extendedprice").alias("fy2024"),
    )


def _segment_ticker():
    return F.concat(F.lit("O"), F.col("k").cast("string"), F.lit(" US Equity"))


def maturities(spark: SparkSession, path: str) -> DataFrame:
    """Last trading day of each contract as text, unreadable for contracts of every eleventh day."""
    c = chain(spark, path)
    day = F.date_format("last_trade_date", "yyyy-MM-dd")
    return c.select(
        F.col("contract").alias("ticker"),
        F.when(F.day("last_trade_date") % 11 == 0, F.lit("not-a-date")).otherwise(day).alias("maturity"),
    )


def futures_points(spark: SparkSession, path: str) -> DataFrame:
    """(generic, date) pairs to resolve: every root on its order dates; the index digit follows the day."""
    o = table(spark, path, "orders").select(
        (F.col("o_custkey") % 20).alias("root"), F.col("o_orderdate").cast("date").alias("dt")
    ).distinct()
    return o.select(
        F.concat(F.lit("B"), F.col("root").cast("string"), F.lit("A"),
                 (F.day("dt") % 3 + 1).cast("string"), F.lit(" Index")).alias("gen_ticker"),
        "dt",
    )


def contract_volume(spark: SparkSession, path: str) -> DataFrame:
    """Daily volume per contract: each order trades a contract up to two months out."""
    o = table(spark, path, "orders")
    month = F.add_months(F.trunc(F.col("o_orderdate").cast("date"), "month"), (F.col("o_orderkey") % 3).cast("int"))
    rows = o.select(
        F.concat(
            F.lit("B"), (F.col("o_custkey") % 20).cast("string"), F.lit("A"),
            F.substring(F.lit(refdata.MONTH_CODES), F.month(month), F.lit(1)),
            F.substring(F.year(month).cast("string"), 3, 2), F.lit(" Index"),
        ).alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_custkey").alias("lots"),
    )
    return rows.groupBy("ticker", "date").agg(F.sum("lots").cast("string").alias("value")).select(
        "ticker", "date", F.lit("VOLUME").alias("field"), "value"
    )


def _cdx_generic(key: str):
    return F.concat(F.lit("CDX C"), F.col(key).cast("string"), F.lit(" CDSI GEN 5Y Corp"))


def cdx_ref(spark: SparkSession, path: str) -> DataFrame:
    """Series, version and accrual start of a generic credit index per customer."""
    c = table(spark, path, "customer")
    n = F.col("c_nationkey")
    pair = lambda name, col: F.struct(F.lit(name).alias("field"), col.alias("value"))
    number = (F.col("c_custkey") % 25).cast("string")
    series = (
        F.when(F.col("c_custkey") % 9 == 0, F.lit("n/a"))
        .when(F.col("c_custkey") % 2 == 0, F.concat(number, F.lit(".0"))).otherwise(number)
    )
    start = F.date_format(F.date_add(F.lit("1995-06-01").cast("date"), (n * 60).cast("int")), "yyyy-MM-dd")
    rows = F.array(
        pair("ROLLING_SERIES", series), pair("VERSION", (F.col("c_custkey") % 4).cast("string")),
        pair("CDS_FIRST_ACCRUAL_START_DATE", start),
    )
    return c.select(_cdx_generic("c_custkey").alias("ticker"), F.inline(rows))


def cdx_points(spark: SparkSession, path: str) -> DataFrame:
    """(generic credit index, date) pairs to resolve."""
    return table(spark, path, "orders").select(
        _cdx_generic("o_custkey").alias("gen_ticker"), F.col("o_orderdate").cast("date").alias("dt")
    ).distinct()


def cdx_hist(spark: SparkSession, path: str) -> DataFrame:
    """Price days of specific series: each order quotes one of four series of its customer's index."""
    o = table(spark, path, "orders")
    return o.select(
        F.concat(F.lit("CDX C"), F.col("o_custkey").cast("string"), F.lit(" CDSI S"),
                 (F.col("o_custkey") % 25 - F.col("o_orderkey") % 2).cast("string"), F.lit(" 5Y Corp")).alias("ticker"),
        F.date_add(F.col("o_orderdate").cast("date"), -(F.col("o_orderkey") % 7).cast("int")).alias("date"),
        F.lit("PX_LAST").alias("field"), F.col("o_totalprice").alias("value"),
    )


def dividends(spark: SparkSession, path: str) -> DataFrame:
    """Nested dividend records: one to three per order, under three fields; every seventh is no equity."""
    o = table(spark, path, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    ticker = F.concat(
        F.lit("O"), key.cast("string"), F.when(key % 7 == 0, F.lit(" Index")).otherwise(F.lit(" US Equity")),
        F.when(key % 13 == 0, F.lit(" =C")).otherwise(F.lit("")),
    )
    field = F.when(key % 3 == 0, F.lit("DVD_Hist_All")).when(key % 3 == 1, F.lit("DVD_Hist")).otherwise(
        F.lit("Eqy_DVD_Hist_Splits"))
    record = lambda i: F.struct(
        F.date_add(day, (i * 90).cast("int")).alias("Declared Date"),
        F.date_add(day, (i * 90 + 10).cast("int")).alias("Ex-Date"),
        F.date_add(day, (i * 90 + 30).cast("int")).alias("Payable Date"),
        ((F.col("o_custkey") + i) / 4).alias("Dividend Amount"),
        F.col("o_orderpriority").alias("Dividend Type"),
    )
    rows = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("o_custkey") % 3), record)
    return o.select(ticker.alias("ticker"), field.alias("field"), rows.alias("rows"))


def cashflows(spark: SparkSession, path: str) -> DataFrame:
    """Nested cash-flow and default records under four fields."""
    o = table(spark, path, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    field = F.element_at(
        F.array(*[F.lit(f) for f in (
            "DES_CASH_FLOW", "CASHFLOW_SCHEDULE", "CDS_INDEX_DEFAULT_INFORMATION", "CDS_DEFAULT_PROB")]),
        (key % 4 + 1).cast("int"),
    )
    record = lambda i: F.struct(
        F.add_months(day, (i * 6).cast("int")).alias("payment_date"),
        ((F.col("o_custkey") % 50) / 8).alias("coupon"),
        F.when(i == F.col("o_custkey") % 5, F.lit(100.0)).otherwise(F.lit(0.0)).alias("principal"),
    )
    rows = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("o_custkey") % 5), record)
    return o.select(F.concat(F.lit("B"), key.cast("string"), F.lit(" Corp")).alias("ticker"), field.alias("field"), rows.alias("rows"))


def options(spark: SparkSession, path: str) -> DataFrame:
    """Option quotes: one per order line."""
    li = table(spark, path, "lineitem")
    return li.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit(" US Equity")).alias("underlying"),
        F.when(F.col("l_linestatus") == "O", F.lit("Call")).otherwise(F.lit("Put")).alias("put_call"),
        F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_linenumber") * 7).cast("int")).alias("expire_dt"),
        (F.col("l_quantity") * 10).alias("strike_px"), F.lit(255.0).alias("undl_px"),
        F.col("l_discount").alias("ivol"), (F.col("l_tax") * 10).alias("delta"), F.col("l_tax").alias("gamma"),
        (F.col("l_quantity") / 100).alias("vega"), (-F.col("l_discount")).alias("theta"),
        (F.col("l_quantity") * 10 / 255.0).alias("moneyness"),
        F.col("l_partkey").alias("open_int"), F.col("l_suppkey").alias("px_volume"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("px_last"),
        (F.col("l_extendedprice") / F.col("l_quantity") * 0.5).alias("px_bid"),
        (F.col("l_extendedprice") / F.col("l_quantity") * 2).alias("px_ask"),
        F.when(F.col("l_returnflag") == "A", F.lit("US")).otherwise(F.lit("LN")).alias("exch_code"),
        F.when(F.col("l_returnflag") == "N", F.lit("European")).otherwise(F.lit("American")).alias("exercise_type"),
    )


def bonds(spark: SparkSession, path: str) -> DataFrame:
    """Preferred and corporate issues: one per customer."""
    c = table(spark, path, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("B"), key.cast("string")).alias("id"), F.col("c_name").alias("name"),
        F.concat(F.col("c_mktsegment"), F.lit(" US Equity")).alias("issuer"),
        F.when(key % 2 == 0, F.lit("Preferreds")).otherwise(F.lit("Corporates")).alias("asset_class"),
        F.floor(key / 4).cast("bigint").alias("consolidated_id"),
        F.when(key % 3 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("crncy"),
        F.date_add(F.lit("2000-01-01").cast("date"), (key % 2000).cast("int")).alias("maturity"),
        F.col("c_acctbal").alias("amount"),
    )


def field_info(spark: SparkSession, path: str) -> DataFrame:
    """Field catalog: one entry per part, with blanks in mnemonic, datatype and id."""
    p = table(spark, path, "part")
    key = F.col("p_partkey")
    kinds = F.array(*[F.lit(k) for k in ("Double", "Int32", "Date", "String", "Boolean", "Time", "Price", "Odd")])
    return p.select(
        F.when(key % 19 == 0, F.lit(" ")).otherwise(F.concat(F.lit("F"), key.cast("string"))).alias("id"),
        F.when(key % 5 == 0, F.lit("")).otherwise(
            F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("_"), key.cast("string"))).alias("mnemonic"),
        F.when(key % 4 == 0, F.lit(" ")).otherwise(F.element_at(kinds, (key % 8 + 1).cast("int"))).alias("datatype"),
        F.when(key % 8 == 0, F.lit(None)).otherwise(F.lit("Real")).alias("ftype"),
        F.col("p_name").alias("description"), F.col("p_brand").alias("category"),
    )


# Facts of the sample exchanges, picked by number.
EXCHANGE_FACTS = [
    ("XNYS", "US", "US", "09:30", "16:00"),
    ("XTKS", "JT", "JP", "09:00", "15:00"),
    ("", "LN", "GB", "0800", "1630"),
    ("XHKG", "HK", "HK", "9:30", "16:00"),
    ("XCME", "CME", "US", "18:00", "17:00"),
    ("NONE", "ZZ", "AU", "10:00", "16:00"),
    ("", "", "XX", "25:00", "16:00"),
    ("XSHG", "CH", "CN", "09:30:00", "15:00:00"),
]


def exchanges(spark: SparkSession, path: str) -> DataFrame:
    """One exchange per supplier; every fifth names its own zone."""
    s = table(spark, path, "supplier")
    facts = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("mic", "exch_code", "country", "day_start", "day_end"), row)])
        for row in EXCHANGE_FACTS
    ])
    key = F.col("s_suppkey")
    fact = F.element_at(facts, (key % 8 + 1).cast("int"))
    return s.select(
        F.concat(F.lit("X"), key.cast("string")).alias("exchange"), fact["mic"].alias("mic"),
        fact["exch_code"].alias("exch_code"), fact["country"].alias("country"),
        F.when(key % 5 == 0, F.lit("Europe/Paris")).otherwise(F.lit(" ")).alias("iana_tz"),
        fact["day_start"].alias("day_start"), fact["day_end"].alias("day_end"),
    )


def exchange_days(spark: SparkSession, path: str) -> DataFrame:
    """(exchange, date) pairs with shipments."""
    return table(spark, path, "lineitem").select(
        F.concat(F.lit("X"), F.col("l_suppkey").cast("string")).alias("exchange"),
        F.col("l_shipdate").cast("date").alias("date"),
    ).distinct()


def payload_messages(spark: SparkSession, path: str) -> DataFrame:
    """Events as messages with a JSON payload; some are loss markers."""
    e = table(spark, path, "events")
    return messages_from(e)


def messages_from(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    loss = F.col("event_type") == "error"
    text = F.concat(
        F.lit('{"LAST_TRADE":'), key.cast("string"), F.lit(',"SIZE":'), F.regexp_extract("props", "[0-9]+", 0),
        F.when(key % 4 == 0, F.lit(',"BID":"b')).otherwise(F.lit(',"ASK":"a')), (key % 10).cast("string"), F.lit('"'),
        F.lit(',"NESTED":{"x":1},"LIST":[1,2]'),
        F.when(loss, F.lit(',"MKTDATA_EVENT_TYPE":"SUMMARY","MKTDATA_EVENT_SUBTYPE":"DATALOSS"}')).otherwise(
            F.concat(F.lit(',"MKTDATA_EVENT_TYPE":"'), F.upper("event_type"), F.lit('","MKTDATA_EVENT_SUBTYPE":"NEW"}'))),
    )
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("topic"),
        text.alias("payload"), key.alias("event_id"),
    )


def subscription_events(spark: SparkSession, path: str) -> DataFrame:
    """Events as a subscription log: data, topic, session, admin and service records."""
    return subscription_events_from(table(spark, path, "events"))


def subscription_events_from(e: DataFrame) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_type")
    pick = lambda names: F.element_at(F.array(*[F.lit(n) for n in names]), (key % len(names) + 1).cast("int"))
    message = (
        F.when(kind == "purchase", F.lit("MarketData"))
        .when(kind == "click", pick(["SubscriptionStarted", "SubscriptionFailure", "SubscriptionTerminated",
                                     "SubscriptionUnsubscribed", "SubscriptionUnsubscribing"]))
        .when(kind == "view", pick(["SlowConsumerWarning", "SlowConsumerWarningCleared", "DataLoss"]))
        .when(kind == "error", pick(["SessionConnectionDown", "RecoveryAttempt", "RecoverySuccess", "SessionConnectionUp"]))
        .otherwise(pick(["ServiceUp", "ServiceDown"]))
    )
    category = F.element_at(
        F.create_map(*[F.lit(x) for pair in (
            ("purchase", "data"), ("click", "subscription"), ("view", "admin"), ("error", "session"),
            ("signup", "service")) for x in pair]), kind,
    )
    detail = F.when(kind == "signup", F.concat(F.lit("svc"), (F.col("user_id") % 5).cast("string"))).otherwise(
        F.concat(F.lit("reason "), (key % 17).cast("string")))
    return e.select(
        F.col("ts").cast("timestamp").alias("event_time"), key.alias("seq"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("topic"), category.alias("category"),
        F.when(kind == "error", F.lit("warning")).otherwise(F.lit("info")).alias("level"),
        message.alias("message_type"), detail.alias("detail"),
    )


def bundle_ref(spark: SparkSession, path: str, bundle: str) -> DataFrame:
    """Snapshot rows for a bundle's fields, each missing for some tickers."""
    key = F.col("p_partkey")
    rows = []
    for i, f in enumerate(refdata.BUNDLES[bundle]):
        if f in refdata.TEXT_FIELDS:
            value = F.concat(F.lit(f"T{i}-"), F.col("p_brand"))
        elif f in refdata.DATE_FIELDS:
            value = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (key % 3000 + i).cast("int")), "yyyy-MM-dd")
        else:
            value = ((key * (i + 1)) % 1000).cast("string")
        rows.append(F.struct(F.lit(f).alias("field"), F.when((key + i) % 7 != 0, value).alias("value")))
    kept = F.filter(F.array(*rows), lambda r: r["value"].isNotNull())
    return table(spark, path, "part").select(_ticker("P", "p_partkey").alias("ticker"), F.inline(kept))


def holdings(spark: SparkSession, path: str) -> DataFrame:
    """Fund and portfolio positions: one per order line."""
    li = table(spark, path, "lineitem")
    part = F.col("l_partkey").cast("string")
    return li.select(
        F.concat(F.lit("F"), F.col("l_suppkey").cast("string"), F.lit(" US Equity")).alias("fund"),
        F.concat(F.lit("PF"), F.col("l_suppkey").cast("string")).alias("portfolio"),
        F.concat(F.lit("P"), part, F.lit(" US Equity")).alias("ID"),
        F.concat(F.lit("XS"), F.lpad(part, 10, "0")).alias("id_isin"),
        F.col("l_discount").alias("weights"), F.col("l_quantity").alias("id().position"),
        F.col("l_returnflag").alias("Sector"), F.col("l_linestatus").alias("Asset Class"),
    )


def wide_panel(spark: SparkSession, path: str) -> DataFrame:
    """Daily panel with one column per ticker of five."""
    li = table(spark, path, "lineitem")
    k = F.col("l_partkey") % 5
    cols = [F.sum(F.when(k == i, F.col("l_quantity"))).alias(f"K{i} US Equity|VOLUME") for i in range(5)]
    return li.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(*cols, F.count(F.lit(1)).alias("value"))


def panel_ref(spark: SparkSession, path: str) -> DataFrame:
    """Currencies of the panel's five tickers; one has a currency without rates."""
    r = table(spark, path, "region")
    ccy = F.element_at(F.array(*[F.lit(c) for c in ("USD", "GBP", "GBp", "SEK", "JPY")]), (F.col("r_regionkey") + 1).cast("int"))
    return r.select(
        F.concat(F.lit("K"), F.col("r_regionkey").cast("string"), F.lit(" US Equity")).alias("ticker"),
        F.lit("CRNCY").alias("field"), ccy.alias("value"),
    )


def json_results(spark: SparkSession, path: str) -> DataFrame:
    """Query documents built row by row: two result sets of unequal length per order."""
    o = table(spark, path, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    doc = F.concat(
        F.lit('{"results":{"px":{"idColumn":{"values":["A'), key, F.lit('",null,"C'), key,
        F.lit('"]},"valuesColumn":{"values":['), cust, F.lit(',"'), key, F.lit('","x"]}},"nm":{"idColumn":{"values":[]},'),
        F.lit('"valuesColumn":{"values":["'), F.col("o_orderpriority"), F.lit('"]}}},"responseExceptions":['),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit('{"message":"late","node":"px"},{"message":"odd"}')).otherwise(F.lit("")),
        F.lit("]}"),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), doc.alias("json"))


def search_documents(spark: SparkSession, path: str) -> DataFrame:
    """Search documents built row by row: a header and two rows per order."""
    o = table(spark, path, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    doc = F.concat(
        F.lit('{"fieldDisplayUnits":[{"field":"name"},{"fieldId":"qty"},{}],"results":[{"resultsRow":{"name":"N'), key,
        F.lit('","qty":'), cust, F.lit('}},{"name":"M'), cust, F.lit('","col2":"z"}]}'),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), doc.alias("json"))


def tree_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested documents built row by row, quote leaves among them."""
    e = table(spark, path, "events")
    key = F.col("event_id").cast("string")
    doc = F.concat(
        F.lit('{"tickData":[{"type":"'), F.col("event_type"), F.lit('","size":'), F.regexp_extract("props", "[0-9]+", 0),
        F.lit('},{"type":"BID","brokerBuyCode":"B'), key, F.lit('"}],"meta":{"id":'), key,
        F.lit(',"live":true,"none":null,"deep":{"list":[['), key, F.lit(',2],[]],"empty":{}}}}'),
    )
    return e.select(F.col("event_id").alias("doc_id"), doc.alias("json"))


def raw_values(spark: SparkSession, path: str) -> DataFrame:
    """Text values of many kinds, with blanks and junk among them."""
    o = table(spark, path, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    value = (
        F.when(key % 8 == 0, cust)
        .when(key % 8 == 1, F.concat(F.lit(" "), cust, F.lit(",000")))
        .when(key % 8 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 8 == 3, F.lit("Y")).when(key % 8 == 4, F.lit(" NaN "))
        .when(key % 8 == 5, F.concat(cust, F.lit(".50"))).when(key % 8 == 6, F.lit("  "))
        .otherwise(F.col("o_orderpriority"))
    )
    return o.select(key.alias("row_id"), F.lit("F").alias("field"), value.alias("value"))


def raw_dates(spark: SparkSession, path: str) -> DataFrame:
    """Text dates, offsets and clock times of many forms, with junk among them."""
    o = table(spark, path, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    n = F.col("o_custkey") % 24
    text = (
        F.when(key % 11 == 0, F.date_format(day, "yyyy-MM-dd")).when(key % 11 == 1, F.date_format(day, "yyyyMMdd"))
        .when(key % 11 == 2, F.date_format(day, "yyyy/MM/dd")).when(key % 11 == 3, F.date_format(day, "dd-MM-yyyy"))
        .when(key % 11 == 4, F.date_format(day, "dd/MM/yyyy")).when(key % 11 == 5, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 11 == 6, F.concat(F.lit("-"), n.cast("string"), F.lit("d")))
        .when(key % 11 == 7, F.concat(n.cast("string"), F.lit(":05")))
        .when(key % 11 == 8, F.concat(F.lpad(n.cast("string"), 2, "0"), F.lit("30")))
        .when(key % 11 == 9, F.lit("09:30-16:00")).otherwise(F.concat(F.lit("2024-13-"), n.cast("string")))
    )
    return o.select(key.alias("row_id"), text.alias("text"))


def raw_instruments(spark: SparkSession, path: str) -> DataFrame:
    """Tickers of many kinds, with junk among them."""
    o = table(spark, path, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    code = F.substring(F.lit(refdata.MONTH_CODES), (cust % 12 + 1).cast("int"), F.lit(1))
    n = (cust % 9 + 1).cast("string")
    ticker = (
        F.when(key % 8 == 0, F.concat(F.lit("ES"), n, F.lit(" Index")))
        .when(key % 8 == 1, F.concat(F.lit("ES"), code, F.lpad((cust % 100).cast("string"), 2, "0"), F.lit(" Index")))
        .when(key % 8 == 2, F.concat(F.lit("SPY"), n, F.lit(" US Equity")))
        .when(key % 8 == 3, F.concat(F.lit("CDX IG CDSI S"), (cust % 50 + 1).cast("string"), F.lit(" 5Y Corp")))
        .when(key % 8 == 4, F.concat(F.lit("CDX HY CDSI S"), (cust % 50 + 1).cast("string"), F.lit(" V"), n, F.lit(" 10Y Corp")))
        .when(key % 8 == 5, F.concat(F.lit("UX"), code, n, F.lit(" Comdty")))
        .when(key % 8 == 6, F.lit("CDX EM CDSI GEN 5Y Corp"))
        .otherwise(F.concat(F.lit("JUNK="), cust.cast("string")))
    )
    return o.select(key.alias("row_id"), ticker.alias("ticker"))
