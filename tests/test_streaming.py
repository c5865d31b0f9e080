"""Streaming operators against their batch twins, over several files."""

import datetime
import logging

import pytest
from pyspark.sql import functions as F

from marketframe.operators import aggregate
from marketframe.sources import store
from marketframe.streaming import live, tables

SCHEMA = "ticker string, time timestamp, type string, value double, size bigint, event_id bigint"


def ticks(spark, n=4000):
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), (i % 7).cast("string"))).alias("ticker"),
        F.timestamp_seconds(1704067200 + i * 17).alias("time"), F.when(i % 4 == 0, "BID").otherwise("TRADE").alias("type"),
        ((i * 37) % 101 + 0.5).alias("value"), (i % 50 + 1).alias("size"), i.alias("event_id"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ticks"))
    ticks(spark).repartitionByRange(6, "time").sortWithinPartitions("time").write.mode("overwrite").parquet(path)
    return path


def stream(spark, folder, files=1):
    return store.read_stream(spark, folder, SCHEMA, files)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FLUSH = live.FlushPolicy(files_per_trigger=1)


def test_bars_update_mode_equals_batch(spark, folder):
    out = live.run_to_table(live.live_bars(stream(spark, folder), 5, "30 days"), "t", "update", ["ticker", "time"], FLUSH)
    assert rows(out) == rows(aggregate.bars_from_ticks(ticks(spark), 5))


def test_bars_append_mode_gives_closed_bars_only(spark, folder):
    batch = rows(aggregate.bars_from_ticks(ticks(spark), 5))
    out = rows(live.run_to_table(live.live_bars(stream(spark, folder), 5, "30 days"), "t"))
    assert set(out) <= set(batch)


def test_sliding_bars(spark, folder):
    out = live.run_to_table(live.live_bars(stream(spark, folder), 10, "30 days", slide=5), "t", "update", ["ticker", "time"])
    n = out.agg(F.sum("numEvents")).first()[0]
    assert n == 2 * ticks(spark).where("type = 'TRADE'").count()


def test_vwap_equals_batch(spark, folder):
    out = live.run_to_table(live.live_vwap(stream(spark, folder), watermark="30 days"), "t", "update", ["ticker", "date"])
    got = {(r.ticker, r.date): (round(r.vwap, 9), r.volume) for r in out.collect()}
    want = aggregate.vwap(ticks(spark).withColumn("date", F.to_date("time")), keys=("ticker", "date"))
    assert got == {(r.ticker, r.date): (round(r.vwap, 9), r.volume) for r in want.collect()}


def test_dedup(spark, folder):
    doubled = stream(spark, folder).withColumn("c", F.explode(F.array(F.lit(1), F.lit(2)))).drop("c")
    assert live.run_to_table(live.dedup_ticks(doubled, "30 days"), "t").count() == 4000


def test_latest_quote(spark, folder):
    out = live.run_to_table(live.latest_quote(stream(spark, folder)), "t", "update", ["ticker", "type"])
    best = {}
    for r in ticks(spark).orderBy("time").collect():
        best[(r.ticker, r.type)] = r.value
    assert {(r.ticker, r.type): r.value for r in out.collect()} == best


def test_live_ticks_fields(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1), "A", '{"BID":1.5,"MKTDATA_EVENT_TYPE":"QUOTE","X":{"y":1}}')], "timestamp timestamp, topic string, payload string")
    out = live.live_ticks(df, ["A"], ["BID", "ASK", "BID"])
    assert out.columns == ["timestamp", "topic", "BID", "ASK", "MKTDATA_EVENT_TYPE", "MKTDATA_EVENT_SUBTYPE"]
    assert tuple(out.first())[2:] == ("1.5", None, "QUOTE", None)
    assert live.live_all_fields(df).first().fields == {"BID": "1.5", "MKTDATA_EVENT_TYPE": "QUOTE"}
    with pytest.raises(ValueError):
        live.live_ticks(df, [], ["BID"])
    with pytest.raises(ValueError):
        live.live_ticks(df, None, [])


def test_callback_errors_do_not_stop_the_stream(spark, folder, caplog):
    seen = []

    def fn(batch, batch_id):
        seen.append(batch.count())
        if len(seen) == 2:
            raise RuntimeError("boom")

    q = stream(spark, folder).writeStream.foreachBatch(live.stream_callback(fn)).trigger(availableNow=True).start()
    with caplog.at_level(logging.ERROR):
        q.awaitTermination()
    assert sum(seen) == 4000 and len(seen) == 6


def test_overflow_policies(spark, folder):
    df = ticks(spark, 100)
    kept, dropped = live.OverflowPolicy("drop_newest", 30).keep(df, ["time"])
    assert (kept.count(), dropped) == (30, 70) and kept.agg(F.max("event_id")).first()[0] == 29
    assert live.OverflowPolicy().keep(df, ["time"]) == (df, 0)
    for bad in (("lossy", 1), ("block", 0)):
        with pytest.raises(ValueError):
            live.OverflowPolicy(*bad)
    with pytest.raises(ValueError):
        live.FlushPolicy(0)


def test_recovery_restarts_from_the_checkpoint(spark, folder, tmp_path):
    state = {"fail": True}

    def each(batch):
        if state["fail"] and batch.agg(F.min("event_id")).first()[0] > 1000:
            state["fail"] = False
            raise RuntimeError("lost")
        return batch

    start = lambda: live.write_table(stream(spark, folder), str(tmp_path / "out"), "append", each=each)
    assert live.run_with_recovery(start) == 1
    assert spark.read.schema(SCHEMA).parquet(str(tmp_path / "out" / "rows")).count() == 4000

    def broken():
        return live.write_table(stream(spark, folder), str(tmp_path / "none"), "append", each=lambda b: 1 / 0)
    with pytest.raises(Exception):
        live.run_with_recovery(broken, "none")
    with pytest.raises(Exception):
        live.run_with_recovery(broken, attempts=1)
    with pytest.raises(ValueError):
        live.run_with_recovery(broken, "retry")


def test_stats_and_drain(spark, folder, tmp_path):
    stats = live.StreamStats()
    spark.streams.addListener(stats)
    try:
        df = live.observed_ticks(stream(spark, folder).withColumnRenamed("time", "timestamp"))
        q = live.write_table(df, str(tmp_path / "out"), flush=live.FlushPolicy(interval="0 seconds"))
        live.drain(q)
        import time
        for _ in range(50):
            if stats.messages >= 4000:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(stats)
    assert stats.messages == 4000 and stats.batches >= 6
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == 4000


def test_tick_mode_and_control(spark):
    df = ticks(spark, 10)
    assert live.tick_mode(df, ["time"])["event_id"] == 0
    assert live.tick_mode(df.limit(0), ["time"]) is None
    topics = df.withColumnRenamed("ticker", "topic")
    control = spark.createDataFrame([("HOT",)], "topic string")
    assert live.with_active_topics(topics, control).count() == 4
    assert rows(aggregate.topics_add(control, control)) == [("HOT",)]


def test_bar_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    bars = aggregate.bars_from_ticks(ticks(spark).withColumn("ticker", F.concat("ticker", F.lit(" US Equity"))), 5)
    assert store.bar_cache_read(spark, path, "TRADE", "5m").count() == 0
    store.bar_cache_write(bars, path, "TRADE", "5m", as_of="2024-01-01 23:00:00")
    assert store.bar_cache_read(spark, path, "TRADE", "5m").count() == 0  # the day is not over
    store.bar_cache_write(bars, path, "TRADE", "5m", as_of="2024-01-03 00:00:00")
    store.bar_cache_write(bars, path, "TRADE", "5m", as_of="2024-01-03 00:00:00")  # stored days stay as they are
    read = lambda **kw: store.bar_cache_read(spark, path, "TRADE", "5m", **kw)
    assert rows(read()) == rows(bars)
    one = bars.where("ticker = 'HOT US Equity'").withColumn("volume", F.lit(-1.0))
    store.bar_cache_write(one, path, "TRADE", "5m", as_of="2024-01-03 00:00:00", reload=True)
    assert read().count() == bars.count() and read(tickers=["HOT US Equity"]).agg(F.max("volume")).first()[0] == -1.0
    plan = read(start="2024-01-01", end="2024-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event" in plan


def test_batches(spark):
    sizes = [len(b) for b in store.batches(ticks(spark, 2500), "ticks", 1000)]
    assert sizes == [1000, 1000, 500]
    with pytest.raises(ValueError):
        next(store.batches(ticks(spark, 1), "ref"))


def test_counts_do_not_depend_on_remembered_reports(spark, tmp_path):
    path = str(tmp_path / "ticks")
    ticks(spark, 80).repartitionByRange(8, "time").write.parquet(path)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        row = live.run_with_stats(stream(spark, path), "stats", "time", FLUSH).first()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert (row["messages"], row["last_message"], row["late_rows"]) == (80, ticks(spark, 80).agg(F.max("time")).first()[0], 0)


def test_update_tables_stay_as_large_as_their_keys(spark, tmp_path, monkeypatch):
    path, folder_ = str(tmp_path / "ticks"), str(tmp_path / "table")
    ticks(spark, 900).repartitionByRange(11, "time").write.parquet(path)
    quotes = live.latest_quote(stream(spark, path))
    sink = tables.upserting(folder_, quotes.schema, ["ticker", "type"], every=3)
    live._each_batch(quotes, folder_, sink, "update", FLUSH).awaitTermination()
    want = rows(ticks(spark, 900).groupBy("ticker", "type").agg(F.max_by("value", F.struct("time", "event_id")), F.max("time")))
    assert rows(live.read_updates(spark, folder_, quotes.schema, ["ticker", "type"])) == want
    versions, batches = tables.committed(spark, f"{folder_}/base", "version"), tables.committed(spark, f"{folder_}/rows", "batch")
    assert len(versions) == 2 and len(batches) <= 6 and min(batches) > versions[0]
    # a compaction that is repeated after a failure changes nothing
    tables.compact(spark, folder_, quotes.schema, ["ticker", "type"], versions[-1])
    assert rows(live.read_updates(spark, folder_, quotes.schema, ["ticker", "type"])) == want
    assert tables.committed(spark, f"{folder_}/nowhere", "version") == []


def test_fields_that_come_later_are_columns(spark, tmp_path):
    path = str(tmp_path / "messages")
    payloads = [('{"BID":1,"NESTED":{"x":1}}',), ('{"BID":2}',), ('{"ASK":"3","bid":4,"topic":"own"}',), ('{"BID":5,"LATE":true}',)]
    for i, p in enumerate(payloads):
        spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, i), f"T{i}", *p)], "timestamp timestamp, topic string, payload string").coalesce(1).write.mode("append").parquet(path)
    messages = store.read_stream(spark, path, "timestamp timestamp, topic string, payload string", 1)
    out = live.run_to_field_table(live.live_all_fields(messages), "fields", FLUSH)
    assert sorted(out.columns) == ["ASK", "BID", "LATE", "TOPIC_field", "timestamp", "topic"]
    got = {r["topic"]: (r["BID"], r["ASK"], r["LATE"], r["TOPIC_field"]) for r in out.collect()}
    assert got == {"T0": ("1", None, None, None), "T1": ("2", None, None, None), "T2": ("4", "3", None, "own"), "T3": ("5", None, "true", None)}


def test_topics_are_asked_for_every_batch(spark, tmp_path):
    path = str(tmp_path / "ticks")
    for part in range(3):
        ticks(spark, 30).where(F.col("event_id") % 3 == part).withColumn("ticker", F.lit("A")).coalesce(1).write.mode("append").parquet(path)
    asked = []

    def control(session):
        asked.append(1)
        return session.createDataFrame([("A",)] if len(asked) != 2 else [("B",)], "topic string")  # removed for the second batch

    rows_ = stream(spark, path).withColumnRenamed("ticker", "topic")
    out = live.run_controlled(rows_, "control", control, FLUSH)
    assert len(asked) == 3 and out.count() == 20


def test_updates_of_one_instant_are_defined(spark):
    at = datetime.datetime(2024, 1, 1)
    book = spark.createDataFrame([("T", "BID", 1, at, 5.0, 10, 2), ("T", "BID", 1, at, 9.0, 1, 1), ("T", "ASK", 1, at, 7.0, 3, 1)], "topic string, side string, level int, time timestamp, price double, size bigint, seq int")
    price = lambda df: {r["side"]: r["price"] for r in df.collect()}
    assert price(live.live_depth(book, "seq")) == {"BID": 5.0, "ASK": 7.0} and price(live.live_depth(book)) == {"BID": 9.0, "ASK": 7.0}


def test_appending_bars_reads_touched_days_only(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "cache"), []
    day = lambda d: spark.createDataFrame([("A US Equity", datetime.datetime(2024, 1, d, 9), 1.0, 1.0, 1.0, 1.0, float(d), 1)], store.BAR_DDL)
    for d in (2, 3, 4):
        store.bar_cache_write(day(d), path, "TRADE", "5m", as_of="2024-02-01")
    span = store.date_range
    monkeypatch.setattr(store, "date_range", lambda df, *a, **k: plans.append(span(df, *a, **k)) or plans[-1])
    store.bar_cache_write(day(3), path, "TRADE", "5m", as_of="2024-02-01")
    monkeypatch.setattr(store, "date_range", span)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    filters = plans[0]._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert filters.count("2024-01-03") == 2 and "Equity" in filters, filters
    assert sorted(r["volume"] for r in store.bar_cache_read(spark, path, "TRADE", "5m").collect()) == [2.0, 3.0, 4.0]
