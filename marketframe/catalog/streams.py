"""Streaming queries run to the end of the data, checked against their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.catalog.scans import BARS
from marketframe.catalog.tools import rounded
from marketframe.operators import aggregate
from marketframe.session import work_dir
from marketframe.sources import adapters as A
from marketframe.sources import store
from marketframe.streaming import live


def _events(spark, path):
    schema = A.table(spark, path, "events").schema
    return store.read_stream(spark, path, schema, glob="events.parquet")


def _ticks(spark, path):
    kind = F.col("event_type")
    return _events(spark, path).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit(" US Equity")).alias("ticker"),
        F.col("ts").cast("timestamp").alias("time"),
        F.when(kind == "purchase", F.lit("TRADE")).when(kind == "click", F.lit("BID")).when(kind == "view", F.lit("ASK"))
        .otherwise(F.upper(kind)).alias("type"),
        "value", F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("size"), "event_id")


@query("live_ticks", """SELECT timestamp, topic, last_trade AS "LAST_TRADE", bid AS "BID", etype AS "MKTDATA_EVENT_TYPE", esub AS "MKTDATA_EVENT_SUBTYPE" FROM messages""")
def live_ticks(spark, path):
    rows = live.live_ticks(A.messages_from(_events(spark, path)), None, ["LAST_TRADE", "BID", "LAST_TRADE"])
    return live.run_to_table(rows, "live-ticks")


@query("live_all_fields", """SELECT timestamp, topic, last_trade, size, bid, ask, CAST(CASE WHEN bid IS NULL THEN 5 ELSE 5 END AS INTEGER) AS n_fields FROM messages""")
def live_all_fields(spark, path):
    rows = live.live_all_fields(A.messages_from(_events(spark, path)))
    pick = lambda f: F.try_element_at("fields", F.lit(f))
    done = live.run_to_table(rows, "live-all-fields")
    return done.select(
        "timestamp", "topic", pick("LAST_TRADE").alias("last_trade"), pick("SIZE").alias("size"), pick("BID").alias("bid"),
        pick("ASK").alias("ask"), F.size("fields").alias("n_fields"))


@query("live_field_table", """SELECT timestamp, topic AS topic, last_trade AS "LAST_TRADE", size AS "SIZE", bid AS "BID", ask AS "ASK",
etype AS "MKTDATA_EVENT_TYPE", esub AS "MKTDATA_EVENT_SUBTYPE" FROM messages""")
def live_field_table(spark, path):
    return live.run_to_field_table(live.live_all_fields(A.messages_from(_events(spark, path))), "live-field-table")


@query("live_bars", f"SELECT * FROM {BARS}")
def live_bars(spark, path):
    return live.run_to_table(live.live_bars(_ticks(spark, path), 5), "live-bars", "update", ["ticker", "time"])


@query("live_sliding_bars", """SELECT ticker, CAST(time_bucket(INTERVAL '5 minutes', time) - to_minutes(CAST(5 * i AS INT)) AS TIMESTAMP) AS time, arg_min(value, {'t': time, 'e': event_id}) AS open, max(value) AS high,
min(value) AS low, arg_max(value, {'t': time, 'e': event_id}) AS close, CAST(sum(size) AS DOUBLE) AS volume, CAST(count(*) AS INTEGER) AS "numEvents"
FROM ticks, generate_series(0, 1) g(i) WHERE type = 'TRADE' GROUP BY ticker, time_bucket(INTERVAL '5 minutes', time) - to_minutes(CAST(5 * i AS INT))""")
def live_sliding_bars(spark, path):
    return live.run_to_table(live.live_bars(_ticks(spark, path), 10, slide=5), "live-sliding", "update", ["ticker", "time"])


@query("live_session_bars", """
WITH t AS (SELECT *, CASE WHEN time >= lag(time) OVER (PARTITION BY ticker ORDER BY time, event_id) + INTERVAL 12 HOUR
    OR lag(time) OVER (PARTITION BY ticker ORDER BY time, event_id) IS NULL THEN 1 ELSE 0 END AS cut FROM ticks WHERE type = 'TRADE'),
g AS (SELECT *, sum(cut) OVER (PARTITION BY ticker ORDER BY time, event_id) AS s FROM t),
b AS (SELECT ticker, min(time) AS time, max(time) + INTERVAL 12 HOUR AS end_time, arg_min(value, {'t': time, 'e': event_id}) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, {'t': time, 'e': event_id}) AS close, CAST(sum(size) AS DOUBLE) AS volume, CAST(count(*) AS INTEGER) AS "numEvents" FROM g GROUP BY ticker, s)
SELECT * FROM b WHERE end_time <= (SELECT max(time) - INTERVAL 10 MINUTE FROM ticks WHERE type = 'TRADE')""")
def live_session_bars(spark, path):
    return live.run_to_table(live.live_session_bars(_ticks(spark, path), "12 hours"), "live-session")


@query("live_vwap", """SELECT ticker, CAST(time AS DATE) AS date, round(sum(value * size) / nullif(sum(size), 0), 6) AS vwap, CAST(sum(size) AS BIGINT) AS volume
FROM ticks WHERE type = 'TRADE' AND CAST(time AS TIME) BETWEEN TIME '08:00:00' AND TIME '18:00:00' GROUP BY ticker, CAST(time AS DATE)""")
def live_vwap(spark, path):
    out = live.run_to_table(live.live_vwap(_ticks(spark, path), "08:00", "18:00"), "live-vwap", "update", ["ticker", "date"])
    return rounded(out, "vwap")


@query("latest_quote", """SELECT ticker, type, value, time FROM ticks QUALIFY row_number() OVER (PARTITION BY ticker, type ORDER BY time DESC, event_id DESC) = 1""")
def latest_quote(spark, path):
    return live.run_to_table(live.latest_quote(_ticks(spark, path)), "latest-quote", "update", ["ticker", "type"])


@query("live_depth", """SELECT concat('U', CAST(user_id AS VARCHAR)) AS topic, CASE WHEN event_type = 'click' THEN 'BID' ELSE 'ASK' END AS side, event_id % 5 AS level, ts AS time, value AS price,
CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS size FROM events WHERE event_type IN ('click', 'view') QUALIFY row_number() OVER (PARTITION BY user_id, event_type, event_id % 5 ORDER BY ts DESC) = 1""")
def live_depth(spark, path):
    e = _events(spark, path).where(F.col("event_type").isin("click", "view"))
    book = e.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("topic"),
        F.when(F.col("event_type") == "click", F.lit("BID")).otherwise(F.lit("ASK")).alias("side"), (F.col("event_id") % 5).alias("level"),
        F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("price"), F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("size"))
    return live.run_to_table(live.live_depth(book), "live-depth", "update", ["topic", "side", "level"])


@query("live_chains", """SELECT concat('R', CAST(user_id % 20 AS VARCHAR)) AS underlying, concat('M', CAST(event_id % 40 AS VARCHAR)) AS member, ts AS time, CASE WHEN event_type = 'signup' THEN 'ADD' ELSE 'REMOVE' END AS action
FROM events WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id % 20, event_id % 40 ORDER BY ts DESC) = 1""")
def live_chains(spark, path):
    members = _events(spark, path).select(
        F.concat(F.lit("R"), (F.col("user_id") % 20).cast("string")).alias("underlying"), F.concat(F.lit("M"), (F.col("event_id") % 40).cast("string")).alias("member"),
        F.col("ts").cast("timestamp").alias("time"), F.when(F.col("event_type") == "signup", F.lit("ADD")).otherwise(F.lit("REMOVE")).alias("action"),
        F.when(F.col("event_id") % 2 == 0, F.lit("OPTIONS")).otherwise(F.lit("FUTURES")).alias("kind"))
    return live.run_to_table(live.live_chains(members, "OPTIONS"), "live-chains", "update", ["underlying", "member"])


@query("dedup_ticks", "SELECT * FROM ticks")
def dedup_ticks(spark, path):
    doubled = _ticks(spark, path).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return live.run_to_table(live.dedup_ticks(doubled), "dedup")


@query("topic_control_join", """SELECT timestamp, topic, event_id FROM messages WHERE topic IN (SELECT topic FROM topic_state WHERE state NOT IN ('failed', 'terminated', 'unsubscribed'))""")
def topic_control_join(spark, path):
    from marketframe.operators import status

    rows = A.messages_from(_events(spark, path)).select("timestamp", "topic", "event_id")
    return live.run_controlled(rows, "topic-control", lambda session: status.active_topics(A.subscription_events(session, path)))


@query("hist_stream_batches", """SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS px_last FROM orders""")
def hist_stream_batches(spark, path):
    schema = A.table(spark, path, "orders").schema
    rows = store.read_stream(spark, path, schema, glob="orders.parquet").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("ticker"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("px_last"))
    return live.run_to_table(rows, "hist-batches")


@query("ticks_stream_batches", "SELECT ticker, time, value, size FROM ticks WHERE type = 'TRADE'")
def ticks_stream_batches(spark, path):
    rows = _ticks(spark, path).where("type = 'TRADE'").select("ticker", "time", "value", "size")
    return live.run_to_table(rows, "tick-batches")


@query("bars_stream_batches", f"SELECT * FROM {BARS}")
def bars_stream_batches(spark, path):
    folder = work_dir(spark, "bars-source")
    aggregate.bars_from_ticks(A.ticks(spark, path), 5).write.parquet(folder)
    return live.run_to_table(store.read_stream(spark, folder, store.BAR_DDL, files_per_trigger=2), "bar-batches")


@query("subscribe_source", "SELECT timestamp, topic, payload FROM (SELECT timestamp, topic, concat('{\"LAST_TRADE\":', last_trade, ',\"SIZE\":', size, CASE WHEN bid IS NOT NULL THEN concat(',\"BID\":\"', bid, '\"') ELSE concat(',\"ASK\":\"', ask, '\"') END, ',\"NESTED\":{\"x\":1},\"LIST\":[1,2],\"MKTDATA_EVENT_TYPE\":\"', etype, '\",\"MKTDATA_EVENT_SUBTYPE\":\"', esub, '\"}') AS payload FROM messages)")
def subscribe_source(spark, path):
    return live.run_to_table(A.messages_from(_events(spark, path)).select("timestamp", "topic", "payload"), "subscribe")


@query("tick_mode", "SELECT ticker, time, type, value, size, event_id FROM ticks ORDER BY time, event_id LIMIT 1")
def tick_mode(spark, path):
    folder = work_dir(spark, "tick-mode")
    rows = _ticks(spark, path)
    schema = rows.schema
    first = lambda batch: batch.orderBy("time", "event_id").limit(1)
    live.run_with_recovery(lambda: live.write_table(rows, folder, each=first))
    return live.read_rows(spark, folder, schema)


@query("stream_callback", "SELECT type, count(*) AS rows FROM ticks GROUP BY type")
def stream_callback(spark, path):
    folder = work_dir(spark, "callback")

    def count_types(batch, batch_id):
        batch.groupBy("type").count().write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    query_ = _ticks(spark, path).writeStream.foreachBatch(live.stream_callback(count_types)).option(
        "checkpointLocation", f"{folder}/_checkpoints").trigger(availableNow=True).start()
    query_.awaitTermination()
    written = spark.read.schema("type string, count long, batch long").parquet(f"{folder}/rows")
    return written.groupBy("type").agg(F.sum("count").alias("rows"))


@query("stream_stats", "SELECT count(*) AS messages, max(time) AS last_message, CAST(0 AS BIGINT) AS late_rows FROM ticks")
def stream_stats(spark, path):
    return live.run_with_stats(_ticks(spark, path), "stream-stats", "time")


@query("overflow_policy", "SELECT * FROM ticks ORDER BY time, event_id LIMIT 600")
def overflow_policy(spark, path):
    """Newest rows above the capacity of a batch are dropped: the policy itself is the limit."""
    folder = work_dir(spark, "overflow")
    rows = _ticks(spark, path)
    schema = rows.schema
    policy = live.OverflowPolicy("drop_newest", 600)
    live.run_with_recovery(lambda: live.write_table(rows, folder, each=lambda b: policy.keep(b, ["time", "event_id"])[0]))
    return live.read_rows(spark, folder, schema)


@query("flush_policy", "SELECT * FROM ticks")
def flush_policy(spark, path):
    return live.run_to_table(_ticks(spark, path), "flush", flush=live.FlushPolicy(files_per_trigger=1))


@query("recovery_policy", "SELECT * FROM ticks")
def recovery_policy(spark, path):
    """The first attempt fails before it writes; the restart delivers every row once."""
    folder = work_dir(spark, "recovery")
    rows = _ticks(spark, path)
    schema = rows.schema
    attempts = []

    def each(batch):
        attempts.append(1)
        if len(attempts) == 1:
            raise RuntimeError("connection lost")
        return batch

    live.run_with_recovery(lambda: live.write_table(rows, folder, each=each))
    return live.read_rows(spark, folder, schema)


@query("drain", "SELECT * FROM ticks")
def drain(spark, path):
    folder = work_dir(spark, "drain")
    rows = _ticks(spark, path)
    schema = rows.schema
    live.drain(live.write_table(rows, folder, flush=live.FlushPolicy(interval="0 seconds")))
    return live.read_rows(spark, folder, schema)


@query("live_topic_states", "SELECT topic, state, last_change FROM topic_state")
def live_topic_states(spark, path):
    from marketframe.operators import status

    events = A.subscription_events_from(_events(spark, path))
    return live.run_to_table(status.topic_states(events), "topic-states", "update", ["topic"])


@query("live_topic_failures", """SELECT topic AS ticker, detail AS reason, CASE message_type WHEN 'SubscriptionFailure' THEN 'failure' ELSE 'terminated' END AS kind FROM sub_events
WHERE message_type IN ('SubscriptionFailure', 'SubscriptionTerminated') QUALIFY row_number() OVER (PARTITION BY topic ORDER BY event_time DESC, seq DESC) = 1""")
def live_topic_failures(spark, path):
    from marketframe.operators import status

    events = A.subscription_events_from(_events(spark, path))
    return live.run_to_table(status.topic_failures(events), "topic-failures", "update", ["ticker"])


@query("live_stream_metrics", """SELECT topic, count(*) FILTER (WHERE esub <> 'DATALOSS') AS messages_received, count(*) FILTER (WHERE esub = 'DATALOSS') AS data_loss_events,
max(timestamp) FILTER (WHERE esub <> 'DATALOSS') AS last_message, max(timestamp) FILTER (WHERE esub = 'DATALOSS') AS last_data_loss FROM messages GROUP BY topic""")
def live_stream_metrics(spark, path):
    from marketframe.operators import status

    rows = live.live_ticks(A.messages_from(_events(spark, path)), None, ["LAST_TRADE"])
    return live.run_to_table(status.stream_metrics(rows), "stream-metrics", "update", ["topic"])
