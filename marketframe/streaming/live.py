"""Live market data on Structured Streaming.

A message stream has ``timestamp``, ``topic`` and ``payload`` (JSON text). All
stateful operators are built-in aggregates, so state lives in the JVM store,
partial results combine before the shuffle, and a busy topic sends one row per
key and task.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketframe.operators.aggregate import bar_columns, clock_between
from marketframe.session import work_dir
from marketframe.streaming import tables

log = logging.getLogger(__name__)

EVENT_FIELDS = ["MKTDATA_EVENT_TYPE", "MKTDATA_EVENT_SUBTYPE"]


def stream_fields(fields: Sequence[str]) -> list[str]:
    """Requested fields without doubles, event type and subtype behind them."""
    out: list[str] = []
    for f in [*fields, *EVENT_FIELDS]:
        if f not in out:
            out.append(f)
    return out


def live_ticks(stream: DataFrame, topics: Sequence[str] | None, fields: Sequence[str]) -> DataFrame:
    """One row per message: time, topic, requested fields (null where absent), event type and subtype."""
    if topics is not None and not topics:
        raise ValueError("at least one topic is required")
    if not fields:
        raise ValueError("at least one field is required")
    rows = stream if topics is None else stream.where(F.col("topic").isin(list(topics)))
    values = F.from_json("payload", "map<string,string>")
    at = F.coalesce("timestamp", F.current_timestamp())
    return rows.withColumn("_v", values).select(
        at.alias("timestamp"), "topic", *[F.try_element_at("_v", F.lit(f)).alias(f) for f in stream_fields(fields)]
    )


def live_all_fields(stream: DataFrame) -> DataFrame:
    """Every scalar field of a message as a map; nested values are left out.

    New fields need no new schema: project them from the map on demand.
    """
    values = F.from_json("payload", "map<string,variant>")
    scalar = F.map_filter(values, lambda _, v: ~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    text = F.transform_values(scalar, lambda _, v: F.try_variant_get(v, "$", "string"))
    return stream.select("timestamp", "topic", text.alias("fields"))


def live_vwap(
    ticks: DataFrame, start_time: str | None = None, end_time: str | None = None, watermark: str = "1 day",
    typ: str = "TRADE",
) -> DataFrame:
    """Running VWAP and volume per ticker and day, for update mode; old days leave the state."""
    rows = ticks.where((F.col("type") == typ) & clock_between(F.col("time"), start_time, end_time))
    day = F.window("time", "1 day")
    volume, amount = F.sum("size"), F.sum(F.col("value") * F.col("size"))
    grouped = rows.withWatermark("time", watermark).groupBy("ticker", day)
    return grouped.agg((amount / F.nullif(volume, F.lit(0))).alias("vwap"), volume.alias("volume")).select(
        "ticker", F.to_date("window.start").alias("date"), "vwap", "volume"
    )


def live_bars(
    ticks: DataFrame, interval: int = 1, watermark: str = "10 minutes", slide: int | None = None,
    start_time: str | None = None, end_time: str | None = None, typ: str = "TRADE",
) -> DataFrame:
    """Bars of ``interval`` minutes; append mode gives closed bars, update mode forming ones.

    With ``slide`` the bars overlap. Rows later than the watermark are dropped
    and counted by the query's progress.
    """
    rows = ticks.where((F.col("type") == typ) & clock_between(F.col("time"), start_time, end_time))
    width = F.window("time", f"{interval} minutes", f"{slide or interval} minutes")
    bars = rows.withWatermark("time", watermark).groupBy("ticker", width.alias("w")).agg(*bar_columns())
    return bars.select("ticker", F.col("w.start").alias("time"), "open", "high", "low", "close", "volume", "numEvents")


def live_session_bars(ticks: DataFrame, gap: str = "30 minutes", watermark: str = "10 minutes", typ: str = "TRADE") -> DataFrame:
    """Bars over bursts of trading: a burst ends after ``gap`` without a trade."""
    rows = ticks.where(F.col("type") == typ).withWatermark("time", watermark)
    bars = rows.groupBy("ticker", F.session_window("time", gap).alias("w")).agg(*bar_columns())
    return bars.select(
        "ticker", F.col("w.start").alias("time"), F.col("w.end").alias("end_time"),
        "open", "high", "low", "close", "volume", "numEvents",
    )


def _latest(rows: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], seq: str | None) -> DataFrame:
    """Latest row per key; of one instant the row with the largest ``seq``, else with the largest values."""
    order = F.struct(time, *([seq] if seq else []), *values)
    best = rows.groupBy(*keys).agg(F.max(order).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (time, *values)])


def live_depth(book: DataFrame, seq: str | None = None) -> DataFrame:
    """Current order book: the latest row per (topic, side, level), for update mode."""
    return _latest(book, ["topic", "side", "level"], "time", ["price", "size"], seq)


def live_chains(members: DataFrame, kind: str = "OPTIONS", seq: str | None = None) -> DataFrame:
    """Current chain membership: the latest action per (underlying, member)."""
    if kind not in ("OPTIONS", "FUTURES"):
        raise ValueError("kind must be OPTIONS or FUTURES")
    return _latest(members.where(F.col("kind") == kind), ["underlying", "member"], "time", ["action"], seq)


def latest_quote(ticks: DataFrame) -> DataFrame:
    """Last value per (ticker, type), for update mode."""
    at = F.struct("time", "event_id")
    return ticks.groupBy("ticker", "type").agg(F.max_by("value", at).alias("value"), F.max("time").alias("time"))


def dedup_ticks(ticks: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop replays of an event id seen within the watermark."""
    return ticks.withWatermark("time", watermark).dropDuplicatesWithinWatermark(["event_id"])


# -- running a query ---------------------------------------------------------


@dataclass
class FlushPolicy:
    """When a batch goes out: rows (as files) per trigger and the trigger interval."""

    files_per_trigger: int = 1000
    interval: str | None = None

    def __post_init__(self) -> None:
        if self.files_per_trigger < 1:
            raise ValueError("a batch needs at least one file")

    def trigger(self) -> dict[str, object]:
        return {"processingTime": self.interval} if self.interval else {"availableNow": True}


OVERFLOW_CAPACITY = 256


@dataclass
class OverflowPolicy:
    """What happens to a batch above capacity.

    ``block`` takes everything (the source is read at the sink's pace);
    ``drop_newest`` keeps the first rows of a batch in time order up to the
    capacity and counts the rest.
    """

    name: str = "block"
    capacity: int = OVERFLOW_CAPACITY

    def __post_init__(self) -> None:
        if self.name not in ("block", "drop_newest"):
            raise ValueError(f"overflow policy {self.name!r}: block or drop_newest")
        if self.capacity < 1:
            raise ValueError("capacity must be at least 1")

    def keep(self, batch: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
        if self.name == "block":
            return batch, 0
        total = batch.count()
        return batch.orderBy(*order).limit(self.capacity), max(0, total - self.capacity)


@dataclass
class StreamStats(StreamingQueryListener):
    """Counts over a query's batches, read from its progress reports."""

    messages: int = 0
    batches: int = 0
    late_rows: int = 0
    observed: dict[str, dict[str, object]] = field(default_factory=dict)
    last_progress: str | None = None

    def onQueryStarted(self, event) -> None:
        return None

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.messages += p.numInputRows
        self.batches += 1
        self.late_rows += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        for name, row in p.observedMetrics.items():
            self.observed[name] = row.asDict()
        self.last_progress = p.timestamp

    def onQueryIdle(self, event) -> None:
        return None

    def onQueryTerminated(self, event) -> None:
        return None


def observed_ticks(ticks: DataFrame, name: str = "stream") -> DataFrame:
    """Count messages and note the last event time while rows pass by."""
    return ticks.observe(name, F.count(F.lit(1)).alias("messages"), F.max("timestamp").alias("last_message"))


def stream_callback(fn: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function whose errors are logged while the stream goes on."""
    def run(batch: DataFrame, batch_id: int) -> None:
        try:
            fn(batch, batch_id)
        except Exception:
            log.exception("callback failed on batch %s", batch_id)
    return run


def tick_mode(batch: DataFrame, order: Sequence[str]) -> dict[str, object] | None:
    """The first row of a batch as a dictionary."""
    row = batch.orderBy(*order).limit(1).first()
    return row.asDict() if row else None


def with_active_topics(batch: DataFrame, control: DataFrame | Callable[[SparkSession], DataFrame]) -> DataFrame:
    """Rows of a batch whose topic is active now (control table: topic). A function is asked again for every batch."""
    table = control(batch.sparkSession) if callable(control) else control
    return batch.join(table.select("topic"), "topic", "left_semi").select(*batch.columns)


def run_controlled(
    stream: DataFrame, purpose: str, control: Callable[[SparkSession], DataFrame], flush: FlushPolicy | None = None
) -> DataFrame:
    """Process a stream, each batch with the topics that are active when it runs: a topic added or removed counts from the next batch on."""
    spark, folder, schema = stream.sparkSession, work_dir(stream.sparkSession, purpose), stream.schema
    run_with_recovery(lambda: write_table(stream, folder, flush=flush, each=lambda batch: with_active_topics(batch, control)))
    return read_rows(spark, folder, schema)


def write_table(
    stream: DataFrame, folder: str, mode: str = "append", flush: FlushPolicy | None = None,
    each: Callable[[DataFrame], DataFrame] | None = None, keys: Sequence[str] = (),
) -> StreamingQuery:
    """Start a query that writes its rows to a table folder.

    Append mode uses the exactly-once file sink. Update mode writes every
    batch to its own folder, replaced as a whole if the batch is repeated;
    with ``keys`` batches are compacted now and then, so that the table stays
    as large as it has keys. ``read_updates`` returns the newest row per key.
    """
    if mode == "append" and each is None:
        return (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{folder}/_checkpoints").option("path", f"{folder}/rows")
            .trigger(**(flush or FlushPolicy()).trigger()).start()
        )
    if keys and each is None:
        return _each_batch(stream, folder, tables.upserting(folder, stream.schema, keys), mode, flush)
    return _each_batch(stream, folder, lambda batch, n: tables.write_batch(each(batch) if each else batch, folder, n), mode, flush)


def _each_batch(stream: DataFrame, folder: str, sink: Callable[[DataFrame, int], None], mode: str = "append", flush: FlushPolicy | None = None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink).outputMode(mode)
        .option("checkpointLocation", f"{folder}/_checkpoints").trigger(**(flush or FlushPolicy()).trigger()).start()
    )


def read_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Rows a query has written to a table folder."""
    return spark.read.schema(schema).parquet(f"{folder}/rows").select(*schema.fieldNames())


def read_updates(spark: SparkSession, folder: str, schema, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key of an update-mode table."""
    return tables.read_updates(spark, folder, schema, keys)


def run_to_field_table(stream: DataFrame, purpose: str, flush: FlushPolicy | None = None) -> DataFrame:
    """Process messages of ``live_all_fields`` into a table with a column per field; one that first comes in a later batch is null before."""
    spark, folder = stream.sparkSession, work_dir(stream.sparkSession, purpose)
    run_with_recovery(lambda: _each_batch(stream, folder, tables.widening(folder), flush=flush))
    return tables.read_widened(spark, folder)


def drain(query: StreamingQuery, discard: bool = False) -> None:
    """Stop a query, first processing what has arrived unless ``discard``."""
    if not discard:
        query.processAllAvailable()
    query.stop()


RECOVERY_ATTEMPTS = 3


def run_with_recovery(
    start: Callable[[], StreamingQuery], policy: str = "resubscribe", attempts: int = RECOVERY_ATTEMPTS
) -> int:
    """Run a query to its end, restarting it from its checkpoint after a failure.

    Returns the number of restarts. ``none`` lets the first failure through.
    """
    if policy not in ("none", "resubscribe"):
        raise ValueError(f"recovery policy {policy!r}: none or resubscribe")
    tries = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return tries
        except Exception:
            tries += 1
            if policy == "none" or tries > attempts:
                raise
            log.warning("stream failed, restart %s of %s", tries, attempts)


def run_to_table(
    stream: DataFrame, purpose: str, mode: str = "append", keys: Sequence[str] = (), flush: FlushPolicy | None = None
) -> DataFrame:
    """Process all data that is there and return the resulting table.

    The table lies in the shared checkpoint folder, so a lost executor only
    repeats its tasks and a failed query resumes from its checkpoint.
    """
    spark = stream.sparkSession
    folder = work_dir(spark, purpose)
    schema = stream.schema
    run_with_recovery(lambda: write_table(stream, folder, mode, flush, keys=keys))
    if mode == "append":
        return read_rows(spark, folder, schema)
    return read_updates(spark, folder, schema, keys)


class _LateRows(StreamingQueryListener):
    """Rows that one query dropped as too late, over all its batches."""

    def __init__(self) -> None:
        self.late: dict[str, int] = {}
        self.ended: set[str] = set()
        self.told = threading.Condition()

    def onQueryStarted(self, event) -> None:
        return None

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.late[run] = self.late.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        return None

    def onQueryTerminated(self, event) -> None:
        with self.told:
            self.ended.add(str(event.runId))
            self.told.notify_all()

    def of(self, run: str, seconds: float = 60) -> int:
        """The count of a run, once all its reports are in."""
        with self.told:
            self.told.wait_for(lambda: run in self.ended, seconds)
        return self.late.get(run, 0)


def run_with_stats(stream: DataFrame, purpose: str, time: str = "timestamp", flush: FlushPolicy | None = None) -> DataFrame:
    """Write a stream to a table and return one row about the run: messages, last message, late rows.

    Messages are counted by the sink, batch by batch beside the rows, so a
    repeated batch counts once and no report can be forgotten. Late rows come
    from the reports of this run.
    """
    spark, folder = stream.sparkSession, work_dir(stream.sparkSession, purpose)
    reports = _LateRows()
    spark.streams.addListener(reports)
    try:
        query = _each_batch(stream, folder, tables.counting(folder, time), flush=flush)
        query.awaitTermination()
        late = reports.of(str(query.runId))
    finally:
        spark.streams.removeListener(reports)
    return tables.read_counts(spark, folder).withColumn("late_rows", F.lit(late).cast("long"))
