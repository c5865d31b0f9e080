"""Subscription health from the event log: states, failures, counters, history.

Input ``events``: event_time (timestamp), seq, topic, category, level, message_type,
detail. All results are partial aggregates per topic or scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe import refdata

HISTORY_ROWS = 128

# Message type -> topic state.
TOPIC_STATES = {
    "SubscriptionPending": "pending",
    "SubscriptionStarted": "started",
    "SubscriptionStreaming": "streaming",
    "SubscriptionUnsubscribing": "unsubscribing",
    "SubscriptionUnsubscribed": "unsubscribed",
    "SubscriptionFailure": "failed",
    "SubscriptionTerminated": "terminated",
}


def _state() -> Column:
    # the first data row of a topic makes it streaming
    data = F.when(F.col("category") == "data", F.lit("streaming"))
    return F.coalesce(data, F.try_element_at(refdata.literal_map(TOPIC_STATES), F.col("message_type")))


def topic_states(events: DataFrame) -> DataFrame:
    """Latest state per topic with the time it was reached."""
    at = F.struct("event_time", "seq")
    rows = events.withColumn("_state", _state()).where(F.col("_state").isNotNull())
    return rows.groupBy("topic").agg(F.max_by("_state", at).alias("state"), F.max("event_time").alias("last_change"))


def topic_failures(events: DataFrame) -> DataFrame:
    """Last failure or termination per topic, with its reason and kind."""
    bad = events.where(F.col("message_type").isin("SubscriptionFailure", "SubscriptionTerminated"))
    kind = F.when(F.col("message_type") == "SubscriptionFailure", "failure").otherwise("terminated")
    at = F.struct("event_time", "seq")
    return bad.groupBy(F.col("topic").alias("ticker")).agg(
        F.max_by("detail", at).alias("reason"), F.max_by(kind, at).alias("kind")
    )


def all_failed(events: DataFrame) -> DataFrame:
    """One row: whether every topic ended in failure or termination."""
    bad = F.col("state").isin("failed", "terminated")
    return topic_states(events).agg(
        F.coalesce(F.min(bad), F.lit(False)).alias("all_failed"), F.count_if(bad).alias("failed_topics"),
        F.count(F.lit(1)).alias("topics"),
    )


def active_topics(events: DataFrame) -> DataFrame:
    """Topics not ended, by state."""
    return topic_states(events).where(~F.col("state").isin("failed", "terminated", "unsubscribed"))


def event_history(events: DataFrame, keep: int = HISTORY_ROWS) -> DataFrame:
    """The newest events per topic; tasks keep ``keep`` per topic before the shuffle."""
    w = Window.partitionBy("topic").orderBy(F.col("event_time").desc(), F.col("seq").desc())
    newest = events.withColumn("age", F.row_number().over(w)).where(F.col("age") <= keep)
    return newest.withColumn("age", F.col("age").cast("bigint"))


def session_status(events: DataFrame) -> DataFrame:
    """One row: connection state, counts of drops and recoveries."""
    s = F.col("category") == "session"
    at = F.struct("event_time", "seq")
    when = lambda m: s & (F.col("message_type") == m)
    return events.agg(
        F.max_by("message_type", F.when(s, at)).alias("state"), F.max(F.when(s, F.col("event_time"))).alias("last_change"),
        F.count_if(when("SessionConnectionDown")).alias("disconnect_count"),
        F.count_if(when("SessionConnectionUp")).alias("reconnect_count"),
        F.count_if(when("RecoveryAttempt")).alias("recovery_attempt_count"),
        F.count_if(when("RecoverySuccess")).alias("recovery_success_count"),
    )


def admin_status(events: DataFrame) -> DataFrame:
    """One row: slow-consumer warnings and data losses."""
    a = F.col("category") == "admin"
    at = F.struct("event_time", "seq")
    warn, clear, loss = (
        a & (F.col("message_type") == m) for m in ("SlowConsumerWarning", "SlowConsumerWarningCleared", "DataLoss")
    )
    last = F.max_by(F.col("message_type"), F.when(warn | clear, at))
    return events.agg(
        F.coalesce(last == "SlowConsumerWarning", F.lit(False)).alias("slow_consumer_warning_active"),
        F.count_if(warn).alias("slow_consumer_warning_count"), F.count_if(clear).alias("slow_consumer_cleared_count"),
        F.count_if(loss).alias("data_loss_count"),
        F.max(F.when(warn, F.col("event_time"))).alias("last_warning"), F.max(F.when(clear, F.col("event_time"))).alias("last_cleared"),
        F.max(F.when(loss, F.col("event_time"))).alias("last_data_loss"),
    )


def service_status(events: DataFrame) -> DataFrame:
    """Latest state per service; ``detail`` names the service."""
    rows = events.where(F.col("category") == "service")
    at = F.struct("event_time", "seq")
    return rows.groupBy(F.col("detail").alias("service")).agg(
        F.max_by(F.col("message_type") == "ServiceUp", at).alias("up"), F.max("event_time").alias("last_change")
    )


def data_loss_split(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages without loss markers, and the markers (to be counted)."""
    marker = (F.col("MKTDATA_EVENT_TYPE") == "SUMMARY") & (F.col("MKTDATA_EVENT_SUBTYPE") == "DATALOSS")
    marker = F.coalesce(marker, F.lit(False))
    return messages.where(~marker), messages.where(marker)


def stream_metrics(messages: DataFrame) -> DataFrame:
    """Per topic: messages, loss markers and the time of the last of each."""
    marker = (F.col("MKTDATA_EVENT_TYPE") == "SUMMARY") & (F.col("MKTDATA_EVENT_SUBTYPE") == "DATALOSS")
    marker = F.coalesce(marker, F.lit(False))
    return messages.groupBy("topic").agg(
        F.count_if(~marker).alias("messages_received"), F.count_if(marker).alias("data_loss_events"),
        F.max(F.when(~marker, F.col("timestamp"))).alias("last_message"),
        F.max(F.when(marker, F.col("timestamp"))).alias("last_data_loss"),
    )


def stream_metrics_total(per_topic: DataFrame) -> DataFrame:
    """Totals over topics: sums and the latest times."""
    return per_topic.agg(
        F.sum("messages_received").alias("messages_received"), F.sum("data_loss_events").alias("data_loss_events"),
        F.max("last_message").alias("last_message"), F.max("last_data_loss").alias("last_data_loss"),
    )
