"""Queries of subscription health over the event log."""

from __future__ import annotations

from marketframe.catalog.registry import query
from marketframe.operators import status
from marketframe.sources import adapters as A


@query("topic_states", "SELECT topic, state, last_change FROM topic_state")
def topic_states(spark, path):
    return status.topic_states(A.subscription_events(spark, path))


@query("topic_failures", """SELECT topic AS ticker, detail AS reason, CASE message_type WHEN 'SubscriptionFailure' THEN 'failure' ELSE 'terminated' END AS kind FROM sub_events
WHERE message_type IN ('SubscriptionFailure', 'SubscriptionTerminated') QUALIFY row_number() OVER (PARTITION BY topic ORDER BY event_time DESC, seq DESC) = 1""")
def topic_failures(spark, path):
    return status.topic_failures(A.subscription_events(spark, path))


@query("all_failed", """SELECT min(state IN ('failed', 'terminated')) AS all_failed, count(*) FILTER (WHERE state IN ('failed', 'terminated')) AS failed_topics,
count(*) AS topics FROM topic_state""")
def all_failed(spark, path):
    return status.all_failed(A.subscription_events(spark, path))


@query("active_topics", "SELECT topic, state, last_change FROM topic_state WHERE state NOT IN ('failed', 'terminated', 'unsubscribed')")
def active_topics(spark, path):
    return status.active_topics(A.subscription_events(spark, path))


@query("event_history", """SELECT *, row_number() OVER (PARTITION BY topic ORDER BY event_time DESC, seq DESC) AS age FROM sub_events QUALIFY age <= 16""")
def event_history(spark, path):
    return status.event_history(A.subscription_events(spark, path), 16)


@query("session_status", """SELECT arg_max(message_type, {'a': event_time, 's': seq}) FILTER (WHERE category = 'session') AS state, max(event_time) FILTER (WHERE category = 'session') AS last_change,
count(*) FILTER (WHERE message_type = 'SessionConnectionDown') AS disconnect_count, count(*) FILTER (WHERE message_type = 'SessionConnectionUp') AS reconnect_count,
count(*) FILTER (WHERE message_type = 'RecoveryAttempt') AS recovery_attempt_count, count(*) FILTER (WHERE message_type = 'RecoverySuccess') AS recovery_success_count FROM sub_events""")
def session_status(spark, path):
    return status.session_status(A.subscription_events(spark, path))


@query("admin_status", """SELECT arg_max(message_type, {'a': event_time, 's': seq}) FILTER (WHERE message_type IN ('SlowConsumerWarning', 'SlowConsumerWarningCleared')) = 'SlowConsumerWarning' AS slow_consumer_warning_active,
count(*) FILTER (WHERE message_type = 'SlowConsumerWarning') AS slow_consumer_warning_count, count(*) FILTER (WHERE message_type = 'SlowConsumerWarningCleared') AS slow_consumer_cleared_count,
count(*) FILTER (WHERE message_type = 'DataLoss') AS data_loss_count, max(event_time) FILTER (WHERE message_type = 'SlowConsumerWarning') AS last_warning,
max(event_time) FILTER (WHERE message_type = 'SlowConsumerWarningCleared') AS last_cleared, max(event_time) FILTER (WHERE message_type = 'DataLoss') AS last_data_loss FROM sub_events""")
def admin_status(spark, path):
    return status.admin_status(A.subscription_events(spark, path))


@query("service_status", """SELECT detail AS service, message_type = 'ServiceUp' AS up, event_time AS last_change FROM sub_events WHERE category = 'service'
QUALIFY row_number() OVER (PARTITION BY detail ORDER BY event_time DESC, seq DESC) = 1""")
def service_status(spark, path):
    return status.service_status(A.subscription_events(spark, path))


def _parsed(spark, path):
    from marketframe.streaming import live

    return live.live_ticks(A.payload_messages(spark, path), None, ["LAST_TRADE"])


METRICS = """(SELECT topic, count(*) FILTER (WHERE esub <> 'DATALOSS') AS messages_received, count(*) FILTER (WHERE esub = 'DATALOSS') AS data_loss_events,
max(timestamp) FILTER (WHERE esub <> 'DATALOSS') AS last_message, max(timestamp) FILTER (WHERE esub = 'DATALOSS') AS last_data_loss FROM messages GROUP BY topic)"""


@query("stream_metrics", f"SELECT * FROM {METRICS}")
def stream_metrics(spark, path):
    return status.stream_metrics(_parsed(spark, path))


@query("stream_metrics_total", f"""SELECT CAST(sum(messages_received) AS BIGINT) AS messages_received, CAST(sum(data_loss_events) AS BIGINT) AS data_loss_events,
max(last_message) AS last_message, max(last_data_loss) AS last_data_loss FROM {METRICS}""")
def stream_metrics_total(spark, path):
    return status.stream_metrics_total(status.stream_metrics(_parsed(spark, path)))


@query("data_loss_split", """SELECT timestamp, topic, last_trade AS "LAST_TRADE", etype AS "MKTDATA_EVENT_TYPE", esub AS "MKTDATA_EVENT_SUBTYPE" FROM messages WHERE esub <> 'DATALOSS'""")
def data_loss_split(spark, path):
    return status.data_loss_split(_parsed(spark, path))[0]
