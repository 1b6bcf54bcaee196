"""The event queries as streams over the event files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount
from ..sources.tables import Tables
from ..streaming import events as S
from ..streaming.state import keep_latest, keep_once
from .logistics import TIMELINE_SQL, shipment_events, timeline_columns
from .registry import query
from .sqltext import d, m

#: How late events may come.
DELAY = "10 minutes"


def stream(t: Tables) -> DataFrame:
    return S.event_stream(t.spark, t.root, "events.parquet", t.events.schema, "ts")


@query(
    "stream_dedup_bucket",
    """WITH r AS (SELECT event_id, user_id, event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, ROW_NUMBER() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL 5 MINUTE, ts) ORDER BY ts, event_id) AS rn FROM events)
SELECT event_id, user_id, event_type, bucket FROM r WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows, close = S.with_end_mark(stream(t).select("event_id", "user_id", "event_type", "ts"), "ts")
    first = S.first_per_bucket(rows, ["user_id", "event_type"], "ts", 5, "event_id", DELAY)
    return S.run_append(first, "stream-bucket", close).select("event_id", "user_id", "event_type", "bucket")


@query("stream_dedup", "SELECT event_id, user_id, event_type, ts FROM events")
def _(t: Tables) -> DataFrame:
    """Two feeds that carry the same events, deduplicated on the event key."""
    rows = stream(t).select("event_id", "user_id", "event_type", "ts")
    return keep_once(S.unite(rows, rows), ["event_id"], "ts", "stream-dedup")


@query(
    "stream_hourly",
    f"""SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS events, {d('SUM(' + m('value') + ')')} AS total FROM events
GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    rows, close = S.with_end_mark(stream(t), "ts")
    hourly = S.tumbling(
        rows, "ts", "1 hour", DELAY, ["event_type"], events=F.count(F.lit(1)), total=F.sum(amount("value"))
    )
    return S.run_append(hourly, "stream-hourly", close)


@query(
    "stream_sessions",
    """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) <= 43200000000 THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g),
a AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS events FROM s GROUP BY user_id, no)
SELECT * FROM a""",
)
def _(t: Tables) -> DataFrame:
    rows, close = S.with_end_mark(stream(t), "ts")
    sessions = S.gap_sessions(rows, ["user_id"], "ts", "12 hours", DELAY, events=F.count(F.lit(1)))
    return S.run_append(sessions, "stream-sessions", close)


@query(
    "stream_latest_status",
    "SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS latest_status, COUNT(*) AS event_count, MIN(ts) AS first_event, MAX(ts) AS last_event FROM events GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    found = keep_latest(stream(t), ["user_id"], "ts", "event_id", "event_type", "stream-status")
    return found.select("user_id", "latest_status", "event_count", "first_event", "last_event")


@query("stream_timeline_status", TIMELINE_SQL)
def _(t: Tables) -> DataFrame:
    """The shipment timelines of the batch form, kept up to date by a stream."""
    events = shipment_events(stream(t))
    found = keep_latest(
        events, ["shipment_id"], "event_time", "event_id", "event_type", "stream-timeline", ["delivered_at"], ["promised_at"]
    )
    return timeline_columns(found)


@query(
    "stream_multi_source",
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'firewall' WHEN event_type IN ('signup', 'purchase') THEN 'ids' ELSE 'endpoint' END AS source,
  COUNT(*) AS alerts, COUNT(DISTINCT user_id) AS addresses FROM events GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Three feeds with different columns as one stream."""
    rows = stream(t).select("event_id", "user_id", "event_type", "ts", "value")
    kind = F.col("event_type")
    firewall = rows.filter(kind.isin("view", "click")).withColumn("source", F.lit("firewall"))
    ids = rows.filter(kind.isin("signup", "purchase")).drop("value").withColumn("source", F.lit("ids"))
    endpoint = rows.filter(~kind.isin("view", "click", "signup", "purchase")).withColumn("source", F.lit("endpoint"))
    stored = S.run_append(S.unite(firewall, ids, endpoint), "stream-sources")
    return stored.groupBy("source").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_distinct("user_id").alias("addresses")
    )
