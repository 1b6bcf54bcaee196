"""Incremental loads and schema evolution over the event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.numeric import amount, rounded
from ..functions.temporal import seconds_between
from ..operators.evolve import add_columns, unify
from ..operators.incremental import (
    load_with_overlap, newer_key_and_date, newer_than, replace_touched, rows_of_touched, with_overlap,
)
from ..operators.timeline import Timeline
from ..operators.upsert import insert_absent
from ..sources.tables import Tables, read_ranges
from .registry import query
from .sqltext import d, m, n, r, sec

LOADED = "2024-01-20"


def loaded_events(t: Tables) -> DataFrame:
    """The events a previous run has stored; its purchases of the last days had not arrived yet."""
    on_time = F.col("ts") < F.lit(LOADED).cast("timestamp_ntz")
    late = (F.col("event_type") == "purchase") & (F.col("ts") >= F.lit("2024-01-18").cast("timestamp_ntz"))
    return t.events.filter(on_time & ~late)


LOADED_SQL = f"""
stored AS (SELECT * FROM events WHERE ts < TIMESTAMP '{LOADED}'
           AND NOT (event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-18'))"""


@query(
    "range_split_read",
    f"""WITH b AS (SELECT MIN(o_orderkey) AS lo, (MAX(o_orderkey) - MIN(o_orderkey) + 8) // 8 AS step FROM orders)
SELECT {n("(o_orderkey - lo) // step")} AS part, COUNT(*) AS orders, {d('SUM(' + m('o_totalprice') + ')')} AS total, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
FROM orders CROSS JOIN b GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Orders read in eight ranges of their key, as a table of a database would be."""
    return read_ranges(t.spark, f"{t.root}/orders.parquet", "o_orderkey", 8).groupBy("part").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(amount("o_totalprice")).alias("total"),
        F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"),
    )


@query("incremental_watermark", f"WITH {LOADED_SQL} SELECT event_id, ts FROM events WHERE ts > (SELECT MAX(ts) FROM stored)")
def _(t: Tables) -> DataFrame:
    return newer_than(t.events, loaded_events(t), "ts").select("event_id", "ts")


@query(
    "incremental_key_and_date",
    f"""WITH {LOADED_SQL} SELECT event_id, ts FROM events WHERE event_id > (SELECT MAX(event_id) FROM stored)
AND ts > (SELECT MAX(ts) FROM stored) - INTERVAL 3 DAY""",
)
def _(t: Tables) -> DataFrame:
    return newer_key_and_date(t.events, loaded_events(t), "event_id", "ts", 3).select("event_id", "ts")


@query("incremental_first_load", "SELECT event_type, COUNT(*) AS events FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    nothing = t.events.filter("event_id IS NULL")
    return newer_key_and_date(t.events, nothing, "event_id", "ts", 3).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


@query("incremental_overlap", "SELECT event_id, ts, user_id, event_type FROM events")
def _(t: Tables) -> DataFrame:
    stored = loaded_events(t)
    return load_with_overlap(stored, t.events, ["event_id"], "ts", 3).select("event_id", "ts", "user_id", "event_type")


@query("incremental_append", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables) -> DataFrame:
    stored = loaded_events(t)
    arrived = with_overlap(t.events, stored, "ts", 7)
    return insert_absent(stored, arrived, ["event_id"]).select("event_id", "user_id", "event_type")


def user_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum(amount("value")).alias("total"), F.max("ts").alias("last_seen")
    )


@query(
    "touched_keys_recompute",
    f"SELECT user_id, COUNT(*) AS events, {d('SUM(' + m('value') + ')')} AS total, MAX(ts) AS last_seen FROM events GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    stored = loaded_events(t)
    arrived = t.events.join(stored.select("event_id"), "event_id", "left_anti")
    again = user_totals(rows_of_touched(t.events, arrived, ["user_id"]))
    return replace_touched(user_totals(stored), again, arrived, ["user_id"])


@query(
    "incremental_enrichment",
    f"""WITH {LOADED_SQL},
g AS (SELECT event_id, user_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
SELECT event_id, user_id, {r(sec('ts', 'prev'), 3)} AS seconds_since_prev FROM g WHERE event_id NOT IN (SELECT event_id FROM stored)""",
)
def _(t: Tables) -> DataFrame:
    stored = loaded_events(t)
    arrived = t.events.join(stored.select("event_id"), "event_id", "left_anti")
    # new rows see the stored history of their key
    both = rows_of_touched(stored, arrived, ["user_id"]).withColumn("is_new", F.lit(False)).unionByName(
        arrived.withColumn("is_new", F.lit(True))
    )
    line = Timeline(both, ["user_id"], ["ts", "event_id"], profile=t.events.select("user_id", "ts", "event_id"))
    rows = line.near(before=1, prev=lambda w: F.lag("ts").over(w)).rows.filter("is_new")
    return rows.select("event_id", "user_id", rounded(seconds_between("ts", "prev"), 3).alias("seconds_since_prev"))


@query(
    "schema_add_column",
    """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS coupon FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
)
def _(t: Tables) -> DataFrame:
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    old = add_columns(t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey"), {"coupon": "string"})
    new = t.orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", F.col("o_orderpriority").alias("coupon"))
    return old.unionByName(new)


def call_feeds(t: Tables) -> list:
    """Three feeds with growing columns, split by event type."""
    e = t.events
    seconds = F.ceil(F.col("value")).cast("int")
    base = [F.col("event_id").alias("call_id"), F.col("user_id").alias("caller"), F.col("ts").alias("start_time")]
    v1 = e.filter("event_type IN ('view', 'click')").select(*base, seconds.alias("duration_sec"))
    v2 = e.filter("event_type IN ('signup', 'purchase')").select(
        *base, seconds.alias("duration_sec"),
        F.when(F.col("event_type") == "signup", "sms").otherwise("data").alias("call_type"),
        amount("value").alias("data_usage_mb"),
        F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("sms_count"),
    )
    v3 = e.filter("event_type = 'error'").select(
        *base, seconds.cast("bigint").alias("duration_sec"), F.lit("voice").alias("call_type"),
        amount("value").alias("data_usage_mb"), F.lit(0).alias("sms_count"),
        F.when(F.col("value") > 50, "5G").otherwise("4G").alias("network_type"),
        (F.col("value") > 100).alias("roaming_flag"),
    )
    return [
        (1, v1, {"call_type": "voice", "data_usage_mb": 0, "sms_count": 0, "roaming_flag": False}),
        (2, v2, {"roaming_flag": False}),
        (3, v3, {}),
    ]


CALL_SCHEMA = (
    "call_id bigint, caller bigint, start_time timestamp_ntz, duration_sec bigint, call_type string, "
    "data_usage_mb decimal(18,2), sms_count int, network_type string, roaming_flag boolean"
)


def unified_calls(t: Tables) -> DataFrame:
    """One superset of the three feeds, rated."""
    return rate_calls(unify(call_feeds(t), StructType.fromDDL(CALL_SCHEMA)))


def stored_calls(t: Tables) -> DataFrame:
    """The unified table in one pass, for reports that start from it."""
    kind = F.col("event_type")
    old, error, sms = kind.isin("view", "click"), kind == "error", kind == "signup"
    return rate_calls(
        t.events.select(
            F.col("event_id").alias("call_id"),
            F.col("user_id").alias("caller"),
            F.col("ts").alias("start_time"),
            F.ceil("value").cast("bigint").alias("duration_sec"),
            F.when(sms, "sms").when(kind == "purchase", "data").otherwise("voice").alias("call_type"),
            F.when(old, 0).otherwise(amount("value")).cast("decimal(18,2)").alias("data_usage_mb"),
            F.when(sms, 1).otherwise(0).alias("sms_count"),
            F.when(error, F.when(F.col("value") > 50, "5G").otherwise("4G")).alias("network_type"),
            (error & (F.col("value") > 100)).alias("roaming_flag"),
            F.when(old, 1).when(error, 3).otherwise(2).alias("schema_version"),
            F.get_json_object("props", "$.k").cast("bigint").alias("callee"),
        )
    )


def rate_calls(calls: DataFrame) -> DataFrame:
    """Revenue (0.01/s voice, 0.01/MB data, 0.05/SMS) and drop flag below ten seconds."""
    cent = F.lit("0.01").cast("decimal(4,2)")
    revenue = (
        F.when(F.col("call_type") == "sms", F.col("sms_count") * F.lit("0.05").cast("decimal(4,2)"))
        .when(F.col("call_type") == "data", F.col("data_usage_mb") * cent)
        .otherwise(F.col("duration_sec") * cent)
    )
    return calls.withColumns(
        {
            "revenue": revenue.cast("decimal(18,4)"),
            "drop_flag": F.coalesce((F.col("call_type") == "voice") & (F.col("duration_sec") < 10), F.lit(False)),
        }
    )


CALLS_SQL = """
calls AS (
  SELECT event_id AS call_id, user_id AS caller, ts AS start_time, CAST(ceil(value) AS BIGINT) AS duration_sec, event_type,
    CASE WHEN event_type = 'signup' THEN 'sms' WHEN event_type = 'purchase' THEN 'data' ELSE 'voice' END AS call_type,
    CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS data_usage_mb,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS sms_count,
    CASE WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN '5G' ELSE '4G' END END AS network_type,
    event_type = 'error' AND value > 100 AS roaming_flag,
    CASE WHEN event_type IN ('view', 'click') THEN 1 WHEN event_type = 'error' THEN 3 ELSE 2 END AS schema_version,
    CAST(CASE WHEN event_type = 'signup' THEN 0.05 WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) * 0.01
         ELSE CAST(ceil(value) AS BIGINT) * 0.01 END AS DECIMAL(18,4)) AS revenue,
    event_type IN ('view', 'click', 'error') AND ceil(value) < 10 AS drop_flag
  FROM events)"""


@query(
    "schema_union",
    f"""WITH {CALLS_SQL}
SELECT call_id, caller, start_time, duration_sec, call_type, {d('data_usage_mb')} AS data_usage_mb, {n('sms_count')} AS sms_count,
       network_type, roaming_flag, {n('schema_version')} AS schema_version, {d('revenue')} AS revenue, drop_flag FROM calls""",
)
def _(t: Tables) -> DataFrame:
    return unified_calls(t)
