"""Subscriber profiles, call sessions, network quality and churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag_sum, money, percent, points, ratio
from ..functions.temporal import days_between
from ..operators.aggregates import distinct_list
from ..operators.joins import by_participant
from ..operators.sessions import number_sessions
from ..sources.tables import Tables
from .loading import CALLS_SQL, stored_calls
from .registry import query
from .sqltext import d, n, pct, ratio as sql_ratio

AS_OF = "2024-02-15"


def subscriber_profiles(subscribers: DataFrame, calls: DataFrame, as_of: str) -> DataFrame:
    """Usage of each subscriber as caller or callee, drop rate, recency and trend.

    The trend compares the latest feed version with the one before; without
    both it is -25.
    """
    voice = F.col("call_type") == "voice"
    v3, v2 = flag_sum(F.col("schema_version") == 3), flag_sum(F.col("schema_version") == 2)
    # summed per number before the join: a number that is in every call is one row there
    usage = by_participant(calls, "subscriber_id", "caller", "callee").groupBy("subscriber_id").agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.sum("data_usage_mb").alias("total_data_mb"),
        F.sum("sms_count").alias("total_sms"),
        F.sum("revenue").alias("total_revenue"),
        ratio(flag_sum(F.col("drop_flag")), flag_sum(voice), 4, default=0).alias("drop_rate"),
        F.max(F.when(voice, F.col("start_time"))).alias("_last_call"),
        F.max("start_time").alias("last_activity"),
        percent(v3 - v2, F.when(v3 > 0, v2).otherwise(0), default=-25).alias("usage_trend"),
    )
    zero = F.lit(0)
    return subscribers.join(usage, "subscriber_id", "left").select(
        *subscribers.columns,
        F.coalesce("total_calls", zero).cast("bigint").alias("total_calls"),
        F.coalesce("total_data_mb", zero).cast("double").alias("total_data_mb"),
        F.coalesce("total_sms", zero).cast("bigint").alias("total_sms"),
        F.coalesce("total_revenue", zero).cast("double").alias("total_revenue"),
        F.coalesce("drop_rate", F.lit(0.0)).alias("drop_rate"),
        days_between(F.to_date(F.lit(as_of)), "_last_call").alias("days_since_last_call"),
        F.coalesce("usage_trend", F.lit(-25.0)).alias("usage_trend"),
        "last_activity",
    )


def churn_scores(profiles: DataFrame) -> DataFrame:
    """40 no call for 30 days, 30 falling usage, 20 dropped calls, 10 prepaid and nearly empty."""
    score = points(
        [
            (F.col("days_since_last_call") > 30, 40),
            (F.col("usage_trend") < -20, 30),
            (F.col("drop_rate") > 0.10, 20),
            ((F.col("plan_type") == "prepaid") & (F.col("balance") < 5), 10),
        ]
    )
    level = (
        F.when(F.col("status") == "churned", "CHURNED")
        .when(F.col("status") == "suspended", "CRITICAL")
        .when(F.col("churn_score") >= 70, "HIGH")
        .when(F.col("churn_score") >= 40, "MEDIUM")
        .otherwise("LOW")
    )
    return profiles.withColumn("churn_score", score).withColumn("churn_level", level)


def call_sessions(calls: DataFrame, gap_seconds: float = 1800) -> DataFrame:
    """Sessions per caller with the services used; a pause counts from the end of the call before."""
    numbered = number_sessions(calls, ["caller"], "start_time", gap_seconds, ["call_id"], end="end_time")
    number = F.lpad(F.col("session_no").cast("string"), 4, "0")
    return (
        numbered.groupBy("caller", "session_no")
        .agg(
            F.min("start_time").alias("session_start"),
            F.max(F.coalesce("end_time", "start_time")).alias("session_end"),
            F.count(F.lit(1)).alias("event_count"),
            F.coalesce(F.sum("duration_sec"), F.lit(0)).alias("total_duration"),
            distinct_list(F.col("call_type")).alias("call_types"),
            flag_sum(F.col("drop_flag")).alias("drop_events"),
        )
        .withColumn("session_id", F.concat(F.col("caller").cast("string"), F.lit("-S"), number))
        .drop("session_no")
    )


def network_quality(calls: DataFrame, by: list[Column]) -> DataFrame:
    whole, drops = F.count(F.lit(1)), flag_sum(F.col("drop_flag"))
    voice, data = F.col("call_type") == "voice", F.col("call_type") == "data"
    return calls.groupBy(*by).agg(
        whole.alias("total_calls"),
        drops.alias("dropped_calls"),
        ratio(drops, whole, 4, default=0).alias("drop_rate"),
        ratio(F.sum(F.when(voice, F.col("duration_sec"))), flag_sum(voice), 1).alias("avg_duration"),
        F.sum("data_usage_mb").alias("total_data_mb"),
        ratio(F.sum("data_usage_mb"), flag_sum(data), 2, default=0).alias("avg_throughput_mb"),
        flag_sum(F.col("roaming_flag")).alias("roaming_calls"),
        flag_sum(F.col("network_type") == "5G").alias("fiveg_calls"),
        F.sum("revenue").alias("revenue"),
    )


# stand-ins: customers as subscribers, events as calls; the callee is the number in the event's props


def calls_with_callee(t: Tables) -> DataFrame:
    calls = stored_calls(t)
    ends = F.when(
        F.col("call_type") == "voice", F.col("start_time") + F.make_dt_interval(secs=F.col("duration_sec").cast("decimal(18,6)"))
    )
    return calls.withColumn("end_time", ends)


def customer_subscribers(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.select(
        F.col("c_custkey").alias("subscriber_id"),
        F.when(balance < 3000, "prepaid").otherwise("postpaid").alias("plan_type"),
        F.col("c_mktsegment").alias("plan_tier"),
        money(balance / 100).alias("balance"),
        F.when(balance < 0, "churned").when(balance < 300, "suspended").otherwise("active").alias("status"),
    )


TELCO_SQL = f"""{CALLS_SQL},
cc AS (SELECT c.*, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS callee, CASE WHEN call_type = 'voice' THEN start_time + duration_sec * INTERVAL 1 SECOND END AS end_time
  FROM calls c JOIN events e ON c.call_id = e.event_id),
subs AS (SELECT c_custkey AS subscriber_id, CASE WHEN c_acctbal < 3000 THEN 'prepaid' ELSE 'postpaid' END AS plan_type, c_mktsegment AS plan_tier, CAST(c_acctbal / 100 AS DECIMAL(18,2)) AS balance,
  CASE WHEN c_acctbal < 0 THEN 'churned' WHEN c_acctbal < 300 THEN 'suspended' ELSE 'active' END AS status FROM customer),
prof AS (SELECT s.*, COUNT(call_id) AS total_calls, COALESCE(SUM(data_usage_mb), 0) AS total_data_mb, COALESCE(SUM(sms_count), 0) AS total_sms, COALESCE(SUM(revenue), 0) AS total_revenue,
  COALESCE({sql_ratio('COUNT(CASE WHEN drop_flag THEN 1 END)', "COUNT(CASE WHEN call_type = 'voice' THEN 1 END)", 4)}, 0) AS drop_rate,
  date_diff('day', MAX(CASE WHEN call_type = 'voice' THEN start_time END), TIMESTAMP '{AS_OF}') AS days_since_last_call,
  CASE WHEN COUNT(CASE WHEN schema_version = 3 THEN 1 END) > 0 AND COUNT(CASE WHEN schema_version = 2 THEN 1 END) > 0
    THEN {pct('(COUNT(CASE WHEN schema_version = 3 THEN 1 END) - COUNT(CASE WHEN schema_version = 2 THEN 1 END))', 'COUNT(CASE WHEN schema_version = 2 THEN 1 END)')} ELSE -25.0 END AS usage_trend,
  MAX(start_time) AS last_activity FROM subs s LEFT JOIN cc ON subscriber_id = caller OR subscriber_id = callee GROUP BY ALL),
scored AS (SELECT *, CASE WHEN days_since_last_call > 30 THEN 40 ELSE 0 END + CASE WHEN usage_trend < -20 THEN 30 ELSE 0 END + CASE WHEN drop_rate > 0.10 THEN 20 ELSE 0 END
  + CASE WHEN plan_type = 'prepaid' AND balance < 5 THEN 10 ELSE 0 END AS score FROM prof)"""


@query(
    "subscriber_profile_or_join",
    f"""WITH {TELCO_SQL} SELECT subscriber_id, total_calls, {d('total_data_mb')} AS total_data_mb, {n('total_sms')} AS total_sms, {d('total_revenue')} AS total_revenue, {d('drop_rate')} AS drop_rate,
  {n('days_since_last_call')} AS days_since_last_call, {d('usage_trend')} AS usage_trend, last_activity FROM prof""",
)
def _(t: Tables) -> DataFrame:
    return subscriber_profiles(customer_subscribers(t), calls_with_callee(t), AS_OF).drop(
        "plan_type", "plan_tier", "balance", "status"
    )


@query(
    "churn_score",
    f"""WITH {TELCO_SQL} SELECT subscriber_id, plan_type, status, {n('score')} AS churn_score, CASE WHEN status = 'churned' THEN 'CHURNED' WHEN status = 'suspended' THEN 'CRITICAL'
  WHEN score >= 70 THEN 'HIGH' WHEN score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS churn_level FROM scored""",
)
def _(t: Tables) -> DataFrame:
    scored = churn_scores(subscriber_profiles(customer_subscribers(t), calls_with_callee(t), AS_OF))
    return scored.select("subscriber_id", "plan_type", "status", "churn_score", "churn_level")


@query(
    "call_sessions_list",
    f"""WITH {TELCO_SQL},
g AS (SELECT *, CASE WHEN epoch_us(start_time) - epoch_us(LAG(COALESCE(end_time, start_time)) OVER (PARTITION BY caller ORDER BY start_time, call_id)) <= 43200000000 THEN 0 ELSE 1 END AS brk FROM cc),
s AS (SELECT *, CAST(SUM(brk) OVER (PARTITION BY caller ORDER BY start_time, call_id) AS BIGINT) AS no FROM g)
SELECT CAST(caller AS VARCHAR) || '-S' || lpad(CAST(no AS VARCHAR), 4, '0') AS session_id, caller, MIN(start_time) AS session_start, MAX(COALESCE(end_time, start_time)) AS session_end, COUNT(*) AS event_count,
  {n('COALESCE(SUM(duration_sec), 0)')} AS total_duration, string_agg(DISTINCT call_type, ',' ORDER BY call_type) AS call_types, COUNT(CASE WHEN drop_flag THEN 1 END) AS drop_events FROM s GROUP BY caller, no""",
)
def _(t: Tables) -> DataFrame:
    return call_sessions(calls_with_callee(t), gap_seconds=43200)


_QUALITY = f"""COUNT(*) AS total_calls, COUNT(CASE WHEN drop_flag THEN 1 END) AS dropped_calls, {sql_ratio('COUNT(CASE WHEN drop_flag THEN 1 END)', 'COUNT(*)', 4)} AS drop_rate,
  {sql_ratio("SUM(CASE WHEN call_type = 'voice' THEN duration_sec END)", "COUNT(CASE WHEN call_type = 'voice' THEN 1 END)", 1)} AS avg_duration, {d('SUM(data_usage_mb)')} AS total_data_mb,
  COALESCE({sql_ratio('SUM(data_usage_mb)', "COUNT(CASE WHEN call_type = 'data' THEN 1 END)", 2)}, 0) AS avg_throughput_mb, COUNT(CASE WHEN roaming_flag THEN 1 END) AS roaming_calls,
  COUNT(CASE WHEN network_type = '5G' THEN 1 END) AS fiveg_calls, {d('SUM(revenue)')} AS revenue"""


def placed_calls(t: Tables) -> DataFrame:
    regions = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return stored_calls(t).join(
        regions.select("c_custkey", F.col("r_name").alias("region"), "n_name", "c_mktsegment"), F.col("caller") == F.col("c_custkey")
    )


PLACED_SQL = f"{CALLS_SQL}, placed AS (SELECT c.*, r_name AS region, n_name, c_mktsegment FROM calls c JOIN customer ON caller = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@query(
    "quality_by_region_hour",
    f"WITH {PLACED_SQL} SELECT region, {n('hour(start_time)')} AS hour_bucket, {_QUALITY} FROM placed GROUP BY 1, 2",
)
def _(t: Tables) -> DataFrame:
    return network_quality(placed_calls(t), [F.col("region"), F.hour("start_time").alias("hour_bucket")])


@query(
    "peak_quality",
    f"WITH {PLACED_SQL} SELECT CASE WHEN hour(start_time) BETWEEN 7 AND 22 THEN 'Peak' ELSE 'Off-Peak' END AS period, {_QUALITY} FROM placed GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    period = F.when(F.hour("start_time").between(7, 22), "Peak").otherwise("Off-Peak")
    return network_quality(placed_calls(t), [period.alias("period")])


@query(
    "utilization_rank",
    f"""WITH {PLACED_SQL} SELECT n_name AS tower, region, COUNT(*) AS total_calls, {d('SUM(data_usage_mb)')} AS total_data_mb, COUNT(CASE WHEN drop_flag THEN 1 END) AS drops,
  {n('RANK() OVER (ORDER BY COUNT(*) DESC)')} AS utilization_rank FROM placed GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    towers = placed_calls(t).groupBy(F.col("n_name").alias("tower"), "region").agg(
        F.count(F.lit(1)).alias("total_calls"), F.sum("data_usage_mb").alias("total_data_mb"),
        flag_sum(F.col("drop_flag")).alias("drops"),
    )
    # one row per tower
    return towers.withColumn("utilization_rank", F.rank().over(Window.orderBy(F.col("total_calls").desc())))


@query(
    "revenue_by_plan",
    f"""WITH {PLACED_SQL} SELECT c_mktsegment AS plan_tier, COUNT(*) AS call_count, {d('SUM(revenue)')} AS total_revenue, {sql_ratio('SUM(duration_sec)', 'COUNT(*)', 1)} AS avg_duration,
  COUNT(CASE WHEN roaming_flag THEN 1 END) AS roaming_calls, COUNT(CASE WHEN schema_version = 3 THEN 1 END) AS latest_feed_calls FROM placed WHERE call_type = 'voice' GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return (
        placed_calls(t)
        .filter("call_type = 'voice'")
        .groupBy(F.col("c_mktsegment").alias("plan_tier"))
        .agg(
            F.count(F.lit(1)).alias("call_count"), F.sum("revenue").alias("total_revenue"),
            ratio(F.sum("duration_sec"), F.count(F.lit(1)), 1).alias("avg_duration"),
            flag_sum(F.col("roaming_flag")).alias("roaming_calls"),
            flag_sum(F.col("schema_version") == 3).alias("latest_feed_calls"),
        )
    )
