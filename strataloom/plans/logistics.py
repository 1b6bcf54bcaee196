"""Shipment timelines, SLA penalties, routes and delivery KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, haversine_km, percent, planar_km, ratio, rounded
from ..functions.temporal import days_between, seconds_between
from ..operators.timeline import Timeline
from ..operators.upsert import insert_absent
from ..sources.tables import Tables, inline_rows
from .registry import query
from .sqltext import d, m, n, pct, r, ratio as sql_ratio, sec


def shipment_timelines(events: DataFrame) -> DataFrame:
    """Latest and previous status, hours in the last stage and in total, per shipment."""
    line = Timeline(
        events, ["shipment_id"], ["event_time", "event_id"], profile=events.select("shipment_id", "event_time", "event_id")
    ).near(
        before=1, _status=lambda w: F.lag("event_type").over(w), _time=lambda w: F.lag("event_time").over(w)
    )
    latest = F.struct(
        F.col("event_type").alias("latest_status"), F.col("_status").alias("previous_status"),
        F.col("event_time").alias("latest_at"), F.col("_time").alias("previous_at"),
    )
    grouped = line.rows.groupBy("shipment_id").agg(
        F.max_by(latest, F.struct("event_time", "event_id")).alias("_last"),
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.max("delivered_at").alias("delivered_at"),
        F.min("promised_at").alias("promised_at"),
    )
    return timeline_columns(grouped.select("*", "_last.*"))


def timeline_columns(grouped: DataFrame) -> DataFrame:
    """Timelines from the last two events of a shipment and its first, last, promised and delivery times."""
    return grouped.select(
        "shipment_id",
        "latest_status",
        "previous_status",
        "event_count",
        rounded(seconds_between("latest_at", "previous_at") / 3600, 2).alias("hours_in_last_stage"),
        rounded(seconds_between("last_event", "first_event") / 3600, 2).alias("total_hours"),
        (F.col("delivered_at") <= F.col("promised_at")).alias("on_time"),
    )


def sla_violations(shipments: DataFrame, contracts: DataFrame) -> DataFrame:
    """Days over the contract of carrier and service level, and the penalty."""
    joined = shipments.filter(F.col("transit_days").isNotNull()).join(
        contracts, ["carrier_id", "service_level"]
    )
    over = F.greatest(F.col("transit_days") - F.col("max_days"), F.lit(0))
    return joined.withColumns(
        {"days_over": over, "penalty": over * F.col("penalty_per_day"), "violated": over > 0}
    )


# stand-ins


def shipment_events(events: DataFrame) -> DataFrame:
    """Events as shipment events of a user."""
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("user_id").alias("shipment_id"),
        kind,
        F.col("ts").alias("event_time"),
        F.when(kind == "purchase", F.col("ts")).alias("delivered_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(29))).alias("promised_at"),
    )


def tracking(t: Tables) -> DataFrame:
    """Shipment events, arriving twice and deduplicated on their key."""
    events = shipment_events(t.events)
    empty = events.filter("event_id IS NULL")
    return insert_absent(empty, events.unionByName(events), ["shipment_id", "event_type", "event_time"])


TIMELINE_SQL = f"""WITH g AS (SELECT *, LAG(event_type) OVER w AS ps, LAG(ts) OVER w AS pt, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
  COUNT(*) OVER (PARTITION BY user_id) AS k, MIN(ts) OVER (PARTITION BY user_id) AS f, MAX(ts) OVER (PARTITION BY user_id) AS l,
  MAX(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id) AS del FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id AS shipment_id, event_type AS latest_status, ps AS previous_status, k AS event_count, {r(sec('ts', 'pt') + ' / 3600', 2)} AS hours_in_last_stage,
  {r(sec('l', 'f') + ' / 3600', 2)} AS total_hours, del <= f + INTERVAL 29 DAY AS on_time FROM g WHERE rn = 1"""


@query("timeline_status", TIMELINE_SQL)
def _(t: Tables) -> DataFrame:
    return shipment_timelines(tracking(t))


# fixed values: allowed days and penalty per day by carrier and service level
CONTRACTS = [
    (carrier, level, 200 + 100 * c + 50 * k, 5 * (k + 1))
    for c, carrier in enumerate(("F", "O", "P"))
    for k, level in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
]
_CONTRACT_SQL = ", ".join(f"('{a}', '{b}', {c}, {e})" for a, b, c, e in CONTRACTS)


def order_shipments(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_last"), F.sum(amount("l_extendedprice")).alias("revenue"),
        F.sum("l_quantity").cast("bigint").alias("weight"),
    )
    days = days_between("_last", "o_orderdate")
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("carrier_id"),
        F.col("o_orderpriority").alias("service_level"),
        F.col("o_orderdate").alias("ship_date"),
        F.when(days >= 0, days).alias("transit_days"),
        amount("o_totalprice").alias("cost"),
        "revenue",
        "weight",
    )


def contracts(t: Tables) -> DataFrame:
    schema = "carrier_id string, service_level string, max_days int, penalty_per_day int"
    return inline_rows(t.spark, schema, CONTRACTS)


SHIP_SQL = f"""
con AS (SELECT * FROM (VALUES {_CONTRACT_SQL}) AS x(carrier_id, service_level, max_days, penalty_per_day)),
ship AS (SELECT o_orderkey AS shipment_id, o_custkey AS customer_id, o_orderstatus AS carrier_id, o_orderpriority AS service_level, o_orderdate AS ship_date,
  CASE WHEN mx >= o_orderdate THEN date_diff('day', o_orderdate, mx) END AS transit_days, {m('o_totalprice')} AS cost, rev AS revenue, w AS weight
  FROM orders JOIN (SELECT l_orderkey, MAX(l_shipdate) AS mx, SUM({m('l_extendedprice')}) AS rev, CAST(SUM(l_quantity) AS BIGINT) AS w FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
sla AS (SELECT s.*, max_days, GREATEST(transit_days - max_days, 0) AS days_over, GREATEST(transit_days - max_days, 0) * penalty_per_day AS penalty
  FROM ship s JOIN con USING (carrier_id, service_level) WHERE transit_days IS NOT NULL)"""


@query(
    "sla_violations",
    f"""WITH {SHIP_SQL} SELECT shipment_id, carrier_id, service_level, {n('max_days')} AS max_days, {n('transit_days')} AS transit_days,
  {n('days_over')} AS days_over, {n('penalty')} AS penalty, days_over > 0 AS violated FROM sla""",
)
def _(t: Tables) -> DataFrame:
    return sla_violations(order_shipments(t), contracts(t)).select(
        "shipment_id", "carrier_id", "service_level", "max_days", "transit_days", "days_over", "penalty", "violated"
    )


@query(
    "sla_kpi",
    f"""WITH {SHIP_SQL}
SELECT carrier_id, service_level, strftime(ship_date, '%Y-%m') AS month, COUNT(*) AS shipments, COUNT(CASE WHEN days_over > 0 THEN 1 END) AS violated_count,
  {pct('COUNT(CASE WHEN days_over > 0 THEN 1 END)', 'COUNT(*)')} AS violation_rate, {n('SUM(penalty)')} AS total_penalty,
  {sql_ratio('SUM(days_over)', 'COUNT(CASE WHEN days_over > 0 THEN 1 END)', 1)} AS avg_days_over, {n('MAX(days_over)')} AS worst_violation FROM sla GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    whole, hit = F.count(F.lit(1)), flag_sum(F.col("violated"))
    rows = sla_violations(order_shipments(t), contracts(t))
    return rows.groupBy("carrier_id", "service_level", F.date_format("ship_date", "yyyy-MM").alias("month")).agg(
        whole.alias("shipments"),
        hit.alias("violated_count"),
        percent(hit, whole).alias("violation_rate"),
        F.sum("penalty").alias("total_penalty"),
        ratio(F.sum("days_over"), hit, 1).alias("avg_days_over"),
        F.max("days_over").alias("worst_violation"),
    )


@query(
    "shipment_fact",
    f"""WITH {SHIP_SQL}
SELECT s.shipment_id, s.customer_id, {d('s.revenue - s.cost')} AS margin, {n('s.transit_days')} AS transit_days, COALESCE(v.days_over > 0, FALSE) AS sla_violated,
  {n('COALESCE(v.penalty, 0)')} AS penalty FROM ship s LEFT JOIN sla v USING (shipment_id)""",
)
def _(t: Tables) -> DataFrame:
    ships = order_shipments(t)
    broken = sla_violations(ships, contracts(t)).select("shipment_id", "violated", "penalty")
    return ships.join(broken, "shipment_id", "left").select(
        "shipment_id", "customer_id", (F.col("revenue") - F.col("cost")).alias("margin"), "transit_days",
        F.coalesce("violated", F.lit(False)).alias("sla_violated"), F.coalesce("penalty", F.lit(0)).alias("penalty"),
    )


@query(
    "delivery_kpi",
    f"""WITH {SHIP_SQL}
SELECT carrier_id, n_name AS destination, strftime(ship_date, '%Y-%m') AS month, COUNT(*) AS shipments, COUNT(CASE WHEN transit_days <= 365 THEN 1 END) AS on_time_count,
  {pct('COUNT(CASE WHEN transit_days <= 365 THEN 1 END)', 'COUNT(*)')} AS on_time_pct, {sql_ratio('SUM(transit_days)', 'COUNT(transit_days)', 1)} AS avg_transit_days,
  {sql_ratio('SUM(cost)', 'SUM(weight)', 2)} AS cost_per_kg, {n('SUM(weight)')} AS total_weight, {d('SUM(revenue - cost)')} AS total_margin
FROM ship JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    places = t.customer.select("c_custkey", "c_nationkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = order_shipments(t).join(places.select("c_custkey", "n_name"), F.col("customer_id") == F.col("c_custkey"))
    whole, good = F.count(F.lit(1)), flag_sum(F.col("transit_days") <= 365)
    return rows.groupBy(
        "carrier_id", F.col("n_name").alias("destination"), F.date_format("ship_date", "yyyy-MM").alias("month")
    ).agg(
        whole.alias("shipments"),
        good.alias("on_time_count"),
        percent(good, whole).alias("on_time_pct"),
        ratio(F.sum("transit_days"), F.count("transit_days"), 1).alias("avg_transit_days"),
        ratio(F.sum("cost"), F.sum("weight"), 2).alias("cost_per_kg"),
        F.sum("weight").alias("total_weight"),
        F.sum(F.col("revenue") - F.col("cost")).alias("total_margin"),
    )


@query(
    "route_distance",
    f"""WITH f AS (SELECT s_nationkey AS a, c_nationkey AS b, COUNT(*) AS shipments, SUM(CASE WHEN l_shipdate >= o_orderdate THEN date_diff('day', o_orderdate, l_shipdate) END) AS ds,
  COUNT(CASE WHEN l_shipdate >= o_orderdate THEN 1 END) AS dk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
g AS (SELECT *, a * 5 - 60 AS la, a * 13 - 150 AS lo, b * 5 - 60 AS lb, b * 13 - 150 AS lp FROM f)
SELECT CAST(a AS VARCHAR) || '->' || CAST(b AS VARCHAR) AS route_key, shipments, {sql_ratio('ds', 'dk', 1)} AS avg_transit_days,
  {n('floor(111.0 * sqrt(power(la - lb, 2) + power((lo - lp) * cos(radians((la + lb) / 2.0)), 2)))')} AS planar_km,
  {n('floor(2 * 6371.0 * asin(sqrt(power(sin(radians(lb - la) / 2), 2) + cos(radians(la)) * cos(radians(lb)) * power(sin(radians(lp - lo) / 2), 2))))')} AS sphere_km FROM g""",
)
def _(t: Tables) -> DataFrame:
    days = days_between("l_shipdate", "o_orderdate")
    buyers = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    flows = (
        t.lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            ratio(F.sum(F.when(days >= 0, days)), flag_sum(days >= 0), 1).alias("avg_transit_days"),
        )
    )
    a, b = F.col("s_nationkey"), F.col("c_nationkey")
    place = (a * 5 - 60, a * 13 - 150, b * 5 - 60, b * 13 - 150)
    return flows.select(
        F.concat(a.cast("string"), F.lit("->"), b.cast("string")).alias("route_key"),
        "shipments",
        "avg_transit_days",
        F.floor(planar_km(*place)).alias("planar_km"),
        F.floor(haversine_km(*place)).alias("sphere_km"),
    )
