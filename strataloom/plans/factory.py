"""Sensor readings: validation, shifts, anomalies and OEE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, money, percent, ratio, rounded
from ..functions.temporal import month_start, shift_of_day
from ..operators.timeline import Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import day, m, n, pct, r, ratio as sql_ratio

# fixed values: valid range by sensor type
RANGES = {"temperature": (-50, 500), "pressure": (0, 200), "vibration": (0, 50000), "rpm": (0, 20000)}
SHIFT_MINUTES = 480


def validate_readings(readings: DataFrame, ranges: dict = RANGES) -> DataFrame:
    """Shift, range flag by sensor type and quality score."""
    in_range = F.lit(False)
    for kind, (low, high) in ranges.items():
        in_range = in_range | ((F.col("sensor_type") == kind) & F.col("value").between(low, high))
    good = F.col("units_produced") - F.col("defect_units")
    return readings.withColumns(
        {
            "shift_id": shift_of_day("reading_time"),
            "in_range": F.coalesce(in_range, F.lit(False)),
            "quality_score": percent(good, "units_produced", default=100),
        }
    )


def equipment_status(readings: DataFrame) -> DataFrame:
    """Downtime, uptime and stops per line, day and shift."""
    down = F.coalesce(F.sum("downtime_min"), F.lit(0))
    return (
        readings.groupBy("plant_id", "line_name", F.col("reading_time").cast("date").alias("shift_date"), "shift_id")
        .agg(down.alias("downtime"), flag_sum(F.col("downtime_min") > 0).alias("stops"))
        .withColumn("uptime", F.lit(SHIFT_MINUTES) - F.col("downtime"))
        .withColumn(
            "status",
            F.when(F.col("downtime") == 0, "RUNNING").when(F.col("downtime") < 30, "DEGRADED").otherwise("IMPAIRED"),
        )
    )


def smooth_readings(readings: DataFrame, rows: int = 5, sigmas: float = 2.0) -> DataFrame:
    """Moving mean and deviation over the last readings of a sensor, and anomalies.

    A value cannot be more than (n-1)/sqrt(n) deviations from the mean of the n
    values it belongs to, which is 1.79 for five: with the default of two
    deviations a window of at least six rows is needed to flag anything.
    """

    def frame(w):
        return w.rowsBetween(-(rows - 1), 0)

    line = Timeline(
        readings, ["sensor_id"], ["reading_time", "reading_id"],
        profile=readings.select("sensor_id", "reading_time", "reading_id"),
    ).near(
        before=rows - 1,
        _sum=lambda w: F.sum(amount("value")).over(frame(w)),
        _n=lambda w: F.count(F.lit(1)).over(frame(w)),
        _dev=lambda w: F.stddev_samp("value").over(frame(w)),
    )
    smoothed = line.rows.withColumns(
        {"moving_avg": ratio("_sum", "_n", 2), "moving_stddev": rounded("_dev", 4)}
    ).drop("_sum", "_n", "_dev")
    distance = F.abs(F.col("value") - F.col("moving_avg"))
    flagged = F.coalesce((F.col("moving_stddev") > 0) & (distance > sigmas * F.col("moving_stddev")), F.lit(False))
    deviation = ratio(distance, "moving_stddev", 4)
    return smoothed.withColumn("anomaly", flagged).withColumn(
        "deviation", F.when(F.col("anomaly"), deviation)
    ).withColumn(
        "reason",
        F.when(
            F.col("anomaly"),
            F.concat(
                F.col("sensor_type"), F.lit(" anomaly: "), rounded("deviation", 1).cast("string"),
                F.lit(" sigma from the moving average"),
            ),
        ),
    )


def oee(readings: DataFrame, targets: DataFrame) -> DataFrame:
    """Availability x performance x quality per line, day and shift."""
    sums = readings.groupBy(
        "plant_id", "line_name", F.col("reading_time").cast("date").alias("shift_date"), "shift_id"
    ).agg(
        F.coalesce(F.sum("downtime_min"), F.lit(0)).alias("downtime"),
        F.sum("units_produced").alias("actual_units"),
        F.sum(F.col("units_produced") - F.col("defect_units")).alias("good_units"),
    )
    joined = sums.join(targets, ["plant_id", "line_name", "shift_id"], "left")
    return joined.withColumns(
        {
            "availability_pct": percent(F.lit(SHIFT_MINUTES) - F.col("downtime"), F.lit(SHIFT_MINUTES)),
            "performance_pct": percent("actual_units", "target_units", default=100),
            "quality_pct": percent("good_units", "actual_units", default=100),
        }
    ).withColumn(
        "oee_pct",
        rounded(F.col("availability_pct") * F.col("performance_pct") * F.col("quality_pct") / 10000, 2),
    )


# stand-ins: events as readings of a user's sensor in the plant of the customer segment


def event_readings(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    plants = t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("plant_id"), F.concat(F.lit("L"), F.col("c_nationkey")).alias("line_name")
    )
    rows = t.events.join(plants, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("sensor_id"),
        F.when(kind == "view", "temperature").when(kind == "click", "pressure").when(kind == "signup", "vibration")
        .when(kind == "purchase", "rpm").otherwise("unknown").alias("sensor_type"),
        "plant_id",
        "line_name",
        F.col("ts").alias("reading_time"),
        "value",
        k.alias("units_produced"),
        F.least(k, F.floor(F.col("value") / 40)).alias("defect_units"),
        F.when(kind == "error", F.floor(F.col("value") / 4)).otherwise(0).alias("downtime_min"),
    )
    return validate_readings(rows)


READ_SQL = f"""
reads AS (SELECT *, CASE WHEN hour(reading_time) >= 6 AND hour(reading_time) < 14 THEN 'SHIFT-AM' WHEN hour(reading_time) >= 14 AND hour(reading_time) < 22 THEN 'SHIFT-PM' ELSE 'SHIFT-NIGHT' END AS shift_id,
  CASE sensor_type WHEN 'temperature' THEN value BETWEEN -50 AND 500 WHEN 'pressure' THEN value BETWEEN 0 AND 200 WHEN 'vibration' THEN value BETWEEN 0 AND 50000
    WHEN 'rpm' THEN value BETWEEN 0 AND 20000 ELSE FALSE END AS in_range,
  COALESCE({pct('(units_produced - defect_units)', 'units_produced')}, 100) AS quality_score FROM (
  SELECT event_id AS reading_id, user_id AS sensor_id, CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'pressure' WHEN 'signup' THEN 'vibration' WHEN 'purchase' THEN 'rpm' ELSE 'unknown' END AS sensor_type,
    c_mktsegment AS plant_id, 'L' || c_nationkey AS line_name, ts AS reading_time, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS units_produced,
    LEAST(CAST(regexp_extract(props, '[0-9]+') AS BIGINT), CAST(floor(value / 40) AS BIGINT)) AS defect_units,
    CASE WHEN event_type = 'error' THEN CAST(floor(value / 4) AS BIGINT) ELSE 0 END AS downtime_min
  FROM events JOIN customer ON user_id = c_custkey))"""
SMOOTH_SQL = f"""{READ_SQL},
mov AS (SELECT *, {sql_ratio(f"(SUM({m('value')}) OVER w)", '(COUNT(*) OVER w)', 2)} AS moving_avg, {r('STDDEV_SAMP(value) OVER w', 4)} AS moving_stddev FROM reads
  WINDOW w AS (PARTITION BY sensor_id ORDER BY reading_time, reading_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
smooth AS (SELECT *, COALESCE(moving_stddev > 0 AND abs(value - moving_avg) > 1.7 * moving_stddev, FALSE) AS anomaly FROM mov),
sm AS (SELECT *, CASE WHEN anomaly THEN {sql_ratio('abs(value - moving_avg)', 'moving_stddev', 4)} END AS deviation FROM smooth)"""


@query(
    "reading_validation",
    f"WITH {READ_SQL} SELECT reading_id, sensor_type, shift_id, in_range, quality_score, units_produced, defect_units FROM reads",
)
def _(t: Tables) -> DataFrame:
    return event_readings(t).select(
        "reading_id", "sensor_type", "shift_id", "in_range", "quality_score", "units_produced", "defect_units"
    )


@query(
    "equipment_status",
    f"""WITH {READ_SQL}, g AS (SELECT plant_id, line_name, CAST(reading_time AS DATE) AS dt, shift_id, CAST(SUM(downtime_min) AS BIGINT) AS dn, COUNT(CASE WHEN downtime_min > 0 THEN 1 END) AS st FROM reads GROUP BY 1, 2, 3, 4)
SELECT plant_id, line_name, {day('dt')} AS shift_date, shift_id, dn AS downtime, st AS stops, 480 - dn AS uptime,
  CASE WHEN dn = 0 THEN 'RUNNING' WHEN dn < 30 THEN 'DEGRADED' ELSE 'IMPAIRED' END AS status FROM g""",
)
def _(t: Tables) -> DataFrame:
    return equipment_status(event_readings(t))


def smoothed_events(t: Tables) -> DataFrame:
    return smooth_readings(event_readings(t), rows=5, sigmas=1.7)


@query(
    "moving_anomaly_2sigma",
    f"""WITH {SMOOTH_SQL} SELECT reading_id, sensor_id, moving_avg, moving_stddev, anomaly, deviation FROM sm""",
)
def _(t: Tables) -> DataFrame:
    return smoothed_events(t).select("reading_id", "sensor_id", "moving_avg", "moving_stddev", "anomaly", "deviation")


@query(
    "anomaly_trend",
    f"""WITH {SMOOTH_SQL}
SELECT sensor_type, plant_id, {day("date_trunc('month', reading_time)")} AS trend_month, COUNT(*) AS readings, COUNT(CASE WHEN anomaly THEN 1 END) AS anomalies,
  {pct('COUNT(CASE WHEN anomaly THEN 1 END)', 'COUNT(*)')} AS anomaly_rate_pct, {sql_ratio('SUM(CAST(deviation AS DECIMAL(18,4)))', 'COUNT(deviation)', 4)} AS avg_deviation, MAX(deviation) AS max_deviation
FROM sm GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    hit = flag_sum(F.col("anomaly"))
    return smoothed_events(t).groupBy("sensor_type", "plant_id", month_start("reading_time").alias("trend_month")).agg(
        F.count(F.lit(1)).alias("readings"),
        hit.alias("anomalies"),
        percent(hit, F.count(F.lit(1))).alias("anomaly_rate_pct"),
        ratio(F.sum(F.col("deviation").cast("decimal(18,4)")), F.count("deviation"), 4).alias("avg_deviation"),
        F.max("deviation").alias("max_deviation"),
    )


@query(
    "plant_trend",
    f"""WITH {SMOOTH_SQL}
SELECT plant_id, line_name, {day('reading_time')} AS reading_date, {sql_ratio('SUM(' + m('value') + ')', 'COUNT(*)', 2)} AS avg_value,
  {sql_ratio('SUM(' + m('moving_avg') + ')', 'COUNT(*)', 2)} AS avg_smoothed, COUNT(CASE WHEN anomaly THEN 1 END) AS anomalies FROM sm GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    whole = F.count(F.lit(1))
    return smoothed_events(t).groupBy("plant_id", "line_name", F.col("reading_time").cast("date").alias("reading_date")).agg(
        ratio(F.sum(amount("value")), whole, 2).alias("avg_value"),
        ratio(F.sum(money("moving_avg")), whole, 2).alias("avg_smoothed"),
        flag_sum(F.col("anomaly")).alias("anomalies"),
    )


@query(
    "maintenance_signals",
    f"""WITH {SMOOTH_SQL}, x AS (SELECT *, LAG(value) OVER w AS prev_value, LEAD(value) OVER w AS next_value FROM sm WINDOW w AS (PARTITION BY sensor_id ORDER BY reading_time, reading_id))
SELECT reading_id, sensor_id, value, prev_value, next_value FROM x WHERE anomaly""",
)
def _(t: Tables) -> DataFrame:
    line = Timeline(
        smoothed_events(t), ["sensor_id"], ["reading_time", "reading_id"],
        profile=t.events.select(
            F.col("user_id").alias("sensor_id"), F.col("ts").alias("reading_time"), F.col("event_id").alias("reading_id")
        ),
    ).near(before=1, after=1, prev_value=lambda w: F.lag("value").over(w), next_value=lambda w: F.lead("value").over(w))
    return line.rows.filter("anomaly").select("reading_id", "sensor_id", "value", "prev_value", "next_value")


@query(
    "oee",
    f"""WITH {READ_SQL}, g AS (SELECT plant_id, line_name, CAST(reading_time AS DATE) AS dt, shift_id, SUM(downtime_min) AS dn, CAST(SUM(units_produced) AS BIGINT) AS au, CAST(SUM(units_produced - defect_units) AS BIGINT) AS gu FROM reads GROUP BY 1, 2, 3, 4),
tg AS (SELECT plant_id, line_name, shift_id, MAX(au) AS target FROM g WHERE shift_id <> 'SHIFT-NIGHT' GROUP BY 1, 2, 3),
x AS (SELECT g.*, {pct('(480 - dn)', '480')} AS a, COALESCE({pct('au', 'target')}, 100) AS p, COALESCE({pct('gu', 'au')}, 100) AS q FROM g LEFT JOIN tg USING (plant_id, line_name, shift_id))
SELECT plant_id, line_name, {day('dt')} AS shift_date, shift_id, au AS actual_units, gu AS good_units, a AS availability_pct, p AS performance_pct, q AS quality_pct,
  {r('a * p * q / 10000', 2)} AS oee_pct FROM x""",
)
def _(t: Tables) -> DataFrame:
    readings = event_readings(t)
    best = (
        readings.filter("shift_id <> 'SHIFT-NIGHT'")
        .groupBy("plant_id", "line_name", "shift_id", F.col("reading_time").cast("date").alias("_d"))
        .agg(F.sum("units_produced").alias("_u"))
        .groupBy("plant_id", "line_name", "shift_id")
        .agg(F.max("_u").alias("target_units"))
    )
    return oee(readings, pin(best, "targets")).select(
        "plant_id", "line_name", "shift_date", "shift_id", "actual_units", "good_units", "availability_pct",
        "performance_pct", "quality_pct", "oee_pct",
    )


@query(
    "quality_by_shift",
    f"""WITH {READ_SQL}
SELECT shift_id, COUNT(*) AS readings, {sql_ratio('SUM(CAST(quality_score AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS avg_quality, MIN(quality_score) AS min_quality, MAX(quality_score) AS max_quality FROM reads GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return event_readings(t).groupBy("shift_id").agg(
        F.count(F.lit(1)).alias("readings"),
        ratio(F.sum(money("quality_score")), F.count(F.lit(1)), 2).alias("avg_quality"),
        F.min("quality_score").alias("min_quality"), F.max("quality_score").alias("max_quality"),
    )
