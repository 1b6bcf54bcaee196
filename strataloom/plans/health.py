"""Admissions: deduplication, readmission within 30 days, length of stay, cost rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, percent, ratio
from ..functions.temporal import days_between, quarter_label
from ..operators.aggregates import first_row
from ..operators.joins import as_of
from ..operators.ranking import ntile, rank_values
from ..operators.timeline import Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, n, pct, ratio as sql_ratio
from .standins import TIER_SQL, account_cuts, tier_history


def clean_admissions(raw: DataFrame, within_days: int = 30) -> DataFrame:
    """One row per record with length of stay, previous discharge and readmission flag."""
    once = first_row(raw, ["record_id"], [F.col("ingested_at")])
    stays = once.withColumn("los_days", days_between("discharge_date", "admission_date"))
    line = Timeline(
        stays, ["patient_id"], ["admission_date", "record_id"],
        profile=raw.select("patient_id", "admission_date", "record_id"),
    ).near(before=1, prev_discharge=lambda w: F.lag("discharge_date").over(w))
    since = days_between("admission_date", "prev_discharge")
    return line.rows.withColumn("days_since_discharge", since).withColumn(
        "readmission", F.coalesce(F.col("days_since_discharge") <= within_days, F.lit(False))
    )


def readmission_kpi(facts: DataFrame) -> DataFrame:
    whole = F.count(F.lit(1))
    return facts.groupBy("department", quarter_label("admission_date").alias("period")).agg(
        whole.alias("admissions"),
        flag_sum(F.col("readmission")).alias("readmissions"),
        percent(flag_sum(F.col("readmission")), whole).alias("readmission_pct"),
        ratio(F.sum("los_days"), whole, 2).alias("avg_los"),
        ratio(F.sum("total_charges"), whole, 2).alias("avg_charges"),
        F.max("los_days").alias("max_los"),
    )


# stand-ins: orders as admissions; the stay has one day per line, records arrive twice


def order_admissions(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("_lines"))
    base = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    raw = base.select(
        F.col("o_orderkey").alias("record_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderpriority").alias("department"),
        F.col("o_orderdate").alias("admission_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.coalesce("_lines", F.lit(0)))).alias("discharge_date"),
        amount("o_totalprice").alias("total_charges"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("ingested_at"),
    )
    return clean_admissions(raw)


ADM_SQL = """
base AS (SELECT o_orderkey AS record_id, o_custkey AS patient_id, o_orderpriority AS department, o_orderdate AS admission_date,
  o_orderdate + COALESCE(k, 0) * INTERVAL 1 DAY AS discharge_date, COALESCE(k, 0) AS los_days, CAST(o_totalprice AS DECIMAL(18,2)) AS total_charges
  FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS k FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
adm AS (SELECT *, date_diff('day', LAG(discharge_date) OVER w, admission_date) AS since FROM base
  WINDOW w AS (PARTITION BY patient_id ORDER BY admission_date, record_id)),
admissions AS (SELECT *, COALESCE(since <= 30, FALSE) AS readmission FROM adm)"""


@query(
    "readmission_30d",
    f"""WITH {ADM_SQL} SELECT record_id, patient_id, {n('los_days')} AS los_days, {n('since')} AS days_since_discharge, readmission FROM admissions""",
)
def _(t: Tables) -> DataFrame:
    return order_admissions(t).select("record_id", "patient_id", "los_days", "days_since_discharge", "readmission")


@query(
    "los_percentile",
    f"""WITH {ADM_SQL} SELECT record_id, {n('los_days')} AS los_days, {n('NTILE(100) OVER (ORDER BY los_days, record_id)')} AS los_percentile FROM admissions""",
)
def _(t: Tables) -> DataFrame:
    rows = order_admissions(t).select("record_id", "los_days")
    return ntile(rows, ["los_days", "record_id"], 100, "los_percentile")


@query(
    "fact_pit_ranked",
    f"""WITH {ADM_SQL}, {TIER_SQL}
SELECT record_id, a.patient_id, {d('total_charges')} AS total_charges, {n('DENSE_RANK() OVER (ORDER BY total_charges DESC)')} AS cost_rank,
  tier, valid_from FROM admissions a LEFT JOIN tiers ON patient_id = account_id AND admission_date >= valid_from
  AND admission_date < COALESCE(valid_to, TIMESTAMP '9999-12-31')""",
)
def _(t: Tables) -> DataFrame:
    rows = order_admissions(t).select("record_id", "patient_id", "total_charges", "admission_date")
    cuts = account_cuts(t)
    patients = tier_history(t, cuts).withColumnRenamed("account_id", "patient_id")
    joined = as_of(
        rows, patients, ["patient_id"], "admission_date", "valid_from", "valid_to", ["tier", "valid_from"],
        how="left", cuts=cuts.renamed("account_id", "patient_id"),
    )
    joined = pin(joined, "placed")
    return rank_values(joined, "total_charges", descending=True, dense_rank="cost_rank").drop("admission_date")


@query(
    "readmission_kpi",
    f"""WITH {ADM_SQL}
SELECT department, CAST(year(admission_date) AS VARCHAR) || '-Q' || CAST(quarter(admission_date) AS VARCHAR) AS period, COUNT(*) AS admissions,
  COUNT(CASE WHEN readmission THEN 1 END) AS readmissions, {pct('COUNT(CASE WHEN readmission THEN 1 END)', 'COUNT(*)')} AS readmission_pct,
  {sql_ratio('SUM(los_days)', 'COUNT(*)', 2)} AS avg_los, {sql_ratio('SUM(total_charges)', 'COUNT(*)', 2)} AS avg_charges, {n('MAX(los_days)')} AS max_los
FROM admissions GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return readmission_kpi(order_admissions(t))


@query(
    "monthly_trend",
    f"""WITH {ADM_SQL}
SELECT strftime(admission_date, '%Y-%m') AS month, COUNT(*) AS admissions, COUNT(CASE WHEN readmission THEN 1 END) AS readmissions,
  {d('SUM(total_charges)')} AS charges, {sql_ratio('SUM(los_days)', 'COUNT(*)', 2)} AS avg_los FROM admissions GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return order_admissions(t).groupBy(F.date_format("admission_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("admissions"), flag_sum(F.col("readmission")).alias("readmissions"),
        F.sum("total_charges").alias("charges"), ratio(F.sum("los_days"), F.count(F.lit(1)), 2).alias("avg_los"),
    )
