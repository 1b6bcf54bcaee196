"""Claims against the policy version in force, outliers, loss ratios, adjusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, percent, ratio, rounded
from ..functions.temporal import days_between
from ..operators.joins import as_of, with_group_stats
from ..operators.quality import split_valid
from ..operators.timeline import Cuts
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, n, pct, r, ratio as sql_ratio
from .standins import TIER_SQL, account_cuts, tier_history


def enrich_claims(
    claims: DataFrame, policies: DataFrame, high: float = 2.5, medium: float = 1.5, cuts: Cuts | None = None
) -> DataFrame:
    """Policy version at the incident, days to settle, z-score and risk tier per coverage."""
    placed = as_of(
        claims, policies, ["policy_id"], "incident_date", "valid_from", "valid_to",
        ["coverage_type", "annual_premium", "region"], cuts=cuts,
    )
    placed = pin(placed, "placed")
    value = F.col("claim_amount").cast("double")
    stats = with_group_stats(placed, ["coverage_type"], _mean=F.avg(value), _dev=F.stddev_samp(value))
    risk = F.when(value > F.col("_mean") * high, "high_risk").when(value > F.col("_mean") * medium, "medium_risk")
    z = F.when(F.col("_dev") > 0, (value - F.col("_mean")) / F.col("_dev")).otherwise(0.0)
    return stats.withColumns(
        {
            "days_to_settle": days_between("settlement_date", "incident_date"),
            "days_to_report": days_between("reported_date", "incident_date"),
            "risk_tier": risk.otherwise("low_risk"),
            "z_score": rounded(z, 2),
        }
    ).drop("_mean", "_dev")


def loss_ratios(claims: DataFrame) -> DataFrame:
    """Coverage, region and quarter; the premium counts once per claim and is named so."""
    approved = F.coalesce("approved_amount", F.lit(0))
    when = F.col("incident_date")
    quarter = F.concat(F.lit("Q"), F.quarter(when).cast("string"), F.lit("-"), F.year(when).cast("string"))
    return claims.groupBy("coverage_type", "region", quarter.alias("quarter")).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.sum("claim_amount").alias("total_claimed"),
        F.sum(approved).alias("total_approved"),
        F.sum("annual_premium").alias("premium_exposed"),
        ratio(F.sum(approved), F.sum("annual_premium"), 4, default=0).alias("loss_ratio"),
        ratio(F.sum("days_to_settle"), F.count("days_to_settle"), 2).alias("avg_days_to_settle"),
    )


def adjuster_kpi(claims: DataFrame) -> DataFrame:
    whole = F.count(F.lit(1))
    return claims.groupBy("adjuster_id").agg(
        whole.alias("claims_handled"),
        flag_sum(F.col("status") == "settled").alias("claims_settled"),
        flag_sum(F.col("status") == "denied").alias("claims_denied"),
        ratio(F.sum("days_to_settle"), F.count("days_to_settle"), 2).alias("avg_days_to_settle"),
        ratio(F.sum("claim_amount"), whole, 2).alias("avg_claim_amount"),
        percent(flag_sum(F.col("approved_amount") > 0), whole).alias("approval_rate_pct"),
        F.sum(F.coalesce("approved_amount", F.lit(0))).alias("total_approved"),
    )


# stand-ins: orders as claims on the customer's tier as policy


def order_claims(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_settled"))
    status = F.col("o_orderstatus")
    claimed = amount("o_totalprice")
    settled = F.when(F.col("_settled") >= F.col("o_orderdate"), F.col("_settled"))
    raw = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_custkey").alias("policy_id"),
        F.col("o_orderpriority").alias("adjuster_id"),
        F.col("o_orderdate").alias("incident_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.length("o_orderpriority"))).alias("reported_date"),
        claimed.alias("claim_amount"),
        F.when(status == "F", (claimed * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,2)")).alias("approved_amount"),
        F.when(status == "F", "settled").when(status == "P", "denied").otherwise("filed").alias("status"),
        settled.alias("settlement_date"),
    )
    premium = F.when(F.col("tier") == "basic", 1200).when(F.col("tier") == "plus", 2400).otherwise(4800)
    people = t.customer.select(F.col("c_custkey").alias("account_id"), "c_nationkey").join(
        t.nation.select("n_nationkey", F.col("n_regionkey").cast("string").alias("region")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    cuts = account_cuts(t)
    policies = tier_history(t, cuts).join(people.select("account_id", "region"), "account_id").select(
        F.col("account_id").alias("policy_id"), F.col("tier").alias("coverage_type"),
        premium.cast("decimal(18,2)").alias("annual_premium"), "region", "valid_from", "valid_to",
    )
    return enrich_claims(raw, policies, cuts=cuts.renamed("account_id", "policy_id"))


CLAIMS_SQL = f"""{TIER_SQL},
claims_raw AS (SELECT o_orderkey AS claim_id, o_custkey AS policy_id, o_orderpriority AS adjuster_id, o_orderdate AS incident_date,
  CAST(o_totalprice AS DECIMAL(18,2)) AS claim_amount, CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(18,2)) END AS approved_amount,
  CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'P' THEN 'denied' ELSE 'filed' END AS status, length(o_orderpriority) AS days_to_report,
  CASE WHEN mx >= o_orderdate THEN date_diff('day', o_orderdate, mx) END AS days_to_settle
  FROM orders LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS mx FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
placed AS (SELECT c.*, tier AS coverage_type, CASE tier WHEN 'basic' THEN 1200 WHEN 'plus' THEN 2400 ELSE 4800 END AS annual_premium,
  CAST(n_regionkey AS VARCHAR) AS region FROM claims_raw c JOIN tiers ON policy_id = account_id AND incident_date >= valid_from AND (valid_to IS NULL OR incident_date < valid_to)
  JOIN customer ON policy_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
st AS (SELECT coverage_type, AVG(CAST(claim_amount AS DOUBLE)) AS mean, STDDEV_SAMP(CAST(claim_amount AS DOUBLE)) AS dev FROM placed GROUP BY 1),
claims AS (SELECT p.*, CASE WHEN claim_amount > mean * 2.5 THEN 'high_risk' WHEN claim_amount > mean * 1.5 THEN 'medium_risk' ELSE 'low_risk' END AS risk_tier,
  {r('CASE WHEN dev > 0 THEN (CAST(claim_amount AS DOUBLE) - mean) / dev ELSE 0 END', 2)} AS z_score FROM placed p JOIN st USING (coverage_type))"""


@query(
    "zscore_outliers",
    f"""WITH {CLAIMS_SQL} SELECT claim_id, coverage_type, region, {n('days_to_settle')} AS days_to_settle, {n('days_to_report')} AS days_to_report, risk_tier, z_score FROM claims""",
)
def _(t: Tables) -> DataFrame:
    return order_claims(t).select("claim_id", "coverage_type", "region", "days_to_settle", "days_to_report", "risk_tier", "z_score")


@query(
    "loss_ratio_quarter",
    f"""WITH {CLAIMS_SQL}
SELECT coverage_type, region, 'Q' || CAST(quarter(incident_date) AS VARCHAR) || '-' || CAST(year(incident_date) AS VARCHAR) AS quarter, COUNT(*) AS claim_count,
  {d('SUM(claim_amount)')} AS total_claimed, {d('SUM(COALESCE(approved_amount, 0))')} AS total_approved, {d('SUM(annual_premium)')} AS premium_exposed,
  COALESCE({sql_ratio('SUM(COALESCE(approved_amount, 0))', 'SUM(annual_premium)', 4)}, 0) AS loss_ratio,
  {sql_ratio('SUM(days_to_settle)', 'COUNT(days_to_settle)', 2)} AS avg_days_to_settle FROM claims GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return loss_ratios(order_claims(t))


@query(
    "adjuster_kpi",
    f"""WITH {CLAIMS_SQL}
SELECT adjuster_id, COUNT(*) AS claims_handled, COUNT(CASE WHEN status = 'settled' THEN 1 END) AS claims_settled, COUNT(CASE WHEN status = 'denied' THEN 1 END) AS claims_denied,
  {sql_ratio('SUM(days_to_settle)', 'COUNT(days_to_settle)', 2)} AS avg_days_to_settle, {sql_ratio('SUM(claim_amount)', 'COUNT(*)', 2)} AS avg_claim_amount,
  {pct('COUNT(CASE WHEN approved_amount > 0 THEN 1 END)', 'COUNT(*)')} AS approval_rate_pct, {d('SUM(COALESCE(approved_amount, 0))')} AS total_approved FROM claims GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return adjuster_kpi(order_claims(t))


@query(
    "claim_sanity",
    f"""SELECT o_orderkey AS claim_id, MIN(l_shipdate) AS first_ship, 'ships_before_order' AS broken_rules FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY 1, o_orderdate HAVING MIN(l_shipdate) < o_orderdate""",
)
def _(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    rows = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    _good, bad = split_valid(
        rows,
        {"ships_before_order": F.col("first_ship") >= F.col("o_orderdate"), "no_amount": F.col("o_totalprice") > 0},
    )
    return bad.select(F.col("o_orderkey").alias("claim_id"), "first_ship", "broken_rules")
