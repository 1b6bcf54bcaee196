"""Transaction scoring, balances, daily volumes and tier migration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, money, percent, points, ratio, rounded
from ..functions.temporal import seconds_between
from ..operators.aggregates import first_row
from ..operators.changes import feed_from_versions
from ..operators.timeline import Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, day, m, n, pct, r, ratio as sql_ratio, sec
from .standins import TIER_SQL, tier_history


def score_transactions(
    transactions: DataFrame,
    merchants: DataFrame,
    accounts: DataFrame,
    high_amount: float = 5000,
    risky_categories: Sequence[str] = ("crypto",),
    burst_rows: int = 6,
    burst_seconds: float = 86400,
    night: tuple[int, int] = (1, 5),
) -> DataFrame:
    """Fraud score 0-100 and running balance per transaction.

    +30 large amount, +25 risky merchant, +20 many recent transactions with the
    last one less than ``burst_seconds`` ago, +15 flagged, +10 at night.
    The burst looks at the current and the ``burst_rows - 1`` rows before.
    """
    once = first_row(transactions, ["transaction_id"], [F.col("ingested_at")])
    signed = F.when(F.col("transaction_type") == "credit", F.col("amount")).otherwise(-F.col("amount"))
    line = Timeline(
        once,
        ["account_id"],
        ["transaction_date", "transaction_id"],
        profile=transactions.select("account_id", "transaction_date", "transaction_id"),
    ).near(
        before=burst_rows - 1,
        prev_amount=lambda w: F.lag("amount").over(w),
        _prev_at=lambda w: F.lag("transaction_date").over(w),
        velocity=lambda w: F.count(F.lit(1)).over(w.rowsBetween(-(burst_rows - 1), 0)),
    )
    rows = line.running(balance_delta=signed).rows
    rows = rows.withColumn("seconds_since_prev", seconds_between("transaction_date", "_prev_at"))
    joined = rows.join(merchants.select("merchant_id", "category"), "merchant_id", "left").join(
        accounts.select("account_id", "current_balance"), "account_id"
    )
    recent = (F.col("velocity") >= burst_rows) & (F.col("seconds_since_prev") < burst_seconds)
    rules = [
        (F.col("amount") > high_amount, 30),
        (F.col("category").isin(*risky_categories), 25),
        (recent, 20),
        (F.col("is_suspicious"), 15),
        (F.hour("transaction_date").between(*night), 10),
    ]
    return joined.withColumn("fraud_score", points(rules)).withColumn(
        "running_balance", F.col("current_balance") + F.col("balance_delta")
    )


def daily_volumes(facts: DataFrame, at: str, value, flagged: Column, rows: int = 7) -> DataFrame:
    """Per day: volume, amount, share of flagged rows and moving averages over days."""
    daily = facts.groupBy(F.col(at).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(money(value)).alias("total_amount"),
        flag_sum(flagged).alias("flagged_count"),
    )
    # one row per calendar day from here on
    recent = Window.orderBy("day").rowsBetween(-(rows - 1), 0)
    return daily.select(
        "day",
        "total_txns",
        "total_amount",
        ratio("total_amount", "total_txns", 2).alias("avg_amount"),
        "flagged_count",
        percent("flagged_count", "total_txns").alias("flagged_pct"),
        ratio(F.sum("total_txns").over(recent), F.count(F.lit(1)).over(recent), 2).alias("avg_txns_7d"),
        ratio(F.sum("total_amount").over(recent), F.count(F.lit(1)).over(recent), 2).alias("avg_amount_7d"),
    )


def tier_migration(dim: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers that moved from tier to tier, and those that stayed, with the balance of the tier.

    Balances are averaged per tier before joining, so counts are not multiplied.
    """
    feed = feed_from_versions(dim, ["account_id"], "tier")
    pre = feed.filter("change_type = 'update_preimage'").select("account_id", F.col("old_value").alias("from_tier"))
    post = feed.filter("change_type = 'update_postimage'").select("account_id", F.col("new_value").alias("to_tier"))
    moves = pre.join(post, "account_id").filter("from_tier <> to_tier")
    moved = moves.groupBy("from_tier", "to_tier").agg(F.count(F.lit(1)).alias("customers"))
    stayed = (
        dim.filter("is_current")
        .join(moves.select("account_id").distinct(), "account_id", "left_anti")
        .groupBy(F.col("tier").alias("from_tier"), F.col("tier").alias("to_tier"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    balances = (
        dim.filter("is_current")
        .join(accounts, "account_id")
        .groupBy(F.col("tier").alias("to_tier"))
        .agg(F.sum(money("current_balance")).alias("_sum"), F.count("current_balance").alias("_n"))
    )
    return (
        stayed.unionByName(moved)
        .join(balances, "to_tier", "left")
        .select("from_tier", "to_tier", "customers", ratio("_sum", "_n", 2, default=0).alias("avg_balance"))
    )


# stand-ins: users' events as card transactions, customers as accounts


def event_transactions(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("event_type").alias("merchant_id"),
        F.col("ts").alias("transaction_date"),
        amount("value").alias("amount"),
        F.when(F.col("event_type") == "signup", "credit").otherwise("debit").alias("transaction_type"),
        (F.col("event_type") == "error").alias("is_suspicious"),
        F.col("ts").alias("ingested_at"),
    )


def event_merchants(t: Tables) -> DataFrame:
    kinds = t.events.select(F.col("event_type").alias("merchant_id")).distinct()
    named = kinds.withColumn("category", F.when(F.col("merchant_id") == "purchase", "crypto").otherwise("retail"))
    return pin(named, "merchants")  # a stored dimension, so its size is known to the join


def customer_accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("account_id"), amount("c_acctbal").alias("current_balance"))


SCORED_SQL = f"""
base AS (
  SELECT event_id, user_id, ts, event_type, {m('value')} AS amount,
         LAG({m('value')}) OVER w AS prev_amount, LAG(ts) OVER w AS prev_ts,
         COUNT(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS velocity,
         SUM(CASE WHEN event_type = 'signup' THEN {m('value')} ELSE -{m('value')} END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS delta
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
scored AS (
  SELECT b.*, {m('c.c_acctbal')} + b.delta AS running_balance, {sec('ts', 'prev_ts')} AS since,
         LEAST(100, GREATEST(0, CASE WHEN amount > 150 THEN 30 ELSE 0 END
           + CASE WHEN event_type = 'purchase' THEN 25 ELSE 0 END
           + CASE WHEN velocity >= 6 AND {sec('ts', 'prev_ts')} < 7200 THEN 20 ELSE 0 END
           + CASE WHEN event_type = 'error' THEN 15 ELSE 0 END
           + CASE WHEN hour(ts) BETWEEN 1 AND 5 THEN 10 ELSE 0 END)) AS fraud_score
  FROM base b JOIN customer c ON b.user_id = c.c_custkey)"""


def scored_events(t: Tables) -> DataFrame:
    return score_transactions(
        event_transactions(t), event_merchants(t), customer_accounts(t), high_amount=150, burst_seconds=7200
    )


@query(
    "fraud_score",
    f"""WITH {SCORED_SQL}
SELECT event_id AS transaction_id, user_id AS account_id, {n('fraud_score')} AS fraud_score, {n('velocity')} AS velocity,
       {d('prev_amount')} AS prev_amount, {r('since', 3)} AS seconds_since_prev FROM scored""",
)
def _(t: Tables) -> DataFrame:
    return scored_events(t).select(
        "transaction_id", "account_id", "fraud_score", "velocity", "prev_amount",
        rounded("seconds_since_prev", 3).alias("seconds_since_prev"),
    )


@query(
    "running_balance",
    f"""WITH {SCORED_SQL}
SELECT event_id AS transaction_id, user_id AS account_id, ts AS transaction_date, {d('amount')} AS amount,
       {d('running_balance')} AS running_balance FROM scored""",
)
def _(t: Tables) -> DataFrame:
    return scored_events(t).select("transaction_id", "account_id", "transaction_date", "amount", "running_balance")


def _daily_sql(source: str, at: str, amount: str, flagged: str) -> str:
    w = "OVER (ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return f"""daily AS (
  SELECT CAST({at} AS DATE) AS dt, COUNT(*) AS c, SUM({m(amount)}) AS amt,
         COUNT(CASE WHEN {flagged} THEN 1 END) AS f FROM {source} GROUP BY 1)
SELECT {day('dt')} AS day, c AS total_txns, {d('amt')} AS total_amount, {sql_ratio('amt', 'c', 2)} AS avg_amount,
       f AS flagged_count, {pct('f', 'c')} AS flagged_pct,
       {sql_ratio(f'(SUM(c) {w})', f'(COUNT(*) {w})', 2)} AS avg_txns_7d,
       {sql_ratio(f'(SUM(amt) {w})', f'(COUNT(*) {w})', 2)} AS avg_amount_7d
FROM daily"""


@query("daily_kpi_moving_avg", "WITH " + _daily_sql("orders", "o_orderdate", "o_totalprice", "o_totalprice > 300000"))
def _(t: Tables) -> DataFrame:
    return daily_volumes(t.orders, "o_orderdate", amount("o_totalprice"), F.col("o_totalprice") > 300000)


@query(
    "daily_fraud_volumes",
    f"WITH {SCORED_SQL}, " + _daily_sql("scored", "ts", "amount", "fraud_score >= 40"),
)
def _(t: Tables) -> DataFrame:
    return daily_volumes(scored_events(t), "transaction_date", "amount", F.col("fraud_score") >= 40)


@query(
    "tier_migration",
    f"""WITH {TIER_SQL},
moves AS (SELECT e.account_id, e.tier AS from_tier, c.tier AS to_tier FROM tiers e JOIN tiers c
          ON e.account_id = c.account_id AND NOT e.is_current AND c.is_current AND e.tier <> c.tier),
counts AS (SELECT from_tier, to_tier, COUNT(*) AS customers FROM moves GROUP BY 1, 2
  UNION ALL SELECT tier, tier, COUNT(*) FROM tiers WHERE is_current AND account_id NOT IN (SELECT account_id FROM moves) GROUP BY 1, 2),
bal AS (SELECT tier, SUM({m('c_acctbal')}) AS s, COUNT(*) AS k FROM tiers JOIN customer ON account_id = c_custkey WHERE is_current GROUP BY 1)
SELECT from_tier, to_tier, customers, COALESCE({sql_ratio('s', 'k', 2)}, 0.0) AS avg_balance
FROM counts LEFT JOIN bal ON to_tier = tier""",
)
def _(t: Tables) -> DataFrame:
    return tier_migration(pin(tier_history(t), "dim"), customer_accounts(t))
