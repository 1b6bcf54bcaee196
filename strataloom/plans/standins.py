"""The given tables in the shapes the domain queries expect, in Spark and in SQL.

Only names, casts and value-based labels: no rows are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, band, hundredths, ten_thousandths, money
from ..operators.scd import build_history, changes_only
from ..operators.timeline import Cuts, Timeline, find_cuts
from ..sources.tables import Tables

TIER_EDGES = (500_000, 1_500_000)
TIERS = ("basic", "plus", "prime")


def account_cuts(t: Tables, key: str = "account_id") -> Cuts:
    """Cuts of customers with very many orders, by date and number of the order."""
    orders = t.orders.select(F.col("o_custkey").alias(key), "o_orderdate", "o_orderkey")
    return find_cuts(orders, [key], ["o_orderdate", "o_orderkey"])


def tier_steps(t: Tables, cuts: Cuts | None = None) -> DataFrame:
    """Customer tier by running order value: one row per customer and change of tier."""
    cuts = cuts or account_cuts(t)
    orders = t.orders.select(
        F.col("o_custkey").alias("account_id"),
        "o_orderdate",
        "o_orderkey",
        amount("o_totalprice").alias("amount"),
    )
    running = Timeline(orders, ["account_id"], ["o_orderdate", "o_orderkey"], cuts=cuts).running(spent=F.col("amount"))
    daily = (
        running.rows.groupBy("account_id", F.col("o_orderdate").alias("valid_from"))
        .agg(F.max("spent").alias("spent"))
        .withColumn("tier", band(F.col("spent"), TIER_EDGES, TIERS))
    )
    return changes_only(daily, ["account_id"], ["valid_from"], ["tier"], cuts)


def tier_history(t: Tables, cuts: Cuts | None = None) -> DataFrame:
    """account_id, tier, spent, [valid_from, valid_to), is_current."""
    cuts = cuts or account_cuts(t)
    return build_history(tier_steps(t, cuts), ["account_id"], "valid_from", cuts=cuts)


TIER_SQL = """
tier_daily AS (
  SELECT o_custkey AS account_id, o_orderdate AS valid_from, MAX(spent) AS spent FROM (
    SELECT o_custkey, o_orderdate,
           SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent
    FROM orders) GROUP BY 1, 2),
tier_named AS (
  SELECT *, CASE WHEN spent < 500000 THEN 'basic' WHEN spent < 1500000 THEN 'plus' ELSE 'prime' END AS tier
  FROM tier_daily),
tier_steps AS (
  SELECT * FROM (SELECT *, LAG(tier) OVER (PARTITION BY account_id ORDER BY valid_from) AS was FROM tier_named)
  WHERE was IS NULL OR was <> tier),
tiers AS (
  SELECT account_id, tier, spent, valid_from,
         LEAD(valid_from) OVER (PARTITION BY account_id ORDER BY valid_from) AS valid_to,
         LEAD(valid_from) OVER (PARTITION BY account_id ORDER BY valid_from) IS NULL AS is_current
  FROM tier_steps)"""


def customers_later(t: Tables) -> DataFrame:
    """A later state of the customers: some left, some moved segment, some balances grew,
    and the suppliers joined as customers."""
    kept = t.customer.filter(F.col("c_acctbal") >= 500)
    segment = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "CONSUMER").otherwise(F.col("c_mktsegment"))
    balance = F.when(F.col("c_acctbal") > 8000, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    changed = kept.withColumn("c_mktsegment", segment).withColumn("c_acctbal", money(balance).cast("double"))
    joined = t.supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return changed.unionByName(joined)


LATER_SQL = """
later AS (
  SELECT c_custkey, c_name, c_nationkey,
         CAST(CAST(CASE WHEN c_acctbal > 8000 THEN c_acctbal + 100 ELSE c_acctbal END AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'CONSUMER' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_acctbal >= 500
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)"""


def order_lines(t: Tables) -> DataFrame:
    """Line items with exact amounts."""
    price, discount, tax = hundredths("l_extendedprice"), hundredths("l_discount"), hundredths("l_tax")
    return t.lineitem.withColumns(
        {
            "price": amount("l_extendedprice"),
            "discount_amount": ten_thousandths(price * discount),
            "net": ten_thousandths(price * (F.lit(100) - discount)),
            "tax_amount": ten_thousandths(price * tax),
        }
    )


LINES_SQL = """
lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS net,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS tax_amount
  FROM lineitem)"""
