"""Flattened geography, wide customers and suppliers, sale and purchase lines, settlements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, percent, ratio
from ..functions.temporal import date_key, days_between
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, m, n, pct, ratio as sql_ratio
from .standins import LINES_SQL, order_lines


def geography(nations: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per nation with its region."""
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("continent")
    )


def with_place(df: DataFrame, key: str, places: DataFrame, prefix: str) -> DataFrame:
    """Country and continent of ``key`` under ``prefix``; usable several times for several roles."""
    named = places.select(
        F.col("n_nationkey").alias("_k"), F.col("country").alias(f"{prefix}_country"),
        F.col("continent").alias(f"{prefix}_continent"),
    )
    return df.join(named, F.col(key) == F.col("_k"), "left").drop("_k")


@query(
    "geo_flatten",
    f"SELECT {n('n_nationkey')} AS n_nationkey, n_name AS country, r_name AS continent FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
)
def _(t: Tables) -> DataFrame:
    return geography(t.nation, t.region)


@query(
    "wide_customer",
    f"""SELECT c.c_custkey, c.c_name, b.c_name AS bill_to_name, c.c_mktsegment, n1.n_name AS delivery_country, r1.r_name AS delivery_continent,
  n2.n_name AS postal_country, r2.r_name AS postal_continent, c.c_acctbal FROM customer c LEFT JOIN customer b ON b.c_custkey = c.c_nationkey
LEFT JOIN nation n1 ON c.c_nationkey = n1.n_nationkey LEFT JOIN region r1 ON n1.n_regionkey = r1.r_regionkey
LEFT JOIN nation n2 ON b.c_nationkey = n2.n_nationkey LEFT JOIN region r2 ON n2.n_regionkey = r2.r_regionkey""",
)
def _(t: Tables) -> DataFrame:
    """Every customer is billed through the customer whose key is its nation's number."""
    places = geography(t.nation, t.region)
    payers = t.customer.select(
        F.col("c_custkey").alias("_payer"), F.col("c_name").alias("bill_to_name"), F.col("c_nationkey").alias("postal_key")
    )
    # a self join on few distinct payers: shrink the payer side first
    used = t.customer.select(F.col("c_nationkey").cast("bigint").alias("_payer")).distinct()
    payers = pin(payers.join(used, "_payer"), "payers")
    wide = t.customer.join(payers, F.col("c_nationkey") == F.col("_payer"), "left")
    wide = with_place(wide, "c_nationkey", places, "delivery")
    wide = with_place(wide, "postal_key", places, "postal")
    return wide.select(
        "c_custkey", "c_name", "bill_to_name", "c_mktsegment", "delivery_country", "delivery_continent",
        "postal_country", "postal_continent", "c_acctbal",
    )


@query(
    "wide_supplier",
    "SELECT s_suppkey, s_name, n_name AS delivery_country, r_name AS delivery_continent, s_acctbal FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def _(t: Tables) -> DataFrame:
    wide = with_place(t.supplier, "s_nationkey", geography(t.nation, t.region), "delivery")
    return wide.select("s_suppkey", "s_name", "delivery_country", "delivery_continent", "s_acctbal")


def sale_lines(t: Tables) -> DataFrame:
    """Sale at line grain: date keys, totals, margin, backorder flag and days to fulfil."""
    rows = order_lines(t).join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"), "left")
    cost = F.col("l_quantity").cast("bigint") * amount("p_retailprice")
    days = days_between("l_shipdate", "o_orderdate")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("customer_key"),
        date_key("l_shipdate").alias("invoice_date_key"),
        date_key("o_orderdate").alias("order_date_key"),
        "price",
        (F.col("price") + F.col("tax_amount")).alias("total_with_tax"),
        percent(F.col("price") - cost, "price", default=0).alias("margin_pct"),
        (F.col("o_orderstatus") == "P").alias("is_backorder"),
        days.alias("days_to_fulfil"),
    )


@query(
    "sale_line_metrics",
    f"""WITH {LINES_SQL}
SELECT l_orderkey, {n('l_linenumber')} AS l_linenumber, l_partkey, o_custkey AS customer_key, {n("strftime(l_shipdate, '%Y%m%d')")} AS invoice_date_key, {n("strftime(o_orderdate, '%Y%m%d')")} AS order_date_key,
  {d('price')} AS price, {d('price + tax_amount')} AS total_with_tax, COALESCE({pct(f"(price - CAST(l_quantity AS DECIMAL(12,2)) * {m('p_retailprice')})", 'price')}, 0) AS margin_pct, o_orderstatus = 'P' AS is_backorder,
  {n("date_diff('day', o_orderdate, l_shipdate)")} AS days_to_fulfil FROM lines JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(t: Tables) -> DataFrame:
    return sale_lines(t)


@query(
    "purchase_view",
    f"""SELECT l_orderkey, l_suppkey, COUNT(*) AS lines, {d('SUM(' + m('l_extendedprice') + ')')} AS order_total, {d("SUM(CASE WHEN l_linestatus = 'F' THEN " + m('l_extendedprice') + " ELSE 0 END)")} AS received_total,
  {pct("SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)", 'SUM(CAST(l_quantity AS BIGINT))')} AS fulfilment_pct,
  {n("date_diff('day', MIN(o_orderdate), MAX(CASE WHEN l_linestatus = 'F' THEN l_shipdate END))")} AS days_to_deliver, bool_and(l_linestatus = 'F') AS is_finalized
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    done = F.col("l_linestatus") == "F"
    units = F.col("l_quantity").cast("bigint")
    rows = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("l_orderkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(amount("l_extendedprice")).alias("order_total"),
        F.sum(F.when(done, amount("l_extendedprice")).otherwise(0)).alias("received_total"),
        percent(F.sum(F.when(done, units).otherwise(0)), F.sum(units)).alias("fulfilment_pct"),
        days_between(F.max(F.when(done, F.col("l_shipdate"))), F.min("o_orderdate")).alias("days_to_deliver"),
        F.bool_and(done).alias("is_finalized"),
    )


@query(
    "settlement_days",
    f"""WITH s AS (SELECT l_orderkey, MAX(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS fin FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey AS customer_key, {n("strftime(o_orderdate, '%Y%m%d')")} AS transaction_date_key, {n("strftime(fin, '%Y%m%d')")} AS finalization_date_key, fin IS NOT NULL AS is_finalized,
  {n("date_diff('day', o_orderdate, fin)")} AS days_to_finalize FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    done = t.lineitem.groupBy("l_orderkey").agg(F.max(F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))).alias("fin"))
    return t.orders.join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.col("o_custkey").alias("customer_key"), date_key("o_orderdate").alias("transaction_date_key"),
        date_key("fin").alias("finalization_date_key"), F.col("fin").isNotNull().alias("is_finalized"),
        days_between("fin", "o_orderdate").alias("days_to_finalize"),
    )


@query(
    "supplier_settlement",
    f"""SELECT s_suppkey, s_name, COUNT(l_orderkey) AS lines, {d('COALESCE(SUM(' + m('l_extendedprice') + '), 0)')} AS amount,
  {d("COALESCE(SUM(CASE WHEN l_linestatus = 'O' THEN " + m('l_extendedprice') + " END), 0)")} AS outstanding, {sql_ratio("SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", 'COUNT(l_orderkey)', 4)} AS finalized_share
FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    zero = F.lit(0)
    sums = t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(amount("l_extendedprice")).alias("amount"),
        F.sum(F.when(F.col("l_linestatus") == "O", amount("l_extendedprice"))).alias("outstanding"),
        ratio(F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)), F.count(F.lit(1)), 4).alias("finalized_share"),
    )
    return t.supplier.join(sums, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "s_suppkey", "s_name", *[F.coalesce(c, zero).alias(c) for c in ("lines", "amount", "outstanding")], "finalized_share"
    )
