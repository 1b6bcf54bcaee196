"""Surrogate keys, ranks, calendars and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, rounded
from ..functions.temporal import date_key, weekday_from_sunday
from ..operators.ranking import bucket_of, number_rows, rank_values, surrogate_keys
from ..sources.tables import Tables, date_series
from .registry import query
from .sqltext import d, day, n, r
from .standins import LINES_SQL, order_lines


def calendar(days: DataFrame, full_date: str = "full_date", fiscal_start: int = 7) -> DataFrame:
    """Calendar attributes per day; the fiscal year is named after the year it ends in."""
    c = F.col(full_date)
    month = F.month(c)
    later = month >= fiscal_start
    shifted = (month - fiscal_start + 12) % 12
    return days.select(
        date_key(c).alias("date_key"),
        c.alias("full_date"),
        F.dayofweek(c).alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.dayofmonth(c).alias("day_of_month"),
        F.dayofyear(c).alias("day_of_year"),
        F.weekofyear(c).alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).alias("quarter"),
        F.year(c).alias("year"),
        F.dayofweek(c).isin(1, 7).alias("is_weekend"),
        (F.year(c) + F.when(later, 1).otherwise(0)).alias("fiscal_year"),
        (F.floor(shifted / 3) + 1).cast("int").alias("fiscal_quarter"),
    )


def date_dim(facts: DataFrame, at: str) -> DataFrame:
    """One row per day that occurs in the facts."""
    c = F.col("full_date")
    return (
        facts.select(F.col(at).cast("date").alias("full_date"))
        .distinct()
        .select(
            date_key(c).alias("date_key"),
            c.alias("full_date"),
            weekday_from_sunday(c).alias("weekday"),
            F.date_format(c, "EEEE").alias("day_name"),
            F.month(c).alias("month"),
            F.date_format(c, "MMMM").alias("month_name"),
            F.quarter(c).alias("quarter"),
            F.year(c).alias("year"),
            F.dayofweek(c).isin(1, 7).alias("is_weekend"),
        )
    )


@query(
    "date_dim",
    f"""SELECT {n("strftime(f, '%Y%m%d')")} AS date_key, {day('f')} AS full_date, {n('dayofweek(f)')} AS weekday,
       dayname(f) AS day_name, {n('month(f)')} AS month, monthname(f) AS month_name, {n('quarter(f)')} AS quarter,
       {n('year(f)')} AS year, dayofweek(f) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS f FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return date_dim(t.orders, "o_orderdate")


@query(
    "fiscal_calendar",
    f"""SELECT {n("strftime(f, '%Y%m%d')")} AS date_key, {day('f')} AS full_date, {n('dayofweek(f) + 1')} AS day_of_week,
       dayname(f) AS day_name, {n('day(f)')} AS day_of_month, {n('dayofyear(f)')} AS day_of_year,
       {n('weekofyear(f)')} AS week_of_year, {n('month(f)')} AS month_number, monthname(f) AS month_name,
       {n('quarter(f)')} AS quarter, {n('year(f)')} AS year, dayofweek(f) IN (0, 6) AS is_weekend,
       {n('CASE WHEN month(f) >= 7 THEN year(f) + 1 ELSE year(f) END')} AS fiscal_year,
       {n('CASE WHEN month(f) >= 7 THEN quarter(f) - 2 ELSE quarter(f) + 2 END')} AS fiscal_quarter
FROM (SELECT CAST(UNNEST(generate_series((SELECT date_trunc('year', MIN(o_orderdate)) FROM orders),
      (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS f)""",
)
def _(t: Tables) -> DataFrame:
    # the first and last day are one row
    first, last = t.orders.agg(
        F.trunc(F.min("o_orderdate").cast("date"), "year").cast("string"),
        F.max("o_orderdate").cast("date").cast("string"),
    ).first()
    return calendar(date_series(t.spark, first, last))


@query(
    "surrogate_keys",
    f"""SELECT {n('ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_name)')} AS customer_key, c_custkey, c_name, c_mktsegment FROM customer""",
)
def _(t: Tables) -> DataFrame:
    keyed = surrogate_keys(t.customer, ["c_mktsegment", "c_name"], "customer_key")
    return keyed.select("customer_key", "c_custkey", "c_name", "c_mktsegment")


@query(
    "ntile_quartiles",
    f"""SELECT o_orderkey, {n('NTILE(4) OVER (ORDER BY o_totalprice, o_orderkey)')} AS quartile,
       {n('NTILE(100) OVER (ORDER BY o_totalprice, o_orderkey)')} AS centile FROM orders""",
)
def _(t: Tables) -> DataFrame:
    numbered = number_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "rn", total="n")
    rn, total = F.col("rn"), F.col("n")
    return numbered.select(
        "o_orderkey", bucket_of(rn, total, 4).alias("quartile"), bucket_of(rn, total, 100).alias("centile")
    )


@query(
    "percent_rank",
    f"""SELECT o_custkey, {d('total')} AS total, {r('PERCENT_RANK() OVER (ORDER BY total)', 5)} AS contribution_rank
FROM (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1)""",
)
def _(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(F.sum(amount("o_totalprice")).alias("total"))
    ranked = rank_values(totals, "total", percent_rank="_share")
    return ranked.select("o_custkey", "total", rounded("_share", 5).alias("contribution_rank"))


@query(
    "dense_rank_cost",
    f"""SELECT l_partkey, quantity, {n('RANK() OVER (ORDER BY quantity DESC)')} AS quantity_rank,
       {n('DENSE_RANK() OVER (ORDER BY quantity DESC)')} AS cost_rank
FROM (SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1)""",
)
def _(t: Tables) -> DataFrame:
    parts = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
    return rank_values(parts, "quantity", descending=True, rank="quantity_rank", dense_rank="cost_rank")


def star_join(facts: DataFrame, dims: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Facts joined to dimensions given as (dim, fact column, dim column, how)."""
    out = facts
    for dim, left, right, how in dims:
        out = out.join(dim, out[left] == dim[right], how)
    return out


@query(
    "star_fact_sales",
    f"""WITH {LINES_SQL}
SELECT r_name AS region, p_brand AS brand, {n('year(o_orderdate)')} AS order_year, COUNT(*) AS line_count,
       {d('SUM(net)')} AS revenue, {d('SUM(tax_amount)')} AS tax
FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    joined = star_join(
        order_lines(t),
        [
            (t.orders.select("o_orderkey", "o_orderdate"), "l_orderkey", "o_orderkey", "inner"),
            (t.part.select("p_partkey", "p_brand"), "l_partkey", "p_partkey", "inner"),
            (t.supplier.select("s_suppkey", "s_nationkey"), "l_suppkey", "s_suppkey", "inner"),
            (t.nation.select("n_nationkey", "n_regionkey"), "s_nationkey", "n_nationkey", "inner"),
            (t.region, "n_regionkey", "r_regionkey", "inner"),
        ],
    )
    return joined.groupBy(
        F.col("r_name").alias("region"), F.col("p_brand").alias("brand"), F.year("o_orderdate").alias("order_year")
    ).agg(F.count(F.lit(1)).alias("line_count"), F.sum("net").alias("revenue"), F.sum("tax_amount").alias("tax"))


