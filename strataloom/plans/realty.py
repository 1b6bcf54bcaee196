"""Sales against assessed values, market medians, dispersion and agent reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, money, percent, ratio, rounded
from ..functions.temporal import quarter_label
from ..operators.aggregates import percentiles
from ..operators.joins import as_of
from ..operators.timeline import Cuts, Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, m, pct, r, ratio as sql_ratio
from .standins import LINES_SQL, TIER_SQL, account_cuts, order_lines, tier_history


def enrich_sales(
    sales: DataFrame, assessments: DataFrame, tolerance: float = 0.20, cuts: Cuts | None = None
) -> DataFrame:
    """Assessed value at the sale, ratio to the price, outlier flag and price per area."""
    placed = as_of(
        sales, assessments, ["parcel_id"], "sold_at", "valid_from", "valid_to", ["assessed_value", "tier"],
        cuts=cuts,
    )
    raw = F.col("assessed_value").cast("double") / F.nullif(F.col("sale_price").cast("double"), F.lit(0.0))
    return placed.withColumns(
        {
            "price_per_sqft": ratio("sale_price", "sqft", 2),
            "over_assessed_pct": percent(F.col("sale_price") - F.col("assessed_value"), "assessed_value"),
            "assessed_ratio": rounded(raw, 2),
            "outlier": F.coalesce(F.abs(raw - 1) > tolerance, F.lit(False)),
        }
    )


def market_trends(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Per place, type and quarter: median price, price per area and volume."""
    rows = sales.withColumn("sale_quarter", quarter_label("sold_at"))
    by = [*keys, "sale_quarter"]
    whole = F.count(F.lit(1))
    agg = rows.groupBy(*by).agg(
        ratio(F.sum(money("price_per_sqft")), F.count("price_per_sqft"), 2).alias("avg_price_per_sqft"),
        whole.alias("transactions"),
        ratio(F.lit(18.0), whole / 3.0, 1).alias("inventory_months"),
    )
    middle = percentiles(rows, by, "sale_price", {"_median": 0.5})
    return agg.join(middle, by).withColumn("median_price", rounded("_median", 2)).drop("_median")


def assessment_accuracy(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Median assessment ratio and the mean absolute deviation from it in percent (COD)."""
    whole = F.count(F.lit(1))
    agg = sales.groupBy(*keys).agg(
        whole.alias("total_sales"), flag_sum(F.col("outlier")).alias("outliers"),
        percent(flag_sum(F.col("outlier")), whole).alias("outlier_rate_pct"),
    )
    middle = percentiles(sales, keys, "assessed_ratio", {"_m": 0.5}).withColumn("median_ratio", rounded("_m", 2)).drop("_m")
    spread = (
        sales.join(middle, keys)
        .groupBy(*keys, "median_ratio")
        .agg((F.sum(F.abs(money("assessed_ratio") - money("median_ratio"))).cast("double") / whole).alias("_dev"))
        .select(*keys, "median_ratio", percent("_dev", "median_ratio", default=0).alias("cod"))
    )
    return agg.join(spread, keys)


# stand-ins: customers as parcels, their orders as sales, running order value as assessment


def order_sales(t: Tables) -> DataFrame:
    parcels = t.customer.select(
        F.col("c_custkey").alias("parcel_id"), "c_mktsegment", (F.col("c_nationkey") + 50).alias("sqft"), "c_nationkey"
    ).join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    sales = t.orders.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("parcel_id"), F.col("o_orderdate").alias("sold_at"),
        amount("o_totalprice").alias("sale_price"),
    ).join(
        parcels.select("parcel_id", "sqft", F.col("c_mktsegment").alias("property_type"), F.col("n_regionkey").alias("county")),
        "parcel_id",
    )
    cuts = account_cuts(t)
    values = tier_history(t, cuts).withColumnsRenamed({"account_id": "parcel_id", "spent": "assessed_value"})
    return enrich_sales(sales, values, cuts=cuts.renamed("account_id", "parcel_id"))


SALES_SQL = f"""{TIER_SQL},
sales AS (SELECT o_orderkey AS sale_id, o_custkey AS parcel_id, o_orderdate AS sold_at, {m('o_totalprice')} AS sale_price, c_nationkey + 50 AS sqft, c_mktsegment AS property_type,
  CAST(n_regionkey AS BIGINT) AS county, spent AS assessed_value, tier, {sql_ratio(m('o_totalprice'), '(c_nationkey + 50)', 2)} AS price_per_sqft,
  {pct(f"({m('o_totalprice')} - spent)", 'spent')} AS over_assessed_pct, {r(f"CAST(spent AS DOUBLE) / CAST({m('o_totalprice')} AS DOUBLE)", 2)} AS assessed_ratio,
  abs(CAST(spent AS DOUBLE) / CAST({m('o_totalprice')} AS DOUBLE) - 1) > 0.20 AS outlier
  FROM orders JOIN tiers ON o_custkey = account_id AND o_orderdate >= valid_from AND (valid_to IS NULL OR o_orderdate < valid_to)
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    "pit_sale_enrichment",
    f"WITH {SALES_SQL} SELECT sale_id, tier, {d('assessed_value')} AS assessed_value, price_per_sqft, over_assessed_pct, assessed_ratio, outlier FROM sales",
)
def _(t: Tables) -> DataFrame:
    return order_sales(t).select(
        "sale_id", "tier", "assessed_value", "price_per_sqft", "over_assessed_pct", "assessed_ratio", "outlier"
    )


@query(
    "market_median_quarter",
    f"""WITH {SALES_SQL}
SELECT county, property_type, CAST(year(sold_at) AS VARCHAR) || '-Q' || CAST(quarter(sold_at) AS VARCHAR) AS sale_quarter, {r('quantile_cont(CAST(sale_price AS DOUBLE), 0.5)', 2)} AS median_price,
  {sql_ratio('SUM(CAST(price_per_sqft AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS avg_price_per_sqft, COUNT(*) AS transactions, {sql_ratio('18.0', '(COUNT(*) / 3.0)', 1)} AS inventory_months
FROM sales GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return market_trends(pin(order_sales(t), "sales"), ["county", "property_type"])


@query(
    "assessment_cod",
    f"""WITH {SALES_SQL}, y AS (SELECT *, CAST(year(sold_at) AS BIGINT) AS sale_year FROM sales),
md AS (SELECT county, property_type, sale_year, {r('quantile_cont(assessed_ratio, 0.5)', 2)} AS median_ratio FROM y GROUP BY 1, 2, 3)
SELECT county, property_type, sale_year, COUNT(*) AS total_sales, COUNT(CASE WHEN outlier THEN 1 END) AS outliers, {pct('COUNT(CASE WHEN outlier THEN 1 END)', 'COUNT(*)')} AS outlier_rate_pct,
  median_ratio, COALESCE({pct('(CAST(SUM(abs(CAST(assessed_ratio AS DECIMAL(18,2)) - CAST(median_ratio AS DECIMAL(18,2)))) AS DOUBLE) / COUNT(*))', 'median_ratio')}, 0) AS cod
FROM y JOIN md USING (county, property_type, sale_year) GROUP BY 1, 2, 3, median_ratio""",
)
def _(t: Tables) -> DataFrame:
    sales = pin(order_sales(t).withColumn("sale_year", F.year("sold_at")), "sales")
    return assessment_accuracy(sales, ["county", "property_type", "sale_year"])


@query(
    "price_momentum",
    f"""WITH {SALES_SQL}, k AS (SELECT county, CAST(year(sold_at) AS VARCHAR) || '-Q' || CAST(quarter(sold_at) AS VARCHAR) AS sale_quarter, {r('quantile_cont(CAST(sale_price AS DOUBLE), 0.5)', 2)} AS median_price
  FROM sales WHERE property_type = 'HOUSEHOLD' GROUP BY 1, 2),
g AS (SELECT *, LAG(median_price) OVER (PARTITION BY county ORDER BY sale_quarter) AS previous FROM k)
SELECT county, sale_quarter, median_price, previous, {pct('(median_price - previous)', 'previous')} AS momentum_pct FROM g""",
)
def _(t: Tables) -> DataFrame:
    homes = pin(order_sales(t).filter("property_type = 'HOUSEHOLD'"), "homes")
    trend = market_trends(homes, ["county"])
    # one row per county and quarter
    before = F.lag("median_price").over(Window.partitionBy("county").orderBy("sale_quarter"))
    return trend.select("county", "sale_quarter", "median_price", before.alias("previous")).withColumn(
        "momentum_pct", percent(F.col("median_price") - F.col("previous"), "previous")
    )


@query(
    "repeat_sales",
    f"""WITH x AS (SELECT o_orderkey AS sale_id, o_custkey AS parcel_id, {m('o_totalprice')} AS p, LAG({m('o_totalprice')}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pp,
  COUNT(*) OVER (PARTITION BY o_custkey) AS k FROM orders)
SELECT sale_id, parcel_id, {d('p')} AS sale_price, {d('pp')} AS previous_price, {pct('(p - pp)', 'pp')} AS appreciation_pct FROM x WHERE k > 1""",
)
def _(t: Tables) -> DataFrame:
    sales = t.orders.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("parcel_id"),
        F.col("o_orderdate").alias("sold_at"), amount("o_totalprice").alias("sale_price"),
    )
    again = sales.groupBy("parcel_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("parcel_id")
    line = Timeline(sales, ["parcel_id"], ["sold_at", "sale_id"]).near(
        before=1, previous_price=lambda w: F.lag("sale_price").over(w)
    )
    return line.rows.join(again, "parcel_id", "left_semi").select(
        "sale_id", "parcel_id", "sale_price", "previous_price",
        percent(F.col("sale_price") - F.col("previous_price"), "previous_price").alias("appreciation_pct"),
    )


def average(c: str | Column, digits: int = 2) -> Column:
    return ratio(F.sum(c), F.count(c), digits)


@query(
    "agent_scorecard",
    f"""WITH {LINES_SQL}
SELECT s_suppkey, s_name, n_name AS nation, COUNT(*) AS deals, {d('SUM(net)')} AS volume, {sql_ratio('SUM(net)', 'COUNT(*)', 2)} AS avg_price,
  {sql_ratio('SUM(CAST(l_quantity AS BIGINT))', 'COUNT(*)', 1)} AS avg_quantity, {sql_ratio('SUM(CAST(l_discount AS DECIMAL(4,2)))', 'COUNT(*)', 4)} AS avg_discount
FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    sums = order_lines(t).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("deals"), F.sum("net").alias("volume"), average("net").alias("avg_price"),
        average(F.col("l_quantity").cast("bigint"), 1).alias("avg_quantity"),
        average(amount("l_discount"), 4).alias("avg_discount"),
    )
    people = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return sums.join(people, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "s_suppkey", "s_name", F.col("n_name").alias("nation"), "deals", "volume", "avg_price", "avg_quantity", "avg_discount"
    )


@query(
    "neighbourhood_benchmark",
    f"""SELECT n_name, r_name, COUNT(DISTINCT c_custkey) AS parcels, COUNT(o_orderkey) AS transactions, {sql_ratio('SUM(' + m('o_totalprice') + ')', 'COUNT(o_orderkey)', 2)} AS avg_price
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    # totals per customer first: nations are few and would be hot join keys
    totals = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_k"), F.sum(amount("o_totalprice")).alias("_s"))
    people = (
        t.customer.select("c_custkey", "c_nationkey")
        .join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("parcels"), F.sum("_k").alias("_k"), F.sum("_s").alias("_s"))
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return places.join(people, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_name", "r_name", F.coalesce("parcels", F.lit(0)).alias("parcels"),
        F.coalesce("_k", F.lit(0)).alias("transactions"), ratio("_s", "_k", 2).alias("avg_price"),
    )


@query(
    "property_type_comparison",
    f"""WITH {SALES_SQL}
SELECT property_type, COUNT(*) AS total_sales, {sql_ratio('SUM(sale_price)', 'COUNT(*)', 2)} AS avg_price, {r('quantile_cont(CAST(sale_price AS DOUBLE), 0.5)', 2)} AS median_price,
  {sql_ratio('SUM(CAST(price_per_sqft AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS avg_price_per_sqft FROM sales GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    sales = pin(order_sales(t).select("property_type", "sale_price", "price_per_sqft"), "sales")
    agg = sales.groupBy("property_type").agg(
        F.count(F.lit(1)).alias("total_sales"), average("sale_price").alias("avg_price"),
        average(money("price_per_sqft")).alias("avg_price_per_sqft"),
    )
    middle = percentiles(sales, ["property_type"], "sale_price", {"_m": 0.5})
    return agg.join(middle, "property_type").withColumn("median_price", rounded("_m", 2)).drop("_m")
