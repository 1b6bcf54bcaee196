"""Channels, RFM segments, funnels, sales dashboards and product reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, percent, ratio
from ..functions.temporal import days_between, month_start
from ..operators.aggregates import share_of_total
from ..operators.ranking import bucket_of, number_rows
from ..operators.sessions import number_day_sessions, number_sessions
from ..operators.upsert import soft_delete
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, day, m, n, pct, ratio as sql_ratio
from .standins import LINES_SQL, order_lines

AS_OF = "2001-12-31"


def unify_channels(feeds: dict[str, DataFrame]) -> DataFrame:
    """Order lines of all channels with line total and soft-delete columns; missing columns read NULL."""
    out = None
    for channel, df in feeds.items():
        part = df.withColumn("channel", F.lit(channel))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return line_totals(out)


def line_totals(lines: DataFrame) -> DataFrame:
    """Line total, and cancelled lines flagged as deleted."""
    one = F.lit(1).cast("decimal(4,2)")
    total = F.col("price") * (one - F.col("discount"))
    return soft_delete(lines.withColumn("line_total", total), F.col("status") == "cancelled", F.col("updated_at"))


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Quartile scores for recency, frequency and money (4 = best) and a segment.

    Customers without orders come last in every score.
    """
    stats = orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("amount").alias("total_revenue"),
        F.max("order_date").alias("last_order"),
    )
    base = customers.join(stats, "customer_id", "left").select(
        "customer_id",
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0)).cast("decimal(28,2)").alias("total_revenue"),
        days_between(F.to_date(F.lit(as_of)), "last_order").alias("recency_days"),
    )
    orders_of = {
        "r_score": [F.col("recency_days").desc_nulls_first(), "customer_id"],
        "f_score": [F.col("total_orders").asc(), "customer_id"],
        "m_score": [F.col("total_revenue").asc(), "customer_id"],
    }
    scored = base
    for name, order in orders_of.items():
        numbered = number_rows(scored, order, "_row", total="_all")
        scored = numbered.withColumn(name, bucket_of(F.col("_row"), F.col("_all"), 4)).drop("_row", "_all")
    r, f, m_ = F.col("r_score"), F.col("f_score"), F.col("m_score")
    total = r + f + m_
    segment = (
        F.when(total >= 10, "Champion")
        .when(total >= 8, "Loyal")
        .when(total >= 7, "Potential Loyalist")
        .when((r >= 3) & (m_ >= 3), "Big Spender")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 1) & (f <= 1), "Lost")
        .otherwise("Developing")
    )
    return scored.withColumn("rfm_total", total).withColumn("rfm_segment", segment)


def funnel_sessions(numbered: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Sessions with counts per funnel step and the furthest stage.

    ``stages`` has the keys browse, cart, checkout and purchase.
    """
    grouped = numbered.groupBy("customer_id", "session_no").agg(
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        *[flag_sum(c).alias(f"{name}_count") for name, c in stages.items()],
    )
    stage = (
        F.when(F.col("purchase_count") > 0, "purchased")
        .when(F.col("checkout_count") > 0, "checkout_abandoned")
        .when(F.col("cart_count") > 0, "cart_abandoned")
        .otherwise("browse_only")
    )
    key = F.concat(F.col("customer_id").cast("string"), F.lit("-"), F.col("session_no").cast("string"))
    return grouped.withColumn("funnel_stage", stage).withColumn("session_key", key)


def funnel_kpi(sessions: DataFrame, by: Column, name: str) -> DataFrame:
    """Sessions that reached each step and the conversion between steps."""
    steps = ("browse", "cart", "checkout", "purchase")
    counts = sessions.groupBy(by.alias(name)).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        *[flag_sum(F.col(f"{s}_count") > 0).alias(f"{s}_sessions") for s in steps],
    )
    pairs = {f"{a}_to_{b}_pct": percent(f"{b}_sessions", f"{a}_sessions", default=0) for a, b in zip(steps, steps[1:])}
    overall = {"overall_conversion_pct": percent("purchase_sessions", "total_sessions", default=0)}
    return counts.withColumns({**pairs, **overall})


def sales_dashboard(lines: DataFrame) -> DataFrame:
    """Month and channel: orders, revenue, order value, cancellations and repeat customers.

    An order has one customer, one channel and one month.
    """
    by = ["report_month", "channel"]
    kept = ~F.col("is_deleted")
    # one row per order, read twice below
    orders = pin(
        lines.groupBy("order_id").agg(
            F.min(month_start("order_date")).alias("report_month"),
            F.min("channel").alias("channel"),
            F.min("customer_id").alias("customer_id"),
            F.sum(F.when(kept, F.col("line_total")).otherwise(0)).alias("revenue"),
            F.bool_or(F.col("status") == "cancelled").alias("cancelled"),
            F.bool_or(kept).alias("kept"),
        ),
        "orders",
    )
    bought = orders.filter("kept")
    # a customer has at most as many places as there are months and channels
    customers = bought.groupBy("customer_id").agg(
        (F.count(F.lit(1)) > 1).alias("_repeat"), F.collect_set(F.struct(*by)).alias("_places")
    )
    sums = orders.groupBy(*by).agg(
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        flag_sum(F.col("cancelled")).alias("cancelled_orders"),
    )
    buyers = (
        customers.select("customer_id", "_repeat", F.explode("_places").alias("_p")).select("customer_id", "_repeat", "_p.*")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("unique_customers"), flag_sum(F.col("_repeat") & F.col("customer_id").isNotNull()).alias("repeat_customers"))
    )
    zero = F.lit(0)
    agg = sums.join(buyers, by, "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("unique_customers", "repeat_customers")}
    )
    return agg.withColumns(
        {
            "avg_order_value": ratio("total_revenue", "total_orders", 2, default=0),
            "cancellation_rate": ratio("cancelled_orders", "total_orders", 4, default=0),
            "repeat_rate_pct": percent("repeat_customers", "unique_customers", default=0),
        }
    )


def inventory_adjustments(lines: DataFrame) -> DataFrame:
    """Stock change per order line from its status."""
    back = F.col("status").isin("cancelled", "returned")
    return lines.select(
        "product_id",
        "order_id",
        F.when(F.col("status") == "cancelled", "restock")
        .when(F.col("status") == "delivered", "sold")
        .when(F.col("status") == "returned", "return_restock")
        .otherwise("reserved")
        .alias("change_type"),
        F.when(back, F.col("quantity")).otherwise(-F.col("quantity")).alias("quantity_delta"),
        F.concat(F.lit("status="), F.col("status")).alias("reason"),
    )


# stand-ins: order lines split into channels by priority, events as browsing


def order_status() -> Column:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((flag == "R") & (line == "F"), "returned")
        .when((flag == "A") & (line == "O"), "cancelled")
        .when(line == "F", "delivered")
        .otherwise("open")
    )


def sold_lines(t: Tables) -> DataFrame:
    return t.lineitem.join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    ).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        amount("l_extendedprice").cast("decimal(12,2)").alias("price"),
        amount("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("o_orderdate").alias("order_date"),
        order_status().alias("status"),
        F.col("l_shipdate").alias("updated_at"),
        "o_orderpriority",
    )


def channel_feeds(t: Tables) -> dict[str, DataFrame]:
    """The lines as three feeds; web and app lines carry a session, shop lines a store."""
    lines = sold_lines(t)
    p = F.col("o_orderpriority")
    web = lines.filter(p.isin("1-URGENT", "2-HIGH")).withColumn("session_id", F.lit("web"))
    mobile = lines.filter(p == "3-MEDIUM").withColumn("session_id", F.lit("app"))
    pos = lines.filter(p.isin("4-NOT SPECIFIED", "5-LOW")).withColumn("store_id", p)
    return {"web": web, "mobile": mobile, "pos": pos}


def channel_lines(t: Tables) -> DataFrame:
    """The same table in one pass, for reports that start from stored unified lines."""
    p = F.col("o_orderpriority")
    channel = F.when(p.isin("1-URGENT", "2-HIGH"), "web").when(p == "3-MEDIUM", "mobile").otherwise("pos")
    return line_totals(sold_lines(t).withColumn("channel", channel))


CHANNEL_SQL = f"""{LINES_SQL},
chan AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
    net AS line_total, o_orderdate AS order_date, l_shipdate AS updated_at,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web' WHEN o_orderpriority = '3-MEDIUM' THEN 'mobile' ELSE 'pos' END AS channel,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'returned' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'cancelled'
         WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'open' END AS status,
    l_returnflag = 'A' AND l_linestatus = 'O' AS is_deleted,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN o_orderpriority END AS store_id,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web' WHEN o_orderpriority = '3-MEDIUM' THEN 'app' END AS session_id
  FROM lines JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    "unify_channels",
    f"""WITH {CHANNEL_SQL}
SELECT order_id, customer_id, product_id, channel, quantity, {d('line_total')} AS line_total, status, is_deleted,
  CASE WHEN is_deleted THEN updated_at END AS cancelled_at, store_id, session_id FROM chan""",
)
def _(t: Tables) -> DataFrame:
    return unify_channels(channel_feeds(t)).select(
        "order_id", "customer_id", "product_id", "channel", "quantity", "line_total", "status", "is_deleted",
        "cancelled_at", "store_id", "session_id",
    )


@query(
    "sales_dashboard",
    f"""WITH {CHANNEL_SQL},
rep AS (SELECT customer_id FROM chan WHERE NOT is_deleted GROUP BY 1 HAVING COUNT(DISTINCT order_id) > 1),
agg AS (SELECT date_trunc('month', order_date) AS mon, channel, COUNT(DISTINCT order_id) AS o,
  SUM(CASE WHEN NOT is_deleted THEN line_total ELSE 0 END) AS rev,
  COUNT(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END) AS can,
  COUNT(DISTINCT CASE WHEN NOT is_deleted THEN customer_id END) AS cust,
  COUNT(DISTINCT CASE WHEN NOT is_deleted AND customer_id IN (SELECT customer_id FROM rep) THEN customer_id END) AS repc
  FROM chan GROUP BY 1, 2)
SELECT {day('mon')} AS report_month, channel, o AS total_orders, {d('rev')} AS total_revenue, can AS cancelled_orders,
  cust AS unique_customers, repc AS repeat_customers, COALESCE({sql_ratio('rev', 'o', 2)}, 0) AS avg_order_value,
  COALESCE({sql_ratio('can', 'o', 4)}, 0) AS cancellation_rate, COALESCE({pct('repc', 'cust')}, 0) AS repeat_rate_pct FROM agg""",
)
def _(t: Tables) -> DataFrame:
    return sales_dashboard(channel_lines(t))


@query(
    "inventory_adjustments",
    f"""WITH {CHANNEL_SQL}
SELECT product_id, order_id, CASE status WHEN 'cancelled' THEN 'restock' WHEN 'delivered' THEN 'sold'
  WHEN 'returned' THEN 'return_restock' ELSE 'reserved' END AS change_type,
  CASE WHEN status IN ('cancelled', 'returned') THEN quantity ELSE -quantity END AS quantity_delta,
  'status=' || status AS reason FROM chan""",
)
def _(t: Tables) -> DataFrame:
    return inventory_adjustments(channel_lines(t))


@query(
    "inventory_adjustment_totals",
    f"""WITH {CHANNEL_SQL}
SELECT status, COUNT(*) AS adjustment_count, {n("SUM(CASE WHEN status IN ('cancelled', 'returned') THEN quantity ELSE -quantity END)")} AS net_quantity
FROM chan GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    rows = inventory_adjustments(channel_lines(t))
    return rows.groupBy(F.regexp_replace("reason", "status=", "").alias("status")).agg(
        F.count(F.lit(1)).alias("adjustment_count"), F.sum("quantity_delta").alias("net_quantity")
    )


def customer_rfm(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"))
    orders = t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"),
        amount("o_totalprice").alias("amount"), F.col("o_orderdate").alias("order_date"),
    )
    return rfm_segments(customers, orders, AS_OF)


RFM_SQL = f"""
rfm_base AS (SELECT c_custkey AS customer_id, COUNT(o_orderkey) AS total_orders, COALESCE(SUM({m('o_totalprice')}), 0) AS total_revenue,
  date_diff('day', MAX(o_orderdate), TIMESTAMP '{AS_OF}') AS recency_days
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
rfm AS (SELECT *, NTILE(4) OVER (ORDER BY recency_days DESC NULLS FIRST, customer_id) AS r,
  NTILE(4) OVER (ORDER BY total_orders, customer_id) AS f, NTILE(4) OVER (ORDER BY total_revenue, customer_id) AS mm FROM rfm_base),
seg AS (SELECT *, r + f + mm AS total, CASE WHEN r + f + mm >= 10 THEN 'Champion' WHEN r + f + mm >= 8 THEN 'Loyal'
  WHEN r + f + mm >= 7 THEN 'Potential Loyalist' WHEN r >= 3 AND mm >= 3 THEN 'Big Spender' WHEN r <= 2 AND f >= 3 THEN 'At Risk'
  WHEN r <= 1 AND f <= 1 THEN 'Lost' ELSE 'Developing' END AS segment FROM rfm)"""


@query(
    "rfm_segments",
    f"""WITH {RFM_SQL}
SELECT customer_id, total_orders, {d('total_revenue')} AS total_revenue, {n('recency_days')} AS recency_days, {n('r')} AS r_score,
  {n('f')} AS f_score, {n('mm')} AS m_score, {n('total')} AS rfm_total, segment AS rfm_segment FROM seg""",
)
def _(t: Tables) -> DataFrame:
    return customer_rfm(t)


@query(
    "rfm_distribution",
    f"""WITH {RFM_SQL}
SELECT segment AS rfm_segment, COUNT(*) AS customers, {sql_ratio('SUM(total_orders)', 'COUNT(*)', 1)} AS avg_orders,
  {sql_ratio('SUM(total_revenue)', 'COUNT(*)', 2)} AS avg_revenue FROM seg GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return customer_rfm(t).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        ratio(F.sum("total_orders"), F.count(F.lit(1)), 1).alias("avg_orders"),
        ratio(F.sum("total_revenue"), F.count(F.lit(1)), 2).alias("avg_revenue"),
    )


def browsing(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_ts"), "event_type"
    )


def event_stages() -> dict[str, Column]:
    kind = F.col("event_type")
    return {
        "browse": kind == "view", "cart": kind == "click",
        "checkout": kind == "signup", "purchase": kind == "purchase",
    }


def event_sessions(t: Tables) -> DataFrame:
    numbered = number_sessions(browsing(t), ["customer_id"], "event_ts", 43200, ["event_id"])
    return funnel_sessions(numbered, event_stages())


def _sessions_sql(gap: str) -> str:
    return f"""
marked AS (SELECT *, CASE WHEN {gap} THEN 0 ELSE 1 END AS brk FROM (
  SELECT user_id, event_id, ts, event_type, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)),
numbered AS (SELECT *, CAST(SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS no FROM marked),
sess AS (SELECT user_id, no, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS event_count,
  COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS browse_count, COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS cart_count,
  COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS checkout_count, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase_count
  FROM numbered GROUP BY 1, 2)"""


SESSION_SQL = _sessions_sql("epoch_us(ts) - epoch_us(prev) <= 43200000000")


@query(
    "sessions_30min",
    f"WITH {_sessions_sql('epoch_us(ts) - epoch_us(prev) <= 1800000000')} SELECT event_id, user_id AS customer_id, no AS session_no FROM numbered",
)
def _(t: Tables) -> DataFrame:
    return number_sessions(browsing(t), ["customer_id"], "event_ts", 1800, ["event_id"]).select(
        "event_id", "customer_id", "session_no"
    )


@query(
    "sessions_by_day_gap",
    f"WITH {_sessions_sql('CAST(ts AS DATE) - CAST(prev AS DATE) <= 0')} SELECT event_id, user_id AS customer_id, no AS session_no FROM numbered",
)
def _(t: Tables) -> DataFrame:
    return number_day_sessions(browsing(t), ["customer_id"], "event_ts", 0, ["event_id"]).select(
        "event_id", "customer_id", "session_no"
    )


@query(
    "funnel_stage",
    f"""WITH {SESSION_SQL}
SELECT CAST(user_id AS VARCHAR) || '-' || CAST(no AS VARCHAR) AS session_key, user_id AS customer_id, no AS session_no, session_start,
  session_end, event_count, browse_count, cart_count, checkout_count, purchase_count,
  CASE WHEN purchase_count > 0 THEN 'purchased' WHEN checkout_count > 0 THEN 'checkout_abandoned'
       WHEN cart_count > 0 THEN 'cart_abandoned' ELSE 'browse_only' END AS funnel_stage FROM sess""",
)
def _(t: Tables) -> DataFrame:
    return event_sessions(t)


@query(
    "funnel_conversion",
    f"""WITH {SESSION_SQL},
k AS (SELECT CAST(session_start AS DATE) AS dt, COUNT(*) AS total, COUNT(CASE WHEN browse_count > 0 THEN 1 END) AS b,
  COUNT(CASE WHEN cart_count > 0 THEN 1 END) AS c, COUNT(CASE WHEN checkout_count > 0 THEN 1 END) AS o,
  COUNT(CASE WHEN purchase_count > 0 THEN 1 END) AS p FROM sess GROUP BY 1)
SELECT {day('dt')} AS report_day, total AS total_sessions, b AS browse_sessions, c AS cart_sessions, o AS checkout_sessions,
  p AS purchase_sessions, COALESCE({pct('c', 'b')}, 0) AS browse_to_cart_pct, COALESCE({pct('o', 'c')}, 0) AS cart_to_checkout_pct,
  COALESCE({pct('p', 'o')}, 0) AS checkout_to_purchase_pct, COALESCE({pct('p', 'total')}, 0) AS overall_conversion_pct FROM k""",
)
def _(t: Tables) -> DataFrame:
    return funnel_kpi(event_sessions(t), F.col("session_start").cast("date"), "report_day")


@query(
    "top_products",
    f"""WITH {LINES_SQL}
SELECT p_partkey, p_name, p_brand, {n('SUM(l_quantity)')} AS units, {d('SUM(net)')} AS revenue,
  {d("SUM(net) - SUM(l_quantity::DECIMAL(12,2) * p_retailprice::DECIMAL(12,2))")} AS gross_profit,
  {pct("(SUM(net) - SUM(l_quantity::DECIMAL(12,2) * p_retailprice::DECIMAL(12,2)))", 'SUM(net)')} AS margin_pct
FROM lines JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3 ORDER BY SUM(net) DESC, p_partkey LIMIT 5""",
)
def _(t: Tables) -> DataFrame:
    sums = order_lines(t).groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).cast("decimal(18,0)").alias("units"), F.sum("net").alias("revenue")
    )
    cost = F.col("units") * amount("p_retailprice")
    top = sums.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("gross_profit", F.col("revenue") - cost)
    top = top.orderBy(F.col("revenue").desc(), "p_partkey").limit(5)
    return top.select(
        "p_partkey", "p_name", "p_brand", F.col("units").cast("bigint").alias("units"), "revenue", "gross_profit",
        percent("gross_profit", "revenue").alias("margin_pct"),
    )


@query(
    "cumulative_revenue",
    f"""WITH mo AS (SELECT {n('year(o_orderdate)')} AS y, {n('month(o_orderdate)')} AS mo, monthname(o_orderdate) AS month_name, COUNT(*) AS monthly_orders,
  SUM({m('o_totalprice')}) AS rev FROM orders GROUP BY 1, 2, 3)
SELECT y AS year, mo AS month, month_name, monthly_orders, {d('rev')} AS monthly_revenue, {d('SUM(rev) OVER (ORDER BY y, mo)')} AS cumulative_revenue FROM mo""",
)
def _(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.date_format("o_orderdate", "MMMM").alias("month_name"),
    ).agg(F.count(F.lit(1)).alias("monthly_orders"), F.sum(amount("o_totalprice")).alias("monthly_revenue"))
    # one row per month
    so_far = Window.orderBy("year", "month")
    return monthly.withColumn("cumulative_revenue", F.sum("monthly_revenue").over(so_far))


@query(
    "category_share",
    f"""WITH {LINES_SQL}, c AS (SELECT p_brand, SUM(net) AS rev FROM lines JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand AS category, {d('rev')} AS revenue, {n('RANK() OVER (ORDER BY rev DESC)')} AS revenue_rank,
  {pct('rev', '(SUM(rev) OVER ())')} AS pct_of_total FROM c""",
)
def _(t: Tables) -> DataFrame:
    sales = order_lines(t).join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    brands = sales.groupBy(F.col("p_brand").alias("category")).agg(F.sum("net").alias("revenue"))
    # one row per category
    ranked = brands.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("revenue").desc())))
    return share_of_total(pin(ranked, "categories"), "revenue", "pct_of_total")
