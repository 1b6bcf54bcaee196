"""Inventory positions, fulfilment, demand signals, scorecards and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, percent, ratio, rounded
from ..functions.temporal import days_between, month_start, seconds_between
from ..operators.joins import as_of, left_if_named, through_history
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, day, m, n, pct, r, ratio as sql_ratio, sec

SAFETY = 1.5


def inventory_positions(movements: DataFrame) -> DataFrame:
    """Stock per warehouse and product from signed movements."""
    kind, q = F.col("movement_type"), F.col("quantity")

    def part(test: Column, value: Column) -> Column:
        return F.sum(F.when(test, value).otherwise(0))

    return movements.groupBy("warehouse_id", "sku").agg(
        F.sum("quantity").alias("on_hand"),
        part(kind == "receipt", q).alias("total_received"),
        part(kind == "pick", F.abs(q)).alias("total_picked"),
        part(kind == "ship", F.abs(q)).alias("total_shipped"),
        part(kind.isin("cycle_count", "adjustment"), q).alias("total_adjusted"),
        F.max("moved_at").alias("last_movement"),
    )


def order_fulfilment(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """Fill rate, days to receive and on-time flag of each purchase order."""
    got = receipts.groupBy("po_id").agg(F.sum("quantity").alias("qty_received"), F.max("received_at").alias("received_at"))
    return fulfilment_metrics(orders.join(got, "po_id", "left"))


def fulfilment_metrics(orders: DataFrame) -> DataFrame:
    """The same for orders that already carry their received quantity and time."""
    received = F.coalesce("qty_received", F.lit(0))
    return orders.withColumns(
        {
            "qty_received": received,
            "fill_rate": ratio(received, "qty_ordered", 4),
            "days_to_receive": days_between("received_at", "ordered_at"),
            "on_time": F.coalesce(F.col("received_at") <= F.col("expected_at"), F.lit(False)),
        }
    )


def shipment_tracking(events: DataFrame) -> DataFrame:
    """Latest event with milestones pivoted into columns and transit hours."""
    kind, at = F.col("event_type"), F.col("event_time")
    marks = events.groupBy("shipment_id").agg(
        F.max_by("event_type", F.struct("event_time", "event_id")).alias("current_status"),
        F.count(F.lit(1)).alias("total_events"),
        F.bool_or(kind == "exception").alias("has_exception"),
        F.bool_or(kind == "customs_hold").alias("has_customs_hold"),
        F.min(F.when(kind == "dispatched", at)).alias("dispatched_at"),
        F.max(F.when(kind == "delivered", at)).alias("delivered_at"),
    )
    hours = seconds_between("delivered_at", "dispatched_at") / 3600
    return marks.withColumn("transit_hours", rounded(hours, 2))


def lifecycle(orders: DataFrame, movements: DataFrame, references: DataFrame, tracking: DataFrame) -> DataFrame:
    """Purchase orders with the first shipment that left their warehouse after the receipt, and how that fared.

    ``references`` leads from the order of a shipment's movement to the shipment
    and its carrier. Of several movements at one time the smallest order counts.
    Many orders have no such shipment.
    """
    ships = movements.filter("movement_type = 'ship'").groupBy("warehouse_id", "sku", F.col("moved_at").alias("next_ship")).agg(
        F.min("l_orderkey").alias("shipment_order")
    )
    placed = as_of(
        orders, ships, ["warehouse_id", "sku"], "received_at", "next_ship", None, ["next_ship", "shipment_order"], how="left",
        direction="forward", strict=True,
    )
    fared = tracking.select("shipment_id", "current_status", "transit_hours", "has_exception")
    carried = references.join(fared, "shipment_id", "left")
    joined = left_if_named(placed, carried, "shipment_order", "reference", ["l_orderkey", "l_suppkey", "sku"])
    return joined.select(
        "l_orderkey", "l_suppkey", "sku", "fill_rate", "on_time", "received_at", "next_ship",
        days_between("next_ship", "received_at").alias("days_on_shelf"), "shipment_order", "shipment_id", "carrier_id",
        F.col("current_status").alias("shipment_status"), "transit_hours", F.col("has_exception").alias("shipment_exception"),
    )


def demand_signals(sales: DataFrame, store_map: DataFrame, stock: DataFrame) -> DataFrame:
    """Net demand, moving average over seven rows and stock-out risk at the nearest warehouse.

    ``sales`` has one row per store, product and period, so a window holds one
    store's periods only. A store with several warehouses gives a row for each.
    """
    recent = Window.partitionBy("store_id", "sku").orderBy("period").rowsBetween(-6, 0)
    moving = sales.withColumn("demand_avg", ratio(F.sum("net_sold").over(recent), F.count(F.lit(1)).over(recent), 4))
    joined = moving.join(store_map, "store_id", "left").join(
        stock.select(F.col("warehouse_id").alias("nearest_wh"), "sku", "on_hand"), ["nearest_wh", "sku"], "left"
    )
    held = F.coalesce("on_hand", F.lit(0))
    risk = F.when(held <= 0, "critical").when(F.col("demand_avg") > held * 0.8, "warning").otherwise("healthy")
    return joined.withColumn("on_hand", held).withColumn("stockout_risk", risk)


def inventory_fact(stock: DataFrame, in_transit: DataFrame, on_order: DataFrame, demand: DataFrame, lead: DataFrame) -> DataFrame:
    """Total position, days of supply and reorder flag."""
    keys = ["warehouse_id", "sku"]
    joined = (
        stock.join(in_transit, keys, "left").join(on_order, keys, "left").join(demand, keys, "left").join(lead, "sku", "left")
    )
    zero = F.lit(0)
    rows = joined.withColumns(
        {c: F.coalesce(c, zero) for c in ("in_transit", "on_order", "avg_demand", "lead_days")}
    )
    supply = F.when(F.col("avg_demand") > 0, ratio("on_hand", "avg_demand", 2))
    return rows.withColumns(
        {
            "total_position": F.col("on_hand") + F.col("in_transit") + F.col("on_order"),
            "days_of_supply": supply,
            "reorder": F.coalesce(supply < F.col("lead_days"), F.lit(False)),
        }
    )


def inventory_health(facts: DataFrame, totals: DataFrame) -> DataFrame:
    """Safety stock, yearly turnover and status."""
    safety = F.col("avg_demand") * F.col("lead_days") * SAFETY
    over = (F.col("avg_demand") > 0) & (F.col("on_hand") > safety * 2)
    rows = facts.join(totals, ["warehouse_id", "sku"], "left")
    yearly = F.col("total_sold").cast("double") / F.col("periods") * 365.0
    status = (
        F.when(F.col("on_hand") <= 0, "stockout")
        .when(F.col("days_of_supply") < F.col("lead_days"), "critical")
        .when(F.col("days_of_supply") < F.col("lead_days") * 2, "warning")
        .when(over, "overstock")
        .otherwise("healthy")
    )
    return rows.withColumns(
        {
            "safety_stock": rounded(safety, 2),
            "overstock": over,
            "turnover": F.when(F.col("on_hand") > 0, ratio(yearly, "on_hand", 2, default=0)).otherwise(0.0),
            "health_status": status,
        }
    )


def supplier_scorecard(orders: DataFrame) -> DataFrame:
    """40 % on time, 30 % fill rate, 20 % without exceptions, 10 % speed."""
    agg = orders.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        ratio(flag_sum(F.col("on_time")), F.count(F.lit(1)), 4).alias("on_time_share"),
        ratio(F.sum(F.col("fill_rate").cast("decimal(18,4)")), F.count("fill_rate"), 4).alias("avg_fill_rate"),
        ratio(F.sum("days_to_receive"), F.count("days_to_receive"), 2).alias("avg_lead_days"),
        ratio(flag_sum(F.col("exception")), F.count(F.lit(1)), 4).alias("defect_rate"),
        F.sum("total_cost").alias("total_spend"),
    )
    lead = F.col("avg_lead_days")
    speed = F.when(lead <= 7, 1.0).when(lead <= 10, 0.8).when(lead <= 14, 0.6).otherwise(0.4)
    score = (
        F.lit(0.40) * F.col("on_time_share")
        + F.lit(0.30) * F.col("avg_fill_rate")
        + F.lit(0.20) * (F.lit(1.0) - F.col("defect_rate"))
        + F.lit(0.10) * speed
    )
    return agg.withColumn("composite_score", rounded(score, 4))


def demand_forecast(signals: DataFrame, lead: DataFrame) -> DataFrame:
    """Trend slope, variability, safety stock and days to stock-out per store and product."""
    before = F.lag("demand_avg").over(Window.partitionBy("store_id", "sku", "nearest_wh").orderBy("period"))
    moved = signals.withColumn("_delta", F.col("demand_avg") - before)
    net = F.col("net_sold").cast("double")
    stats = moved.groupBy("store_id", "sku", "nearest_wh").agg(
        ratio(F.sum("net_sold"), F.count(F.lit(1)), 4).alias("avg_demand"),
        F.max("demand_avg").alias("peak"),
        F.min("demand_avg").alias("trough"),
        rounded(F.stddev_samp(net), 4).alias("demand_stddev"),
        rounded(F.var_samp(net), 2).alias("demand_variance"),
        ratio(F.sum(F.col("_delta").cast("decimal(18,4)")), F.count("_delta"), 4).alias("trend"),
        F.max("on_hand").alias("on_hand"),
        F.count(F.lit(1)).alias("observations"),
    )
    trend = F.col("trend")
    label = F.when(trend > 1, "accelerating").when(trend > 0, "growing").when(trend > -1, "stable").otherwise("declining")
    return stats.join(lead, "sku", "left").withColumns(
        {
            "trend_label": label,
            "seasonality": F.when(F.col("avg_demand") > 0, ratio("demand_stddev", "avg_demand", 4)).otherwise(0.0),
            "safety_stock": rounded(F.col("avg_demand") * F.coalesce("lead_days", F.lit(10)) * SAFETY, 2),
            "days_until_stockout": F.when(F.col("avg_demand") > 0, ratio("on_hand", "avg_demand", 2)),
        }
    )


# stand-ins: supplier nations as warehouses, part types as products, customer nations as stores


def _lines(t: Tables, columns: Sequence[str], order: bool = False, store: bool = False, warehouse: bool = False) -> DataFrame:
    """Lines with their product, and only the other tables that are asked for."""
    out = t.lineitem.withColumn("quantity", F.col("l_quantity").cast("bigint")).join(
        t.part.select("p_partkey", F.col("p_type").alias("sku")), F.col("l_partkey") == F.col("p_partkey")
    )
    if order or store:
        heads = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        if store:
            buyers = t.customer.select("c_custkey", F.col("c_nationkey").alias("store_id"))
            heads = heads.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        out = out.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    if warehouse:
        places = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("warehouse_id"))
        out = out.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return out.select("l_orderkey", "l_suppkey", "quantity", "l_extendedprice", "sku", *columns)


def wide_lines(t: Tables) -> DataFrame:
    return _lines(t, ["l_partkey", "store_id", "warehouse_id"], store=True, warehouse=True)


def stock_lines(t: Tables) -> DataFrame:
    return _lines(t, ["l_returnflag", "l_linestatus", "l_shipdate", "warehouse_id"], warehouse=True)


def purchase_lines(t: Tables) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "warehouse_id"]
    return _lines(t, columns, order=True, warehouse=True)


def demand_lines(t: Tables) -> DataFrame:
    return _lines(t, ["l_returnflag", "l_shipdate", "store_id"], store=True)


def stock_movements(lines: DataFrame) -> DataFrame:
    """Finished lines are receipts, accepted ones picks, returned open ones adjustments, others ships."""
    flag = F.col("l_returnflag")
    kind = (
        F.when(F.col("l_linestatus") == "F", "receipt").when(flag == "A", "pick").when(flag == "R", "adjustment").otherwise("ship")
    )
    rows = lines.withColumn("movement_type", kind)
    sign = F.when(F.col("movement_type").isin("receipt", "adjustment"), F.col("quantity")).otherwise(-F.col("quantity"))
    return rows.select(
        "warehouse_id", "sku", "movement_type", sign.alias("quantity"), F.col("l_shipdate").alias("moved_at"),
        "l_orderkey", "l_suppkey",
    )


WIDE_SQL = """
wide AS (SELECT l_orderkey, l_suppkey, l_partkey, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate, o_orderdate, o_orderpriority,
  CAST(c_nationkey AS BIGINT) AS store_id, CAST(s_nationkey AS BIGINT) AS warehouse_id, p_type AS sku FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
moves AS (SELECT *, CASE WHEN kind IN ('receipt', 'adjustment') THEN quantity ELSE -quantity END AS q FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 'receipt' WHEN l_returnflag = 'A' THEN 'pick'
  WHEN l_returnflag = 'R' THEN 'adjustment' ELSE 'ship' END AS kind FROM wide)),
stock AS (SELECT warehouse_id, sku, CAST(SUM(q) AS BIGINT) AS on_hand, CAST(SUM(CASE WHEN kind = 'receipt' THEN q ELSE 0 END) AS BIGINT) AS total_received,
  CAST(SUM(CASE WHEN kind = 'pick' THEN abs(q) ELSE 0 END) AS BIGINT) AS total_picked, CAST(SUM(CASE WHEN kind = 'ship' THEN abs(q) ELSE 0 END) AS BIGINT) AS total_shipped,
  CAST(SUM(CASE WHEN kind = 'adjustment' THEN q ELSE 0 END) AS BIGINT) AS total_adjusted, MAX(l_shipdate) AS last_movement FROM moves GROUP BY 1, 2)"""
PO_SQL = f"""{WIDE_SQL},
po AS (SELECT l_orderkey, l_suppkey, sku, MIN(o_orderdate) AS ordered_at, CAST(SUM(quantity) AS BIGINT) AS qty_ordered, SUM({m('l_extendedprice')}) AS total_cost, bool_or(l_returnflag = 'R') AS exception,
  MIN(warehouse_id) AS warehouse_id,
  CAST(SUM(CASE WHEN l_linestatus = 'F' THEN quantity END) AS BIGINT) AS got, MAX(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS received_at FROM wide GROUP BY 1, 2, 3),
ful AS (SELECT *, COALESCE(got, 0) AS qty_received, {sql_ratio('COALESCE(got, 0)', 'qty_ordered', 4)} AS fill_rate, date_diff('day', ordered_at, received_at) AS days_to_receive,
  COALESCE(received_at <= ordered_at + INTERVAL 120 DAY, FALSE) AS on_time FROM po)"""


def purchase_orders(lines: DataFrame) -> DataFrame:
    """One purchase order per order, supplier and product, expected after 120 days, with what was received."""
    done = F.col("l_linestatus") == "F"
    orders = lines.groupBy("l_orderkey", "l_suppkey", "sku").agg(
        F.min("o_orderdate").alias("ordered_at"),
        F.sum("quantity").alias("qty_ordered"),
        F.sum(amount("l_extendedprice")).alias("total_cost"),
        F.bool_or(F.col("l_returnflag") == "R").alias("exception"),
        F.min("warehouse_id").alias("warehouse_id"),
        F.sum(F.when(done, F.col("quantity"))).alias("qty_received"),
        F.max(F.when(done, F.col("l_shipdate"))).alias("received_at"),
    )
    return orders.withColumns(
        {"po_id": F.concat_ws("-", "l_orderkey", "l_suppkey", "sku"), "expected_at": F.col("ordered_at") + F.make_dt_interval(F.lit(120))}
    )


def fulfilled(lines: DataFrame) -> DataFrame:
    return fulfilment_metrics(purchase_orders(lines))


@query("inventory_position", f"WITH {WIDE_SQL} SELECT * FROM stock")
def _(t: Tables) -> DataFrame:
    return inventory_positions(stock_movements(stock_lines(t)))


@query(
    "fulfilment",
    f"""WITH {PO_SQL} SELECT l_orderkey, l_suppkey, sku, qty_ordered, qty_received, fill_rate, {n('days_to_receive')} AS days_to_receive, on_time, {d('total_cost')} AS total_cost FROM ful""",
)
def _(t: Tables) -> DataFrame:
    """Orders and their receipts as two tables."""
    done = _lines(t, ["l_linestatus", "l_shipdate"]).filter("l_linestatus = 'F'")
    receipts = done.select(
        F.concat_ws("-", "l_orderkey", "l_suppkey", "sku").alias("po_id"), "quantity", F.col("l_shipdate").alias("received_at")
    )
    orders = purchase_orders(purchase_lines(t)).drop("qty_received", "received_at")
    return order_fulfilment(orders, receipts).select(
        "l_orderkey", "l_suppkey", "sku", "qty_ordered", "qty_received", "fill_rate", "days_to_receive", "on_time",
        "total_cost",
    )


@query(
    "supplier_scorecard",
    f"""WITH {PO_SQL},
a AS (SELECT l_suppkey AS supplier_id, COUNT(*) AS total_orders, {sql_ratio('COUNT(CASE WHEN on_time THEN 1 END)', 'COUNT(*)', 4)} AS on_time_share, {sql_ratio('SUM(CAST(fill_rate AS DECIMAL(18,4)))', 'COUNT(fill_rate)', 4)} AS avg_fill_rate,
  {sql_ratio('SUM(days_to_receive)', 'COUNT(days_to_receive)', 2)} AS avg_lead_days, {sql_ratio('COUNT(CASE WHEN exception THEN 1 END)', 'COUNT(*)', 4)} AS defect_rate, {d('SUM(total_cost)')} AS total_spend FROM ful GROUP BY 1)
SELECT *, {r("0.40::DOUBLE * on_time_share + 0.30::DOUBLE * avg_fill_rate + 0.20::DOUBLE * (1.0::DOUBLE - defect_rate) + 0.10::DOUBLE * CASE WHEN avg_lead_days <= 7 THEN 1.0 WHEN avg_lead_days <= 10 THEN 0.8 WHEN avg_lead_days <= 14 THEN 0.6 ELSE 0.4 END::DOUBLE", 4)} AS composite_score FROM a""",
)
def _(t: Tables) -> DataFrame:
    return supplier_scorecard(fulfilled(purchase_lines(t)).withColumnRenamed("l_suppkey", "supplier_id"))


def store_demand(lines: DataFrame) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    sold = F.sum(F.when(returned, 0).otherwise(F.col("quantity")))
    back = F.sum(F.when(returned, F.col("quantity")).otherwise(0))
    return lines.groupBy("store_id", "sku", month_start("l_shipdate").alias("period")).agg(
        sold.alias("qty_sold"), back.alias("qty_returned"), F.sum(amount("l_extendedprice")).alias("revenue")
    ).withColumn("net_sold", F.col("qty_sold") - F.col("qty_returned"))


def region_map(t: Tables) -> DataFrame:
    """Stores and warehouses of one region: nations on both sides."""
    a = t.nation.select(F.col("n_nationkey").alias("store_id"), "n_regionkey")
    b = t.nation.select(F.col("n_nationkey").alias("nearest_wh"), F.col("n_regionkey").alias("_r"))
    return a.join(b, F.col("n_regionkey") == F.col("_r")).select("store_id", "nearest_wh")


def signals(t: Tables) -> DataFrame:
    stock = inventory_positions(stock_movements(stock_lines(t)))
    return demand_signals(store_demand(demand_lines(t)), region_map(t), stock)


SIGNAL_SQL = f"""{PO_SQL},
dem AS (SELECT store_id, sku, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE quantity END) AS BIGINT) AS qty_sold,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN quantity ELSE 0 END) AS BIGINT) AS qty_returned, SUM({m('l_extendedprice')}) AS revenue FROM wide GROUP BY 1, 2, 3),
net AS (SELECT *, qty_sold - qty_returned AS net_sold FROM dem),
mov AS (SELECT *, {sql_ratio('(SUM(net_sold) OVER w)', '(COUNT(*) OVER w)', 4)} AS demand_avg FROM net WINDOW w AS (PARTITION BY store_id, sku ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
sig AS (SELECT mov.*, CAST(b.n_nationkey AS BIGINT) AS nearest_wh, COALESCE(stock.on_hand, 0) AS on_hand, CASE WHEN COALESCE(stock.on_hand, 0) <= 0 THEN 'critical'
  WHEN demand_avg > COALESCE(stock.on_hand, 0) * 0.8 THEN 'warning' ELSE 'healthy' END AS stockout_risk
  FROM mov JOIN nation a ON store_id = a.n_nationkey JOIN nation b ON a.n_regionkey = b.n_regionkey LEFT JOIN stock ON stock.warehouse_id = b.n_nationkey AND stock.sku = mov.sku)"""


@query(
    "demand_signals",
    f"WITH {SIGNAL_SQL} SELECT store_id, sku, {day('period')} AS period, nearest_wh, net_sold, demand_avg, on_hand, stockout_risk FROM sig",
)
def _(t: Tables) -> DataFrame:
    return signals(t).select("store_id", "sku", "period", "nearest_wh", "net_sold", "demand_avg", "on_hand", "stockout_risk")


def lead_times(orders: DataFrame) -> DataFrame:
    return orders.groupBy("sku").agg(ratio(F.sum("days_to_receive"), F.count("days_to_receive"), 2).alias("lead_days"))


def open_orders(orders: DataFrame, moves: DataFrame) -> DataFrame:
    """Units not received yet, at the warehouses that got earlier orders of the supplier."""
    receipts = moves.filter("movement_type = 'receipt'")
    placed = through_history(orders.filter("qty_received = 0"), receipts, "l_suppkey", "warehouse_id")
    return placed.groupBy("warehouse_id", "sku").agg(F.sum("qty_ordered").alias("on_order"))


def stock_facts(t: Tables) -> tuple[DataFrame, DataFrame]:
    # one row per warehouse, product, kind and supplier: what all sums below need
    moves = pin(
        stock_movements(stock_lines(t))
        .groupBy("warehouse_id", "sku", "movement_type", "l_suppkey")
        .agg(F.sum("quantity").alias("quantity"), F.max("moved_at").alias("moved_at")),
        "moves",
    )
    stock = pin(inventory_positions(moves).select("warehouse_id", "sku", "on_hand"), "stock")
    orders = pin(fulfilled(purchase_lines(t)).select("l_suppkey", "sku", "qty_ordered", "qty_received", "days_to_receive"), "orders")
    in_transit = moves.filter("movement_type = 'ship'").groupBy("warehouse_id", "sku").agg(
        F.sum(F.abs("quantity")).alias("in_transit")
    )
    on_order = open_orders(orders, moves)
    sold = pin(demand_signals(store_demand(demand_lines(t)), region_map(t), stock), "signals")
    demand = sold.groupBy(F.col("nearest_wh").alias("warehouse_id"), "sku").agg(
        ratio(F.sum("net_sold"), F.count(F.lit(1)), 4).alias("avg_demand")
    )
    totals = sold.groupBy(F.col("nearest_wh").alias("warehouse_id"), "sku").agg(
        F.sum("net_sold").alias("total_sold"), F.count_distinct("period").alias("periods")
    )
    return inventory_fact(stock, in_transit, on_order, demand, lead_times(orders)), totals


OPEN_SQL = """rec AS (SELECT DISTINCT l_suppkey, warehouse_id FROM moves WHERE kind = 'receipt'),
oo AS (SELECT rec.warehouse_id, sku, CAST(SUM(qty_ordered) AS BIGINT) AS on_order FROM ful LEFT JOIN rec ON rec.l_suppkey = ful.l_suppkey WHERE qty_received = 0 GROUP BY 1, 2)"""


@query("open_orders_by_history", f"WITH {PO_SQL}, {OPEN_SQL} SELECT warehouse_id, sku, on_order FROM oo")
def _(t: Tables) -> DataFrame:
    return open_orders(fulfilled(purchase_lines(t)).drop("warehouse_id"), stock_movements(stock_lines(t)))


FACT_SQL = f"""{SIGNAL_SQL},
lead AS (SELECT sku, {sql_ratio('SUM(days_to_receive)', 'COUNT(days_to_receive)', 2)} AS lead_days FROM ful GROUP BY 1),
tr AS (SELECT warehouse_id, sku, CAST(SUM(abs(q)) AS BIGINT) AS in_transit FROM moves WHERE kind = 'ship' GROUP BY 1, 2),
{OPEN_SQL},
ad AS (SELECT nearest_wh, sku, {sql_ratio('SUM(net_sold)', 'COUNT(*)', 4)} AS avg_demand, CAST(SUM(net_sold) AS BIGINT) AS total_sold, COUNT(DISTINCT period) AS periods FROM sig GROUP BY 1, 2),
fact AS (SELECT stock.warehouse_id, stock.sku, on_hand, COALESCE(in_transit, 0) AS in_transit, COALESCE(on_order, 0) AS on_order, COALESCE(avg_demand, 0) AS avg_demand, COALESCE(lead_days, 0) AS lead_days,
  on_hand + COALESCE(in_transit, 0) + COALESCE(on_order, 0) AS total_position, CASE WHEN avg_demand > 0 THEN {sql_ratio('on_hand', 'avg_demand', 2)} END AS days_of_supply, total_sold, periods
  FROM stock LEFT JOIN tr ON tr.warehouse_id = stock.warehouse_id AND tr.sku = stock.sku LEFT JOIN oo ON oo.warehouse_id = stock.warehouse_id AND oo.sku = stock.sku
  LEFT JOIN ad ON nearest_wh = stock.warehouse_id AND ad.sku = stock.sku LEFT JOIN lead ON lead.sku = stock.sku)"""


@query(
    "inventory_fact",
    f"""WITH {FACT_SQL} SELECT warehouse_id, sku, on_hand, in_transit, on_order, avg_demand, lead_days, total_position, days_of_supply, COALESCE(days_of_supply < lead_days, FALSE) AS reorder FROM fact""",
)
def _(t: Tables) -> DataFrame:
    return stock_facts(t)[0]


@query(
    "inventory_health",
    f"""WITH {FACT_SQL} SELECT warehouse_id, sku, {r('avg_demand * lead_days * 1.5', 2)} AS safety_stock, avg_demand > 0 AND on_hand > avg_demand * lead_days * 1.5 * 2 AS overstock,
  CASE WHEN on_hand > 0 THEN COALESCE({sql_ratio('(total_sold::DOUBLE / periods * 365.0)', 'on_hand', 2)}, 0) ELSE 0.0 END::DOUBLE AS turnover,
  CASE WHEN on_hand <= 0 THEN 'stockout' WHEN days_of_supply < lead_days THEN 'critical' WHEN days_of_supply < lead_days * 2 THEN 'warning'
    WHEN avg_demand > 0 AND on_hand > avg_demand * lead_days * 1.5 * 2 THEN 'overstock' ELSE 'healthy' END AS health_status FROM fact""",
)
def _(t: Tables) -> DataFrame:
    return inventory_health(*stock_facts(t)).select(
        "warehouse_id", "sku", "safety_stock", "overstock", "turnover", "health_status"
    )


@query(
    "demand_forecast",
    f"""WITH {FACT_SQL},
dl AS (SELECT *, demand_avg - LAG(demand_avg) OVER (PARTITION BY store_id, sku, nearest_wh ORDER BY period) AS delta FROM sig),
st AS (SELECT store_id, sku, nearest_wh, {sql_ratio('SUM(net_sold)', 'COUNT(*)', 4)} AS avg_demand, MAX(demand_avg) AS peak, MIN(demand_avg) AS trough, {r('STDDEV_SAMP(net_sold::DOUBLE)', 4)} AS demand_stddev,
  {r('VAR_SAMP(net_sold::DOUBLE)', 2)} AS demand_variance, {sql_ratio('SUM(CAST(delta AS DECIMAL(18,4)))', 'COUNT(delta)', 4)} AS trend, MAX(on_hand) AS on_hand, COUNT(*) AS observations FROM dl GROUP BY 1, 2, 3)
SELECT st.*, lead_days, CASE WHEN trend > 1 THEN 'accelerating' WHEN trend > 0 THEN 'growing' WHEN trend > -1 THEN 'stable' ELSE 'declining' END AS trend_label,
  CASE WHEN avg_demand > 0 THEN {sql_ratio('demand_stddev', 'avg_demand', 4)} ELSE 0.0 END::DOUBLE AS seasonality, {r('avg_demand * COALESCE(lead_days, 10) * 1.5', 2)} AS safety_stock,
  CASE WHEN avg_demand > 0 THEN {sql_ratio('on_hand', 'avg_demand', 2)} END AS days_until_stockout FROM st LEFT JOIN lead ON lead.sku = st.sku""",
)
def _(t: Tables) -> DataFrame:
    return demand_forecast(pin(signals(t), "signals"), pin(lead_times(fulfilled(purchase_lines(t))), "lead"))


def tracking_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.select(
        "event_id", F.col("user_id").alias("shipment_id"), F.col("ts").alias("event_time"),
        F.when(kind == "signup", "dispatched").when(kind == "purchase", "delivered").when(kind == "error", "exception")
        .when(kind == "click", "customs_hold").otherwise("in_transit").alias("event_type"),
    )


def order_references(t: Tables) -> DataFrame:
    """The shipment that carries an order: one per customer, by the carrier of its priority."""
    return t.orders.select(
        F.col("o_orderkey").alias("reference"), F.col("o_custkey").alias("shipment_id"), F.col("o_orderpriority").alias("carrier_id")
    )


TRACK_SQL = f"""e AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'signup' THEN 'dispatched' WHEN 'purchase' THEN 'delivered' WHEN 'error' THEN 'exception' WHEN 'click' THEN 'customs_hold' ELSE 'in_transit' END AS k FROM events),
a AS (SELECT user_id AS shipment_id, arg_max(k, ROW(ts, event_id)) AS current_status, COUNT(*) AS total_events, bool_or(k = 'exception') AS has_exception, bool_or(k = 'customs_hold') AS has_customs_hold,
  MIN(CASE WHEN k = 'dispatched' THEN ts END) AS dispatched_at, MAX(CASE WHEN k = 'delivered' THEN ts END) AS delivered_at FROM e GROUP BY 1),
track AS (SELECT *, {r(sec('delivered_at', 'dispatched_at') + ' / 3600', 2)} AS transit_hours FROM a)"""


@query("tracking_pivot", f"WITH {TRACK_SQL} SELECT * FROM track")
def _(t: Tables) -> DataFrame:
    return shipment_tracking(tracking_events(t))


@query(
    "lifecycle_fact",
    f"""WITH {PO_SQL},
g AS (SELECT warehouse_id, sku, l_shipdate, MIN(l_orderkey) AS ok FROM moves WHERE kind = 'ship' GROUP BY 1, 2, 3),
x AS (SELECT ful.l_orderkey, ful.l_suppkey, ful.sku, MIN(g.l_shipdate) AS next_ship, arg_min(g.ok, g.l_shipdate) AS ok
  FROM ful JOIN g ON g.warehouse_id = ful.warehouse_id AND g.sku = ful.sku AND g.l_shipdate > ful.received_at GROUP BY 1, 2, 3),
{TRACK_SQL}
SELECT ful.l_orderkey, ful.l_suppkey, ful.sku, fill_rate, on_time, received_at, next_ship, {n("date_diff('day', received_at, next_ship)")} AS days_on_shelf,
  ok AS shipment_order, o_custkey AS shipment_id, o_orderpriority AS carrier_id, current_status AS shipment_status, transit_hours, has_exception AS shipment_exception
FROM ful LEFT JOIN x USING (l_orderkey, l_suppkey, sku) LEFT JOIN orders o ON o.o_orderkey = ok LEFT JOIN track ON track.shipment_id = o_custkey""",
)
def _(t: Tables) -> DataFrame:
    return lifecycle(
        fulfilled(purchase_lines(t)), stock_movements(stock_lines(t)), order_references(t), shipment_tracking(tracking_events(t))
    )


@query(
    "rollup_dims",
    f"""WITH {WIDE_SQL} SELECT 'supplier' AS dimension, CAST(l_suppkey AS VARCHAR) AS member, {n('SUM(quantity)')} AS units, {d('SUM(' + m('l_extendedprice') + ')')} AS amount, COUNT(DISTINCT sku) AS products FROM wide GROUP BY 2
UNION ALL SELECT 'product', CAST(l_partkey AS VARCHAR), {n('SUM(quantity)')}, {d('SUM(' + m('l_extendedprice') + ')')}, COUNT(DISTINCT sku) FROM wide GROUP BY 2
UNION ALL SELECT 'warehouse', CAST(warehouse_id AS VARCHAR), {n('SUM(quantity)')}, {d('SUM(' + m('l_extendedprice') + ')')}, COUNT(DISTINCT sku) FROM wide GROUP BY 2
UNION ALL SELECT 'store', CAST(store_id AS VARCHAR), {n('SUM(quantity)')}, {d('SUM(' + m('l_extendedprice') + ')')}, COUNT(DISTINCT sku) FROM wide GROUP BY 2""",
)
def _(t: Tables) -> DataFrame:
    """Every line goes to its four members and is summed there by product first."""
    names = {"supplier": "l_suppkey", "product": "l_partkey", "warehouse": "warehouse_id", "store": "store_id"}
    members = F.array(
        *[F.struct(F.lit(k).alias("dimension"), F.col(c).cast("string").alias("member")) for k, c in names.items()]
    )
    by_sku = (
        wide_lines(t)
        .select(F.explode(members).alias("_m"), "sku", "quantity", amount("l_extendedprice").alias("price"))
        .groupBy("_m.dimension", "_m.member", "sku")
        .agg(F.sum("quantity").alias("units"), F.sum("price").alias("amount"))
    )
    return by_sku.groupBy("dimension", "member").agg(
        F.sum("units").alias("units"), F.sum("amount").alias("amount"), F.count("sku").alias("products")
    )


@query(
    "warehouse_utilization",
    f"""WITH {WIDE_SQL}, cap AS (SELECT s_nationkey AS w, CAST(SUM(CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0 END) AS DECIMAL(18,2)) AS c FROM supplier GROUP BY 1)
SELECT {n('n_nationkey')} AS warehouse_id, n_name, {n('COALESCE(SUM(on_hand), 0)')} AS on_hand, COUNT(sku) AS sku_count, {pct('COALESCE(SUM(on_hand), 0)', 'MAX(c)')} AS utilization_pct
FROM nation LEFT JOIN stock ON n_nationkey = warehouse_id LEFT JOIN cap ON w = n_nationkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    held = inventory_positions(stock_movements(stock_lines(t))).groupBy("warehouse_id").agg(
        F.sum("on_hand").alias("on_hand"), F.count(F.lit(1)).alias("sku_count")
    )
    room = t.supplier.groupBy("s_nationkey").agg(
        F.sum(F.when(F.col("s_acctbal") > 0, amount("s_acctbal")).otherwise(0)).alias("capacity")
    )
    rows = t.nation.join(held, F.col("n_nationkey") == F.col("warehouse_id"), "left").join(
        room, F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    zero = F.lit(0)
    return rows.select(
        F.col("n_nationkey").alias("warehouse_id"), "n_name", F.coalesce("on_hand", zero).alias("on_hand"),
        F.coalesce("sku_count", zero).alias("sku_count"),
        percent(F.coalesce("on_hand", zero), "capacity").alias("utilization_pct"),
    )
