"""Data-quality reports and privacy transforms over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import privacy as P
from ..functions.numeric import amount
from ..operators import quality as Q
from ..sources.tables import Tables
from .loading import loaded_events
from .registry import query
from .sqltext import m, n
from .standins import customers_later


@query(
    "expectations_report",
    """WITH c AS (SELECT 'orders_present' AS check_name, CAST(COUNT(*) AS VARCHAR) AS observed, COUNT(*) > 0 AS passed, 'error' AS severity, 'orders must not be empty' AS message FROM orders
UNION ALL SELECT 'max_discount', CAST(CAST(MAX(l_discount) AS DECIMAL(4,2)) AS VARCHAR), MAX(l_discount) <= 0.1, 'warn', '' FROM lineitem
UNION ALL SELECT 'first_nation_name', MIN(n_name), MIN(n_name) = 'NATION_0', 'warn', '' FROM nation WHERE n_nationkey = 0
UNION ALL SELECT 'latest_event', CAST(CAST(MAX(ts) AS DATE) AS VARCHAR), MAX(ts) IS NOT NULL, 'warn', '' FROM events
UNION ALL SELECT 'null_order_key', CAST(COUNT(*) - COUNT(o_orderkey) AS VARCHAR), COUNT(*) = COUNT(o_orderkey), 'error', 'orders' FROM orders
UNION ALL SELECT 'negative_price', CAST(COUNT(CASE WHEN o_totalprice <= 0 THEN 1 END) AS VARCHAR), COUNT(CASE WHEN o_totalprice <= 0 THEN 1 END) = 0, 'error', 'orders' FROM orders
UNION ALL SELECT 'unknown_status', CAST(COUNT(CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 END) AS VARCHAR), COUNT(CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 END) = 0, 'error', 'orders' FROM orders)
SELECT * FROM c""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders
    return Q.report(
        Q.expect_rows(orders, "orders_present", ">", 0, severity="error", message="orders must not be empty"),
        Q.expect_value(t.lineitem, "max_discount", F.max("l_discount").cast("decimal(4,2)"), "<=", 0.1),
        Q.expect_value(t.nation, "first_nation_name", F.min("n_name"), "=", "NATION_0", where=F.col("n_nationkey") == 0),
        Q.expect_value(t.events, "latest_event", F.max("ts").cast("date"), "is not null"),
        Q.expect_none(
            orders,
            {
                "null_order_key": F.col("o_orderkey").isNull(),
                "negative_price": F.col("o_totalprice") <= 0,
                "unknown_status": ~F.col("o_orderstatus").isin("F", "O"),
            },
            message="orders",
        ),
    )


@query(
    "source_probe",
    " UNION ALL ".join(
        f"SELECT '{x}' AS check_name, CAST(LEAST(COUNT(*), 1) AS VARCHAR) AS observed, COUNT(*) > 0 AS passed, 'error' AS severity, 'no rows' AS message FROM {x}"
        for x in ("customer", "orders", "lineitem", "events", "nation WHERE n_nationkey < 0")
    ).replace("'nation WHERE n_nationkey < 0'", "'no_nation'"),
)
def _(t: Tables) -> DataFrame:
    """Sources asked for one row before a load, one of them empty."""
    names = ("customer", "orders", "lineitem", "events")
    probes = [Q.expect_source(getattr(t, x), x, message="no rows") for x in names]
    return Q.report(*probes, Q.expect_source(t.nation.filter("n_nationkey < 0"), "no_nation", message="no rows"))


@query(
    "top_value_check",
    """SELECT 'top_status' AS check_name, (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS observed,
  (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) = 'O' AS passed, 'warn' AS severity, '' AS message
UNION ALL SELECT 'top_flag_by_quantity', (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY SUM(CAST(l_quantity AS BIGINT)) DESC, 1 LIMIT 1),
  (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY SUM(CAST(l_quantity AS BIGINT)) DESC, 1 LIMIT 1) = 'Z', 'error', 'flags'""",
)
def _(t: Tables) -> DataFrame:
    return Q.report(
        Q.expect_top(t.orders, "top_status", "o_orderstatus", "O"),
        Q.expect_top(
            t.lineitem, "top_flag_by_quantity", "l_returnflag", "Z", F.col("l_quantity").cast("bigint"),
            severity="error", message="flags",
        ),
    )


@query(
    "referential_integrity",
    """SELECT 'orders' AS child, 'customer' AS parent, COUNT(*) AS orphan_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem', 'orders', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'part', COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'labels', 'documents', COUNT(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'events', 'supplier', COUNT(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(t: Tables) -> DataFrame:
    links = [
        ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"), ("labels", "doc_id", "documents", "doc_id"),
        ("events", "user_id", "supplier", "s_suppkey"),
    ]
    out = None
    for child, key, parent, parent_key in links:
        lost = Q.orphans(getattr(t, child).select(key), key, getattr(t, parent), parent_key)
        row = lost.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), "orphan_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("duplicate_keys", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t: Tables) -> DataFrame:
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


_RULES = "CASE WHEN c_acctbal > 0 THEN '' ELSE ',balance' END || CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN '' ELSE ',segment' END"


@query(
    "quarantine",
    f"SELECT c_custkey, ltrim({_RULES}, ',') AS broken_rules FROM customer",
)
def _(t: Tables) -> DataFrame:
    good, bad = Q.split_valid(
        t.customer,
        {"balance": F.col("c_acctbal") > 0, "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD")},
    )
    return good.withColumn("broken_rules", F.lit("")).unionByName(bad).select("c_custkey", "broken_rules")


@query(
    "reconciliation",
    """SELECT 'events' AS table_name, (SELECT COUNT(*) FROM events WHERE ts < TIMESTAMP '2024-01-20' AND NOT (event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-18')) AS rows_before,
  COUNT(*) AS rows_after, COUNT(*) - (SELECT COUNT(*) FROM events WHERE ts < TIMESTAMP '2024-01-20' AND NOT (event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-18')) AS difference FROM events
UNION ALL SELECT 'customer', COUNT(*), COUNT(CASE WHEN c_acctbal >= 500 THEN 1 END) + (SELECT COUNT(*) FROM supplier),
  COUNT(CASE WHEN c_acctbal >= 500 THEN 1 END) + (SELECT COUNT(*) FROM supplier) - COUNT(*) FROM customer""",
)
def _(t: Tables) -> DataFrame:
    return Q.reconcile(loaded_events(t), t.events, "events").unionByName(
        Q.reconcile(t.customer, customers_later(t), "customer")
    )


@query(
    "kpi_recomputation",
    f"""WITH a AS (SELECT o_custkey, SUM({m('o_totalprice')}) AS s, COUNT(*) AS k FROM orders GROUP BY 1)
SELECT (SELECT COUNT(*) FROM a) AS groups, (SELECT CAST(SUM(k) AS BIGINT) FROM a) = COUNT(*) AS counts_agree, (SELECT SUM(s) FROM a) = SUM({m('o_totalprice')}) AS sums_agree FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Totals of a KPI table against the same totals from the base rows."""
    kpi = t.orders.groupBy("o_custkey").agg(F.sum(amount("o_totalprice")).alias("s"), F.count(F.lit(1)).alias("k"))
    base_sum = t.orders.agg(F.sum(amount("o_totalprice")).alias("s")).scalar()
    base_rows = t.orders.agg(F.count(F.lit(1)).alias("k")).scalar()
    again = kpi.agg(F.count(F.lit(1)).alias("groups"), F.sum("s").alias("s"), F.sum("k").alias("k"))
    return again.select(
        "groups", (F.col("k") == base_rows).alias("counts_agree"), (F.col("s") == base_sum).alias("sums_agree")
    )


SALT = "orders_salt"


@query("redact", "SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN '[REDACTED]' END AS c_name, CASE WHEN c_acctbal IS NOT NULL THEN '***-**-****' END AS c_acctbal FROM customer")
def _(t: Tables) -> DataFrame:
    rules = {"c_name": P.redact, "c_acctbal": lambda c: P.redact(c, "***-**-****")}
    return P.apply_rules(t.customer.select("c_custkey", "c_name", "c_acctbal"), rules)


@query(
    "mask_show",
    """SELECT c_custkey, substr(c_name, 1, 5) || repeat('*', length(c_name) - 5) AS c_name, substr(c_mktsegment, 1, 1) || repeat('*', length(c_mktsegment) - 1) AS c_mktsegment FROM customer""",
)
def _(t: Tables) -> DataFrame:
    rules = {"c_name": lambda c: P.show_first(c, 5), "c_mktsegment": lambda c: P.show_first(c, 1)}
    return P.apply_rules(t.customer.select("c_custkey", "c_name", "c_mktsegment"), rules)


@query(
    "keyed_hash",
    f"""SELECT sha256('{SALT}' || CAST(o_custkey AS VARCHAR)) AS customer_token, c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    """Tokens of two tables still join."""
    left = t.orders.select(P.keyed_hash("o_custkey", SALT).alias("customer_token"))
    right = t.customer.select(P.keyed_hash("c_custkey", SALT).alias("customer_token"), "c_mktsegment")
    return left.join(right, "customer_token").groupBy("customer_token", "c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "generalize_band",
    f"""SELECT p_partkey, CAST(floor(p_size / 10.0) * 10 AS BIGINT)::VARCHAR || '-' || CAST(floor(p_size / 10.0) * 10 + 9 AS BIGINT)::VARCHAR AS size_band FROM part""",
)
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", P.number_band("p_size", 10).alias("size_band"))


@query(
    "generalize_dates_and_phones",
    f"""SELECT o_orderkey, {n('floor(year(o_orderdate) / 10.0) * 10')} AS decade, substr(CAST(o_custkey + 5550000000 AS VARCHAR), 1, 6) || '0000' AS phone FROM orders""",
)
def _(t: Tables) -> DataFrame:
    phone = (F.col("o_custkey") + F.lit(5550000000)).cast("string")
    return t.orders.select("o_orderkey", P.year_band("o_orderdate", 10).alias("decade"), P.drop_tail(phone, 4).alias("phone"))


@query(
    "subnet",
    "SELECT '10.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) || '.0/24' AS network, COUNT(*) AS events FROM events GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.floor(u / 256), u % 256, F.hour("ts"))
    return t.events.groupBy(P.subnet24(ip).alias("network")).agg(F.count(F.lit(1)).alias("events"))


@query(
    "k_anonymity",
    """SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 5000) * 5000 AS BIGINT)::VARCHAR || '-' || CAST(floor(c_acctbal / 5000) * 5000 + 4999 AS BIGINT)::VARCHAR AS balance_band,
  COUNT(*) AS group_size FROM customer GROUP BY 1, 2, 3 HAVING COUNT(*) < 5""",
)
def _(t: Tables) -> DataFrame:
    coarse = t.customer.select("c_nationkey", "c_mktsegment", P.number_band("c_acctbal", 5000).alias("balance_band"))
    return Q.k_anonymity(coarse, ["c_nationkey", "c_mktsegment", "balance_band"], 5)
