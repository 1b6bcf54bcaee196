"""Merges, change feeds, versions, restore and erasure over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, money
from ..operators import changes as C
from ..operators import upsert as U
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, m, n
from .standins import LATER_SQL, TIER_SQL, customers_later, tier_history

CUT = "1999-01-01"


def stored_orders(t: Tables) -> DataFrame:
    """The orders as they were loaded up to the cut: all still open."""
    early = t.orders.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
    return early.select(
        "o_orderkey", F.lit("O").alias("status"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("updated_at"), F.lit(False).alias("is_deleted"),
        F.lit(None).cast("timestamp_ntz").alias("cancelled_at"),
    )


def arriving_orders(t: Tables) -> DataFrame:
    """Every order with its final status; urgent ones carry an older time than stored."""
    shift = F.when(F.col("o_orderpriority") == "1-URGENT", -1).otherwise(30)
    return t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") + 1).alias("price"),
        (F.col("o_orderdate") + F.make_dt_interval(shift)).alias("updated_at"),
    )


MERGE_SQL = f"""
tgt AS (SELECT o_orderkey, 'O' AS status, o_totalprice AS price, o_orderdate AS updated_at FROM orders
        WHERE o_orderdate < TIMESTAMP '{CUT}'),
src AS (SELECT o_orderkey, o_orderstatus AS status, o_totalprice + 1 AS price,
        o_orderdate + (CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE 30 END) * INTERVAL 1 DAY AS updated_at FROM orders)"""


def _plain(t: Tables) -> DataFrame:
    return stored_orders(t).drop("is_deleted", "cancelled_at")


@query(
    "merge_upsert",
    f"""WITH {MERGE_SQL} SELECT o_orderkey, status, {d(m('price'))} AS price, updated_at FROM src""",
)
def _(t: Tables) -> DataFrame:
    merged = U.upsert(_plain(t), arriving_orders(t), ["o_orderkey"])
    return merged.withColumn("price", money("price"))


@query(
    "merge_conditional_soft_delete",
    f"""WITH {MERGE_SQL}
SELECT s.o_orderkey, s.status,
       {d(m("CASE WHEN t.o_orderkey IS NOT NULL AND s.status = 'F' THEN t.price ELSE s.price END"))} AS price,
       s.updated_at, COALESCE(t.o_orderkey IS NOT NULL AND s.status = 'F', FALSE) AS is_deleted,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.status = 'F' THEN s.updated_at END AS cancelled_at
FROM src s LEFT JOIN tgt t ON s.o_orderkey = t.o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    cancelled = U.matched(
        {**U.take("status", "updated_at"), "is_deleted": F.lit(True), "cancelled_at": F.col("s.updated_at")},
        F.col("s.status") == "F",
    )
    changed = U.matched(U.take("status", "price", "updated_at"))
    new = U.absent({**U.take("o_orderkey", "status", "price", "updated_at"), "is_deleted": F.lit(False)})
    merged = U.merge(stored_orders(t), arriving_orders(t), ["o_orderkey"], [cancelled, changed, new])
    return merged.withColumn("price", money("price"))


@query(
    "merge_newer_wins",
    f"""WITH {MERGE_SQL}
SELECT s.o_orderkey, CASE WHEN t.o_orderkey IS NULL OR s.updated_at > t.updated_at THEN s.status ELSE t.status END AS status,
       {d(m('CASE WHEN t.o_orderkey IS NULL OR s.updated_at > t.updated_at THEN s.price ELSE t.price END'))} AS price,
       CASE WHEN t.o_orderkey IS NULL OR s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at
FROM src s LEFT JOIN tgt t ON s.o_orderkey = t.o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    merged = U.newer_wins(_plain(t), arriving_orders(t), ["o_orderkey"], "updated_at")
    return merged.withColumn("price", money("price"))


@query(
    "merge_full_sync",
    f"WITH {LATER_SQL} SELECT c_custkey, c_name, {n('c_nationkey')} AS c_nationkey, c_acctbal, c_mktsegment FROM later",
)
def _(t: Tables) -> DataFrame:
    return U.full_sync(t.customer, customers_later(t), ["c_custkey"])


@query(
    "merge_insert_only",
    f"""WITH {MERGE_SQL}
SELECT o_orderkey, status, {d(m('price'))} AS price, updated_at FROM tgt
UNION ALL SELECT o_orderkey, status, {d(m('price'))}, updated_at FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)""",
)
def _(t: Tables) -> DataFrame:
    # every row arrives twice, as from a replayed feed
    twice = arriving_orders(t).unionByName(arriving_orders(t))
    merged = U.insert_absent(_plain(t), twice, ["o_orderkey"])
    return merged.withColumn("price", money("price"))


def movements(t: Tables) -> DataFrame:
    """Line items as stock movements: returns come back, the rest goes out."""
    signed = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity"))
    return t.lineitem.select("l_suppkey", "l_partkey", signed.cast("bigint").alias("quantity"), "l_shipdate", "l_returnflag")


def _positions(moves: DataFrame) -> DataFrame:
    return moves.groupBy("l_suppkey", "l_partkey").agg(
        F.sum("quantity").alias("on_hand"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("quantity")).otherwise(0)).alias("received"),
        F.max("l_shipdate").alias("last_movement"),
    )


@query(
    "merge_additive",
    f"""SELECT l_suppkey, l_partkey, {n("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END)")} AS on_hand,
       {n("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)")} AS received, MAX(l_shipdate) AS last_movement
FROM lineitem GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    moves = movements(t)
    old = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    return U.add_up(
        _positions(moves.filter(old)), _positions(moves.filter(~old)), ["l_suppkey", "l_partkey"],
        ["on_hand", "received"], ["last_movement"],
    )


@query(
    "delete_and_soft_delete",
    f"""SELECT c_custkey, c_acctbal, c_mktsegment = 'FURNITURE' AS is_deleted,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN TIMESTAMP '{CUT}' END AS cancelled_at
FROM customer WHERE NOT c_acctbal < 0 OR c_acctbal IS NULL""",
)
def _(t: Tables) -> DataFrame:
    left = U.delete_where(t.customer, F.col("c_acctbal") < 0)
    marked = U.soft_delete(left, F.col("c_mktsegment") == "FURNITURE", F.lit(CUT).cast("timestamp_ntz"))
    return marked.select("c_custkey", "c_acctbal", "is_deleted", "cancelled_at")


@query(
    "change_feed_pairs",
    f"""WITH {TIER_SQL}
SELECT account_id, tier AS old_value, NULL::VARCHAR AS new_value, 'update_preimage' AS change_type, valid_to AS changed_at
FROM tiers WHERE NOT is_current
UNION ALL SELECT account_id, NULL, tier, CASE WHEN valid_from > first_from THEN 'update_postimage' ELSE 'insert' END, valid_from
FROM (SELECT *, MIN(valid_from) OVER (PARTITION BY account_id) AS first_from FROM tiers) WHERE is_current""",
)
def _(t: Tables) -> DataFrame:
    return C.feed_from_versions(pin(tier_history(t), "dim"), ["account_id"], "tier")


@query(
    "snapshot_diff",
    f"""WITH {LATER_SQL},
b AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer), a AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM later),
gone AS (SELECT * FROM b EXCEPT SELECT * FROM a), come AS (SELECT * FROM a EXCEPT SELECT * FROM b)
SELECT *, CASE WHEN c_custkey IN (SELECT c_custkey FROM a) THEN 'update_preimage' ELSE 'delete' END AS change_type FROM gone
UNION ALL SELECT *, CASE WHEN c_custkey IN (SELECT c_custkey FROM b) THEN 'update_postimage' ELSE 'insert' END FROM come""",
)
def _(t: Tables) -> DataFrame:
    columns = ["c_custkey", "c_mktsegment", "c_acctbal"]
    return C.snapshot_diff(t.customer.select(*columns), customers_later(t).select(*columns), ["c_custkey"])


@query(
    "column_change_log",
    f"""WITH {LATER_SQL}
SELECT c_custkey, CASE WHEN c.c_mktsegment <> l.c_mktsegment THEN 'segment_change' ELSE 'balance_change' END AS change_type,
       CASE WHEN c.c_mktsegment <> l.c_mktsegment THEN c.c_mktsegment ELSE CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS old_value,
       CASE WHEN c.c_mktsegment <> l.c_mktsegment THEN l.c_mktsegment ELSE CAST(CAST(l.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS new_value
FROM customer c JOIN later l USING (c_custkey) WHERE c.c_mktsegment <> l.c_mktsegment OR c.c_acctbal <> l.c_acctbal""",
)
def _(t: Tables) -> DataFrame:
    exact = {"c_acctbal": amount("c_acctbal")}
    return C.column_changes(
        t.customer.withColumns(exact), customers_later(t).withColumns(exact), ["c_custkey"],
        {"c_mktsegment": "segment_change", "c_acctbal": "balance_change"},
    )


def status_log(t: Tables) -> DataFrame:
    """Order status by version: 1 placed, 2 part shipped, 3 final or removed."""
    log = t.orders.select(
        "o_orderkey",
        F.posexplode(F.array(F.lit("O"), F.lit("P"), F.col("o_orderstatus"))).alias("_p", "status"),
        "o_orderpriority",
    )
    return log.select(
        "o_orderkey", (F.col("_p") + 1).cast("bigint").alias("version"), "status",
        ((F.col("_p") == 2) & (F.col("o_orderpriority") == "5-LOW")).alias("removed"),
    )


LOG_SQL = """
log AS (SELECT o_orderkey, 1 AS version, 'O' AS status, FALSE AS removed FROM orders
  UNION ALL SELECT o_orderkey, 2, 'P', FALSE FROM orders
  UNION ALL SELECT o_orderkey, 3, o_orderstatus, o_orderpriority = '5-LOW' FROM orders)"""


@query(
    "as_of_version",
    f"""WITH {LOG_SQL}, v AS (SELECT * FROM (VALUES (1), (2), (3)) AS x(state_version))
SELECT {n('state_version')} AS state_version, status, COUNT(*) AS orders FROM v JOIN log l ON l.version = state_version
WHERE NOT removed GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    log = status_log(t)
    out = None
    for number in (1, 2, 3):
        state = C.as_of_version(log, ["o_orderkey"], "version", number, deleted="removed")
        counted = state.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
        counted = counted.select(F.lit(number).alias("state_version"), "status", "orders")
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "restore_state",
    f"""WITH {LOG_SQL}
SELECT o_orderkey, 'P' AS status, {n('2')} AS version FROM log WHERE version = 2""",
)
def _(t: Tables) -> DataFrame:
    kept, _discarded = C.restore(status_log(t), "version", 2)
    return C.as_of_version(kept, ["o_orderkey"], "version", 3, deleted="removed").select("o_orderkey", "status", "version")


@query(
    "correction_log",
    f"""WITH {LOG_SQL} SELECT {n('version')} AS discarded_version, COUNT(*) AS discarded_rows FROM log WHERE version > 1 GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    _kept, discarded = C.restore(status_log(t), "version", 1)
    return discarded


@query(
    "erase_subject",
    """WITH subj AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 0),
counts AS (
  SELECT 'customer' AS table_name, COUNT(*) AS rows_before, COUNT(CASE WHEN c_custkey IN (SELECT k FROM subj) THEN 1 END) AS rows_erased FROM customer
  UNION ALL SELECT 'orders', COUNT(*), COUNT(CASE WHEN o_custkey IN (SELECT k FROM subj) THEN 1 END) FROM orders
  UNION ALL SELECT 'events', COUNT(*), COUNT(CASE WHEN user_id IN (SELECT k FROM subj) THEN 1 END) FROM events)
SELECT *, rows_before - rows_erased AS rows_after, CAST(0 AS BIGINT) AS rows_found FROM counts""",
)
def _(t: Tables) -> DataFrame:
    subjects = t.customer.filter(F.col("c_acctbal") < 0).select("c_custkey")
    tables = {"customer": t.customer, "orders": t.orders, "events": t.events}
    keys = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
    cleaned, audit = C.erase(tables, subjects, keys)
    # prove that no row of a subject is left
    proof = None
    for name, df in cleaned.items():
        found = df.join(subjects, df[keys[name]] == subjects["c_custkey"], "left_semi")
        row = found.agg(F.count(F.lit(1)).alias("rows_found")).withColumn("table_name", F.lit(name))
        proof = row if proof is None else proof.unionByName(row)
    return audit.join(proof, "table_name")


@query(
    "audit_trail",
    f"""SELECT 'orders' AS table_name, 'INSERT' AS operation, CAST(o_orderkey AS VARCHAR) AS record_key,
       'Gross=' || CAST({m('o_totalprice')} AS VARCHAR) || ' Status=' || o_orderstatus AS details FROM orders
UNION ALL SELECT 'returns', 'AMENDMENT', CAST(l_orderkey AS VARCHAR), 'Returned=' || CAST(SUM({m('l_extendedprice')}) AS VARCHAR) || ' Lines=' || CAST(COUNT(*) AS VARCHAR)
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("gross", amount("o_totalprice"))
    returns = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(
        F.sum(amount("l_extendedprice")).alias("returned"), F.count(F.lit(1)).alias("lines")
    )
    return C.audit_rows(
        orders, "orders", "INSERT", "o_orderkey", [("Gross=", "gross"), (" Status=", "o_orderstatus")]
    ).unionByName(
        C.audit_rows(returns, "returns", "AMENDMENT", "l_orderkey", [("Returned=", "returned"), (" Lines=", "lines")])
    )
