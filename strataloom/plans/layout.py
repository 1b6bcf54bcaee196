"""Layout jobs: the rows stay the same, the files change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import month_start
from ..operators.quality import retain_recent
from ..session import scratch_path, shuffle_width
from ..sources import writers as W
from ..sources.tables import Tables
from .registry import query


@query("compact", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables) -> DataFrame:
    """Small files in each part of a table joined to larger ones; what is large enough stays."""
    path = scratch_path(t.spark, "scattered")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    early = F.col("event_id") % 2 == 0
    W.append(rows.filter(early).coalesce(1), path, ["event_type"])
    for late in (1, 3):
        W.append(rows.filter(F.col("event_id") % 4 == late).repartition(shuffle_width(t.spark)), path, ["event_type"])
    largest = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.max("length")).first()[0]
    W.compact(t.spark, path, largest)
    return t.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("zorder_layout", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t: Tables) -> DataFrame:
    """Orders clustered by customer and price; a box of both reads few files."""
    low, high, cheap, dear = t.orders.agg(
        F.min("o_custkey"), F.max("o_custkey"), F.min("o_totalprice"), F.max("o_totalprice")
    ).first()
    clustered = W.cluster(
        t.orders, scratch_path(t.spark, "zorder"), {"o_custkey": (low, high), "o_totalprice": (cheap, dear)}
    )
    return clustered.select("o_orderkey", "o_custkey", "o_totalprice")


@query("bloom_layout", "SELECT o_orderkey, o_custkey FROM orders")
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey")
    return W.write_with_bloom(rows, scratch_path(t.spark, "bloom"), ["o_custkey"])


@query("partitioned_write", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def _(t: Tables) -> DataFrame:
    """Written by priority, then every part refreshed."""
    path = scratch_path(t.spark, "parts")
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    W.append(rows.withColumn("o_orderstatus", F.lit("?")), path, ["o_orderpriority"])
    W.refresh_partitions(rows, path, ["o_orderpriority"])
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("full_refresh", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t: Tables) -> DataFrame:
    """A table made anew from a select, twice; the second time it replaces the first."""
    path = scratch_path(t.spark, "refresh")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    W.overwrite(rows.withColumn("o_orderstatus", F.lit("?")), path)
    W.overwrite(rows, path)
    return t.spark.read.parquet(path)


@query(
    "truncate_insert",
    "SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, COUNT(*) AS orders FROM orders GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    """A summary emptied and filled again from itself and the orders; its types stay."""
    path = scratch_path(t.spark, "truncate")
    rows = t.orders.groupBy(month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    W.overwrite(rows.withColumn("orders", F.lit(0).cast("bigint")), path)
    months = t.spark.read.parquet(path).select("month")
    W.truncate_insert(months.join(rows.withColumn("orders", F.col("orders").cast("int")), "month"), path)
    return t.spark.read.parquet(path)


@query(
    "append_only_refresh",
    "SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, COUNT(*) AS orders FROM orders GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    """The same orders appended twice by key are stored once."""
    path = scratch_path(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    W.append(rows.filter("o_orderkey < 0"), path)
    W.append_absent(rows, path, ["o_orderkey"])
    W.append_absent(rows, path, ["o_orderkey"])
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy(month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "retention",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC, value DESC) AS rn FROM events)
SELECT event_id, user_id, event_type, ts FROM r WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 168 HOUR OR rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return retain_recent(rows, ["user_id", "event_type"], "ts", 168, "2024-01-30")
