"""Versioned dimensions, point-in-time joins and amendment ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, percent
from ..operators.joins import as_of
from ..operators.ranking import surrogate_keys
from ..functions.text import clean_code
from ..operators.scd import apply_batch, build_history, changes_only, hire_and_change, initial_load, invariant_breaks
from ..operators.timeline import Cuts, Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, m, n, pct
from .standins import LATER_SQL, TIER_SQL, account_cuts, customers_later, tier_history, tier_steps


@query(
    "scd2_build",
    f"WITH {TIER_SQL} SELECT account_id, tier, {d('spent')} AS spent, valid_from, valid_to, is_current FROM tiers",
)
def _(t: Tables) -> DataFrame:
    return tier_history(t).select("account_id", "tier", "spent", "valid_from", "valid_to", "is_current")


@query(
    "scd2_initial_load",
    f"""WITH {TIER_SQL}
SELECT account_id, tier, valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
FROM tier_steps WHERE was IS NULL""",
)
def _(t: Tables) -> DataFrame:
    loaded = initial_load(tier_steps(t), ["account_id"], "valid_from")
    return loaded.select("account_id", "tier", "valid_from", "valid_to", "is_current")


@query(
    "clean_text_history",
    f"""WITH dirty AS (SELECT o_custkey, o_orderdate, CASE o_orderkey % 3 WHEN 0 THEN '  ' || lower(o_orderpriority) WHEN 1 THEN upper(o_orderpriority) || '   ' ELSE o_orderpriority END AS label FROM orders),
daily AS (SELECT o_custkey AS account_id, o_orderdate AS valid_from, MAX(NULLIF(lower(trim(label)), '')) AS label FROM dirty GROUP BY 1, 2),
steps AS (SELECT * FROM (SELECT *, LAG(label) OVER w AS was, ROW_NUMBER() OVER w AS no FROM daily WINDOW w AS (PARTITION BY account_id ORDER BY valid_from)) WHERE no = 1 OR label IS DISTINCT FROM was)
SELECT account_id, label, valid_from, LEAD(valid_from) OVER (PARTITION BY account_id ORDER BY valid_from) AS valid_to FROM steps""",
)
def _(t: Tables) -> DataFrame:
    """Labels that differ only in case and white space are one version, not several."""
    kind, label = F.col("o_orderkey") % 3, F.col("o_orderpriority")
    dirty = (
        F.when(kind == 0, F.concat(F.lit("  "), F.lower(label)))
        .when(kind == 1, F.concat(F.upper(label), F.lit("   ")))
        .otherwise(label)
    )
    daily = (
        t.orders.select(F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("valid_from"), dirty.alias("label"))
        .withColumn("label", clean_code("label"))
        .groupBy("account_id", "valid_from")
        .agg(F.max("label").alias("label"))
    )
    cuts = account_cuts(t)
    steps = changes_only(daily, ["account_id"], ["valid_from"], ["label"], cuts)
    found = build_history(steps, ["account_id"], "valid_from", cuts=cuts)
    return found.select("account_id", "label", "valid_from", "valid_to")


def customer_versions(t: Tables) -> DataFrame:
    """The customer dimension with surrogate keys, all versions current."""
    dim = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").withColumns(
        {
            "valid_from": F.to_date(F.lit("1995-01-01")),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    return surrogate_keys(dim, ["c_custkey"], "customer_key")


@query(
    "scd2_expire_insert",
    f"""WITH {LATER_SQL},
dim AS (SELECT c_custkey, c_mktsegment, c_acctbal, ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
hit AS (SELECT l.c_custkey FROM later l JOIN dim c USING (c_custkey)
        WHERE l.c_mktsegment IS DISTINCT FROM c.c_mktsegment OR l.c_acctbal IS DISTINCT FROM c.c_acctbal),
fresh AS (SELECT l.* FROM later l WHERE c_custkey IN (SELECT c_custkey FROM hit)
          OR c_custkey NOT IN (SELECT c_custkey FROM dim))
SELECT {n('customer_key')} AS customer_key, c_custkey, c_mktsegment, c_acctbal, '1995-01-01' AS valid_from,
       CASE WHEN c_custkey IN (SELECT c_custkey FROM hit) THEN '2001-01-01' END AS valid_to,
       c_custkey NOT IN (SELECT c_custkey FROM hit) AS is_current FROM dim
UNION ALL
SELECT {n('(SELECT MAX(customer_key) FROM dim) + ROW_NUMBER() OVER (ORDER BY c_custkey)')}, c_custkey, c_mktsegment, c_acctbal,
       '2001-01-01', NULL, TRUE FROM fresh""",
)
def _(t: Tables) -> DataFrame:
    batch = customers_later(t).select("c_custkey", "c_mktsegment", "c_acctbal").withColumn(
        "effective", F.to_date(F.lit("2001-01-01"))
    )
    out = apply_batch(
        customer_versions(t), batch, ["c_custkey"], ["c_mktsegment", "c_acctbal"], "effective", "customer_key"
    )
    return out.select("customer_key", "c_custkey", "c_mktsegment", "c_acctbal", "valid_from", "valid_to", "is_current")


@query(
    "scd2_history_invariants",
    f"""WITH {TIER_SQL},
bad AS (SELECT account_id FROM tiers GROUP BY 1
        HAVING SUM(CASE WHEN is_current THEN 1 ELSE 0 END) <> 1 OR SUM(CASE WHEN valid_to < valid_from THEN 1 ELSE 0 END) > 0)
SELECT COUNT(*) AS versions, COUNT(DISTINCT account_id) AS accounts, COUNT(CASE WHEN is_current THEN 1 END) AS current_rows,
       (SELECT COUNT(*) FROM bad) AS broken_accounts FROM tiers""",
)
def _(t: Tables) -> DataFrame:
    dim = pin(tier_history(t), "dim")
    broken = invariant_breaks(dim, ["account_id"]).agg(F.count(F.lit(1)).alias("broken_accounts"))
    counts = dim.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct("account_id").alias("accounts"),
        F.count(F.when(F.col("is_current"), 1)).alias("current_rows"),
    )
    return counts.withColumn("broken_accounts", broken.scalar())


@query(
    "scd2_hire_change",
    """WITH hire AS (SELECT user_id, MIN(ROW(ts, event_id)) AS h FROM events WHERE event_type = 'signup' GROUP BY 1),
chg AS (SELECT user_id, MAX(ROW(ts, event_id)) AS c FROM events WHERE event_type IN ('purchase', 'click') GROUP BY 1),
first_row AS (SELECT e.user_id, e.ts, e.value FROM events e JOIN hire ON e.user_id = hire.user_id AND ROW(e.ts, e.event_id) = h),
last_row AS (SELECT e.user_id, e.ts, e.value FROM events e JOIN chg ON e.user_id = chg.user_id AND ROW(e.ts, e.event_id) = c)
SELECT f.user_id, f.value, f.ts AS valid_from, l.ts AS valid_to, l.user_id IS NULL AS is_current
FROM first_row f LEFT JOIN last_row l ON f.user_id = l.user_id
UNION ALL SELECT l.user_id, l.value, l.ts, NULL, TRUE FROM last_row l WHERE l.user_id IN (SELECT user_id FROM first_row)""",
)
def _(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    return hire_and_change(
        events, ["user_id"], "ts", F.col("event_type") == "signup",
        F.col("event_type").isin("purchase", "click"), ["value"], ["event_id"],
    )


@query(
    "pit_join_orders",
    f"""WITH {TIER_SQL}
SELECT o_orderkey, o_custkey AS account_id, o_orderdate, tier, valid_from FROM orders
JOIN tiers ON o_custkey = account_id AND o_orderdate >= valid_from AND (valid_to IS NULL OR o_orderdate < valid_to)""",
)
def _(t: Tables) -> DataFrame:
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("account_id"), "o_orderdate")
    cuts = account_cuts(t)
    return as_of(
        facts, tier_history(t, cuts), ["account_id"], "o_orderdate", "valid_from", "valid_to",
        ["tier", "valid_from"], cuts=cuts,
    )


@query(
    "pit_join_unmatched",
    f"""WITH {TIER_SQL}
SELECT event_type, COUNT(*) AS facts, COUNT(tier) AS matched, COUNT(*) - COUNT(tier) AS unmatched
FROM events LEFT JOIN tiers ON user_id = account_id AND ts - INTERVAL 9000 DAY >= valid_from
  AND (valid_to IS NULL OR ts - INTERVAL 9000 DAY < valid_to) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    facts = t.events.select(
        "event_id", "event_type", F.col("user_id").alias("account_id"),
        (F.col("ts") - F.make_dt_interval(F.lit(9000))).alias("at"),
    )
    joined = as_of(
        facts, tier_history(t), ["account_id"], "at", "valid_from", "valid_to", ["tier"], how="left"
    )
    return joined.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("facts"),
        F.count("tier").alias("matched"),
        F.count(F.when(F.col("tier").isNull(), 1)).alias("unmatched"),
    )


def version_trail(dim: DataFrame, key: str, value: str, at: str, cuts: Cuts | None = None) -> DataFrame:
    """Versions of keys that changed at least once: number of versions, previous value, growth."""
    line = Timeline(dim, [key], [at], cuts=cuts).near(before=1, previous=lambda w: F.lag(value).over(w))
    sizes = dim.groupBy(key).agg(F.count(F.lit(1)).alias("total_versions")).filter("total_versions > 1")
    return line.rows.join(sizes, key).withColumn(
        "growth_pct", percent(F.col(value) - F.col("previous"), "previous")
    )


@query(
    "version_history",
    f"""WITH {TIER_SQL},
trail AS (SELECT *, COUNT(*) OVER (PARTITION BY account_id) AS total_versions,
          LAG(spent) OVER (PARTITION BY account_id ORDER BY valid_from) AS previous FROM tiers)
SELECT account_id, tier, {d('spent')} AS spent, valid_from, valid_to, is_current, total_versions,
       {d('previous')} AS previous, {pct('(spent - previous)', 'previous')} AS growth_pct
FROM trail WHERE total_versions > 1""",
)
def _(t: Tables) -> DataFrame:
    cuts = account_cuts(t)
    dim = pin(tier_history(t, cuts), "dim")
    return version_trail(dim, "account_id", "spent", "valid_from", cuts).select(
        "account_id", "tier", "spent", "valid_from", "valid_to", "is_current", "total_versions", "previous", "growth_pct"
    )


@query(
    "version_snapshot",
    f"""WITH {TIER_SQL}
SELECT tier, CAST(CAST(valid_from AS DATE) AS VARCHAR)[1:4] AS since_year, is_current, COUNT(*) AS versions,
       {d('SUM(spent)')} AS spent, {d("SUM(" + m('c_acctbal') + ")")} AS balance
FROM tiers JOIN customer ON account_id = c_custkey GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"), "c_acctbal")
    return (
        tier_history(t)
        .join(accounts, "account_id")
        .groupBy("tier", F.year("valid_from").cast("string").alias("since_year"), "is_current")
        .agg(
            F.count(F.lit(1)).alias("versions"), F.sum("spent").alias("spent"),
            F.sum(amount("c_acctbal")).alias("balance"),
        )
    )
