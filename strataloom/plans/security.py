"""Alert deduplication, incident correlation, threat scoring and dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag_sum, percent, ratio
from ..functions.temporal import micros, truncated
from ..operators.aggregates import flag_first, share_of_total, top_category
from ..operators.ranking import surrogate_keys
from ..operators.sessions import first_per_bucket, number_sessions
from ..session import pin
from ..sources.tables import Tables, inline_rows
from .registry import query
from .sqltext import n, pct, ratio as sql_ratio

# fixed values: rule, technique, tactic, title, category
RULES = [
    ("R-SQL-INJ", "T1190", "initial-access", "SQL Injection Detection", "web-attack"),
    ("R-BRUTE-SSH", "T1110.001", "credential-access", "Brute Force SSH/VPN", "authentication"),
    ("R-POWERSHELL", "T1059.001", "execution", "Suspicious PowerShell", "execution"),
    ("R-REV-SHELL", "T1059.004", "execution", "Reverse Shell Detection", "command-control"),
    ("R-MALWARE", "T1204.002", "execution", "Malware Signature Match", "malware"),
    ("R-PERSIST", "T1547.001", "persistence", "Persistence Mechanism", "persistence"),
    ("R-PRIV-ESC", "T1068", "privilege-escalation", "Privilege Escalation", "privilege-escalation"),
    ("R-CRED-DUMP", "T1003.001", "credential-access", "Credential Dumping", "credential-access"),
    ("R-LAT-MOV", "T1021.002", "lateral-movement", "Lateral Movement SMB", "lateral-movement"),
    ("R-PORTSCAN", "T1046", "discovery", "Port Scan Detection", "reconnaissance"),
    ("R-DNS-TUN", "T1048.001", "exfiltration", "DNS Tunneling Exfil", "exfiltration"),
    ("R-EXFIL", "T1041", "exfiltration", "Data Exfiltration", "exfiltration"),
]


def rule_map(spark) -> DataFrame:
    schema = "rule_id string, technique string, tactic string, rule_name string, category string"
    return inline_rows(spark, schema, RULES)


def unify_alerts(feeds: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Alerts of several feeds with the name of their source; an alert id counts once per source."""
    out = None
    for source, df in feeds.items():
        part = df.select(*columns).withColumn("source", F.lit(source)).dropDuplicates(["alert_id"])
        out = part if out is None else out.unionByName(part)
    return out


def dedupe_alerts(alerts: DataFrame, minutes: int = 5) -> DataFrame:
    """First alert per source address, target, rule and five-minute bucket."""
    return first_per_bucket(alerts, ["source_ip", "target_host", "rule_id"], "detected_at", minutes, ["alert_id"])


def correlate_incidents(
    alerts: DataFrame, gap_minutes: float = 15, profile: DataFrame | None = None
) -> DataFrame:
    """Alerts of one address without a longer pause form an incident.

    Target and rule come from its most severe (then earliest) alert.
    """
    numbered = number_sessions(
        alerts, ["source_ip"], "detected_at", gap_minutes * 60, ["alert_id"], name="incident_no", profile=profile
    )
    key, seen = ["source_ip", "incident_no"], ["target_host", "rule_id"]
    rank = F.struct((-F.col("severity_score")).alias("s"), "detected_at", "alert_id", "severity")
    pairs = numbered.groupBy(*key, *seen).agg(
        F.min(rank).alias("_rank"),
        F.min("detected_at").alias("_first"),
        F.max("detected_at").alias("_last"),
        F.max("severity_score").alias("_score"),
        F.count(F.lit(1)).alias("_alerts"),
    )
    flagged = flag_first(pairs, key, {"_target": "target_host", "_rule": "rule_id"}, seen)
    grouped = flagged.groupBy(*key).agg(
        F.min_by(F.struct("target_host", "rule_id", "_rank.severity"), F.col("_rank")).alias("_worst"),
        F.min("_first").alias("first_detected_at"),
        F.max("_last").alias("last_detected_at"),
        F.max("_score").alias("max_severity_score"),
        F.sum("_alerts").alias("alert_count"),
        F.sum("_target").alias("distinct_targets"),
        F.sum("_rule").alias("distinct_rules"),
    )
    minutes = F.floor((micros("last_detected_at") - micros("first_detected_at")) / F.lit(60000000))
    return grouped.select(
        F.concat("source_ip", F.lit("-INC-"), F.col("incident_no").cast("string")).alias("incident_id"),
        "source_ip",
        F.col("_worst.target_host").alias("primary_target"),
        F.col("_worst.rule_id").alias("primary_rule_id"),
        "first_detected_at",
        "last_detected_at",
        F.col("_worst.severity").alias("max_severity"),
        "max_severity_score",
        "alert_count",
        "distinct_targets",
        "distinct_rules",
        minutes.alias("duration_minutes"),
    )


def incident_status(score: Column, known_bad: Column) -> Column:
    return (
        F.when((score >= 9) & known_bad, "escalated")
        .when(score >= 9, "investigating")
        .when(score >= 7, "triaging")
        .when(score >= 4, "monitoring")
        .otherwise("informational")
    )


def enrich_incidents(incidents: DataFrame, intel: DataFrame, rules: DataFrame) -> DataFrame:
    """Threat score of the address, technique of the rule, combined risk and status."""
    joined = incidents.join(intel, incidents["source_ip"] == intel["ip_address"], "left").join(
        rules.select("rule_id", "technique", "tactic"), F.col("primary_rule_id") == F.col("rule_id"), "left"
    )
    threat = F.coalesce("threat_score", F.lit(0))
    bad = F.coalesce("is_known_bad", F.lit(False))
    return joined.select(
        *incidents.columns,
        threat.alias("threat_score"),
        "threat_category",
        bad.alias("is_known_bad"),
        "technique",
        "tactic",
        (F.col("max_severity_score") * 10 + threat).alias("combined_risk_score"),
        incident_status(F.col("max_severity_score"), bad).alias("status"),
    )


def hourly_dashboard(facts: DataFrame) -> DataFrame:
    """Per hour: volumes, severities, most frequent tactic and address."""
    rows = facts.withColumn("hour_bucket", truncated("hour", "first_detected_at"))

    def level(name: str) -> Column:
        return flag_sum(F.col("max_severity") == name).alias(f"{name}_count")

    hourly = rows.groupBy("hour_bucket").agg(
        F.sum("alert_count").alias("total_alerts"),
        F.count_distinct("source_ip").alias("unique_sources"),
        F.count_distinct("primary_target").alias("unique_targets"),
        *[level(s) for s in ("critical", "high", "medium", "low")],
        ratio(F.sum("max_severity_score"), F.count(F.lit(1)), 1).alias("avg_severity_score"),
    )
    tactic = top_category(rows, ["hour_bucket"], "tactic", "top_tactic")
    address = top_category(rows, ["hour_bucket"], "source_ip", "top_source_ip")
    return hourly.join(tactic, "hour_bucket", "left").join(address, "hour_bucket", "left")


def response_metrics(facts: DataFrame) -> DataFrame:
    """Per severity and day: volume, durations and escalations."""
    return facts.groupBy(
        F.col("max_severity").alias("severity"), F.date_format("first_detected_at", "yyyy-MM-dd").alias("period")
    ).agg(
        F.count(F.lit(1)).alias("incident_count"),
        ratio(F.sum("alert_count"), F.count(F.lit(1)), 1).alias("avg_alert_count"),
        ratio(F.sum("duration_minutes"), F.count(F.lit(1)), 1).alias("avg_duration_min"),
        F.max("duration_minutes").alias("max_duration_min"),
        flag_sum(F.col("status") == "escalated").alias("escalated_count"),
        percent(flag_sum(F.col("status") == "escalated"), F.count(F.lit(1))).alias("escalated_pct"),
        ratio(F.sum("threat_score"), F.count(F.lit(1)), 1).alias("avg_threat_score"),
    )


def host_dim(alerts: DataFrame) -> DataFrame:
    """Hosts with environment and criticality read from their names."""
    host = F.col("hostname")
    environment = (
        F.when(host.like("%prod%"), "production")
        .when(host.like("%dev%"), "development")
        .when(host.isin("vpn-gw-01", "jump-01"), "dmz")
        .otherwise("unknown")
    )
    criticality = (
        F.when(host.like("db-%") | host.like("web-prod%") | host.like("api-prod%"), "critical")
        .when(host.like("mail-%") | host.like("vpn-%") | (host == "jump-01"), "high")
        .otherwise("medium")
    )
    hosts = alerts.select(F.col("target_host").alias("hostname")).distinct()
    named = hosts.withColumns({"environment": environment, "criticality": criticality})
    return surrogate_keys(named, ["hostname"], "target_key")


def rule_dim(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    used = alerts.select("rule_id").distinct().join(
        rules.select("rule_id", "rule_name", "category"), "rule_id", "left"
    )
    named = used.select(
        "rule_id",
        F.coalesce("rule_name", "rule_id").alias("rule_name"),
        F.coalesce("category", F.lit("other")).alias("category"),
    )
    return surrogate_keys(named, ["rule_id"], "rule_key")


# stand-ins: events as alerts of three feeds, customers as threat intelligence


def address(number: str) -> Column:
    n_ = F.col(number)
    return F.concat_ws(".", F.lit("10"), F.floor(n_ / 65536) % 256, F.floor(n_ / 256) % 256, n_ % 256)


def event_alerts(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    score = F.least(F.lit(10), F.floor(F.col("value") / 20) + 1).cast("int")
    shaped = t.events.select(
        F.col("event_id").alias("alert_id"),
        address("user_id").alias("source_ip"),
        F.when(kind == "view", F.concat(F.lit("web-prod-"), k))
        .when(kind == "click", F.concat(F.lit("api-prod-"), k))
        .when(kind == "signup", F.lit("vpn-gw-01"))
        .when(kind == "purchase", F.concat(F.lit("db-dev-"), k))
        .otherwise(F.concat(F.lit("mail-"), k))
        .alias("target_host"),
        F.when(kind == "view", "R-PORTSCAN")
        .when(kind == "click", "R-SQL-INJ")
        .when(kind == "signup", "R-BRUTE-SSH")
        .when(kind == "purchase", "R-EXFIL")
        .otherwise("R-UNLISTED")
        .alias("rule_id"),
        F.col("ts").alias("detected_at"),
        score.alias("severity_score"),
        "event_type",
    )
    s = F.col("severity_score")
    source = F.when(kind.isin("view", "click"), "firewall").when(kind.isin("signup", "purchase"), "ids")
    return shaped.withColumns(
        {
            "severity": F.when(s >= 9, "critical").when(s >= 7, "high").when(s >= 4, "medium").otherwise("low"),
            "source": source.otherwise("endpoint"),
        }
    )


def alert_feeds(t: Tables) -> DataFrame:
    """The alerts as they arrive: three feeds, one of them delivered twice."""
    alerts = event_alerts(t)
    feeds = {name: alerts.filter(F.col("source") == name).drop("source") for name in ("firewall", "ids", "endpoint")}
    feeds["ids"] = feeds["ids"].unionByName(feeds["ids"])
    return unify_alerts(feeds, [c for c in alerts.columns if c != "source"])


def customer_intel(t: Tables) -> DataFrame:
    return t.customer.select(
        address("c_custkey").alias("ip_address"),
        F.greatest(F.lit(0), F.floor(F.col("c_acctbal") / 100)).alias("threat_score"),
        F.col("c_mktsegment").alias("threat_category"),
        (F.col("c_acctbal") > 5000).alias("is_known_bad"),
    )


def event_incidents(t: Tables) -> DataFrame:
    scan = t.events.select(
        address("user_id").alias("source_ip"), F.col("ts").alias("detected_at"), F.col("event_id").alias("alert_id")
    )
    return correlate_incidents(dedupe_alerts(event_alerts(t)), gap_minutes=720, profile=scan)


def incident_facts(t: Tables) -> DataFrame:
    return enrich_incidents(event_incidents(t), customer_intel(t), rule_map(t.spark))


_IP = "'10.' || CAST(({u} // 65536) % 256 AS VARCHAR) || '.' || CAST(({u} // 256) % 256 AS VARCHAR) || '.' || CAST({u} % 256 AS VARCHAR)"
ALERTS_SQL = f"""
alerts AS (
  SELECT *, CASE WHEN severity_score >= 9 THEN 'critical' WHEN severity_score >= 7 THEN 'high'
                 WHEN severity_score >= 4 THEN 'medium' ELSE 'low' END AS severity FROM (
  SELECT event_id AS alert_id, {_IP.format(u='user_id')} AS source_ip, ts AS detected_at,
    CASE event_type WHEN 'view' THEN 'web-prod-' || regexp_extract(props, '[0-9]+') WHEN 'click' THEN 'api-prod-' || regexp_extract(props, '[0-9]+')
      WHEN 'signup' THEN 'vpn-gw-01' WHEN 'purchase' THEN 'db-dev-' || regexp_extract(props, '[0-9]+')
      ELSE 'mail-' || regexp_extract(props, '[0-9]+') END AS target_host,
    CASE event_type WHEN 'view' THEN 'R-PORTSCAN' WHEN 'click' THEN 'R-SQL-INJ' WHEN 'signup' THEN 'R-BRUTE-SSH'
      WHEN 'purchase' THEN 'R-EXFIL' ELSE 'R-UNLISTED' END AS rule_id,
    CASE event_type WHEN 'view' THEN 'firewall' WHEN 'click' THEN 'firewall' WHEN 'signup' THEN 'ids' WHEN 'purchase' THEN 'ids' ELSE 'endpoint' END AS source,
    LEAST(10, CAST(floor(value / 20) AS BIGINT) + 1) AS severity_score FROM events)),
deduped AS (
  SELECT * FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, detected_at) AS bucket,
    ROW_NUMBER() OVER (PARTITION BY source_ip, target_host, rule_id, time_bucket(INTERVAL 5 MINUTE, detected_at)
                       ORDER BY detected_at, alert_id) AS rn FROM alerts) WHERE rn = 1)"""
INCIDENTS_SQL = f"""{ALERTS_SQL},
gaps AS (SELECT *, CASE WHEN epoch_us(detected_at) - epoch_us(LAG(detected_at) OVER w) <= 43200000000 THEN 0 ELSE 1 END AS brk
  FROM deduped WINDOW w AS (PARTITION BY source_ip ORDER BY detected_at, alert_id)),
numbered AS (SELECT *, SUM(brk) OVER (PARTITION BY source_ip ORDER BY detected_at, alert_id) AS no FROM gaps),
incidents AS (
  SELECT source_ip || '-INC-' || CAST(CAST(no AS BIGINT) AS VARCHAR) AS incident_id, source_ip,
    arg_min(target_host, ROW(-severity_score, detected_at, alert_id)) AS primary_target,
    arg_min(rule_id, ROW(-severity_score, detected_at, alert_id)) AS primary_rule_id,
    MIN(detected_at) AS first_detected_at, MAX(detected_at) AS last_detected_at,
    arg_min(severity, ROW(-severity_score, detected_at, alert_id)) AS max_severity,
    MAX(severity_score) AS max_severity_score, COUNT(*) AS alert_count,
    COUNT(DISTINCT target_host) AS distinct_targets, COUNT(DISTINCT rule_id) AS distinct_rules,
    (epoch_us(MAX(detected_at)) - epoch_us(MIN(detected_at))) // 60000000 AS duration_minutes
  FROM numbered GROUP BY source_ip, no)"""
_MAP = ", ".join(f"('{x[0]}', '{x[1]}', '{x[2]}')" for x in RULES)
FACTS_SQL = f"""{INCIDENTS_SQL},
intel AS (SELECT {_IP.format(u='c_custkey')} AS ip_address, GREATEST(0, CAST(floor(c_acctbal / 100) AS BIGINT)) AS threat_score,
          c_mktsegment AS threat_category, c_acctbal > 5000 AS is_known_bad FROM customer),
rules AS (SELECT * FROM (VALUES {_MAP}) AS x(rule_id, technique, tactic)),
facts AS (
  SELECT i.*, COALESCE(t.threat_score, 0) AS threat_score, threat_category, COALESCE(is_known_bad, FALSE) AS is_known_bad,
    technique, tactic, max_severity_score * 10 + COALESCE(t.threat_score, 0) AS combined_risk_score,
    CASE WHEN max_severity_score >= 9 AND COALESCE(is_known_bad, FALSE) THEN 'escalated' WHEN max_severity_score >= 9 THEN 'investigating'
      WHEN max_severity_score >= 7 THEN 'triaging' WHEN max_severity_score >= 4 THEN 'monitoring' ELSE 'informational' END AS status
  FROM incidents i LEFT JOIN intel t ON source_ip = ip_address LEFT JOIN rules r ON primary_rule_id = r.rule_id)"""


@query(
    "dedup_bucket_5min",
    f"""WITH {ALERTS_SQL} SELECT alert_id, source, source_ip, target_host, rule_id, detected_at, bucket FROM deduped""",
)
def _(t: Tables) -> DataFrame:
    return dedupe_alerts(alert_feeds(t)).select(
        "alert_id", "source", "source_ip", "target_host", "rule_id", "detected_at", "bucket"
    )


@query("incident_correlation", f"WITH {INCIDENTS_SQL} SELECT * FROM incidents")
def _(t: Tables) -> DataFrame:
    return event_incidents(t)


@query(
    "threat_enrichment",
    f"""WITH {FACTS_SQL}
SELECT incident_id, threat_score, threat_category, is_known_bad, technique, tactic, combined_risk_score, status FROM facts""",
)
def _(t: Tables) -> DataFrame:
    return incident_facts(t).select(
        "incident_id", "threat_score", "threat_category", "is_known_bad", "technique", "tactic",
        "combined_risk_score", "status",
    )


def _top_sql(column: str) -> str:
    return f"""(SELECT h, arg_min({column}, ROW(-c, {column})) AS best FROM (SELECT h, {column}, COUNT(*) AS c FROM f
  WHERE {column} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "hourly_dashboard",
    f"""WITH {FACTS_SQL}, f AS (SELECT *, date_trunc('hour', first_detected_at) AS h FROM facts),
agg AS (SELECT h, {n('SUM(alert_count)')} AS total_alerts, COUNT(DISTINCT source_ip) AS unique_sources,
  COUNT(DISTINCT primary_target) AS unique_targets, COUNT(CASE WHEN max_severity = 'critical' THEN 1 END) AS critical_count,
  COUNT(CASE WHEN max_severity = 'high' THEN 1 END) AS high_count, COUNT(CASE WHEN max_severity = 'medium' THEN 1 END) AS medium_count,
  COUNT(CASE WHEN max_severity = 'low' THEN 1 END) AS low_count, {sql_ratio('SUM(max_severity_score)', 'COUNT(*)', 1)} AS avg_severity_score
  FROM f GROUP BY 1)
SELECT agg.h AS hour_bucket, agg.* EXCLUDE (h), a.best AS top_tactic, b.best AS top_source_ip
FROM agg LEFT JOIN {_top_sql('tactic')} a ON agg.h = a.h LEFT JOIN {_top_sql('source_ip')} b ON agg.h = b.h""",
)
def _(t: Tables) -> DataFrame:
    return hourly_dashboard(pin(incident_facts(t), "facts"))


@query(
    "response_metrics",
    f"""WITH {FACTS_SQL}
SELECT max_severity AS severity, strftime(first_detected_at, '%Y-%m-%d') AS period, COUNT(*) AS incident_count,
  {sql_ratio('SUM(alert_count)', 'COUNT(*)', 1)} AS avg_alert_count, {sql_ratio('SUM(duration_minutes)', 'COUNT(*)', 1)} AS avg_duration_min,
  MAX(duration_minutes) AS max_duration_min, COUNT(CASE WHEN status = 'escalated' THEN 1 END) AS escalated_count,
  {pct("COUNT(CASE WHEN status = 'escalated' THEN 1 END)", 'COUNT(*)')} AS escalated_pct,
  {sql_ratio('SUM(threat_score)', 'COUNT(*)', 1)} AS avg_threat_score FROM facts GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return response_metrics(incident_facts(t))


@query(
    "target_heat_map",
    f"""WITH {FACTS_SQL}
SELECT primary_target, COUNT(*) AS incidents, {n('SUM(alert_count)')} AS alerts, MAX(combined_risk_score) AS worst_risk,
  {pct('COUNT(*)', '(SELECT COUNT(*) FROM facts)')} AS pct_of_incidents FROM facts GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    by_target = incident_facts(t).groupBy("primary_target").agg(
        F.count(F.lit(1)).alias("incidents"), F.sum("alert_count").alias("alerts"),
        F.max("combined_risk_score").alias("worst_risk"),
    )
    return share_of_total(pin(by_target, "targets"), "incidents", "pct_of_incidents")


@query(
    "threat_by_geography",
    f"""WITH {FACTS_SQL}, place AS (SELECT {_IP.format(u='c_custkey')} AS ip, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name AS country, COUNT(*) AS incidents, {n('SUM(alert_count)')} AS total_alerts, {sql_ratio('SUM(threat_score)', 'COUNT(*)', 1)} AS avg_threat_score,
  COUNT(CASE WHEN is_known_bad THEN 1 END) AS known_bad_incidents FROM facts JOIN place ON source_ip = ip GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Incidents by the country that the address belongs to."""
    place = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        address("c_custkey").alias("ip"), F.col("n_name").alias("country")
    )
    found = incident_facts(t).join(place, F.col("source_ip") == F.col("ip"))
    return found.groupBy("country").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.sum("alert_count").alias("total_alerts"),
        ratio(F.sum("threat_score"), F.count(F.lit(1)), 1).alias("avg_threat_score"),
        F.count(F.when(F.col("is_known_bad"), 1)).alias("known_bad_incidents"),
    )


@query(
    "tactic_chain",
    f"""WITH {FACTS_SQL}
SELECT tactic, technique, status, COUNT(*) AS incidents, COUNT(DISTINCT source_ip) AS sources,
  {sql_ratio('SUM(combined_risk_score)', 'COUNT(*)', 2)} AS avg_risk FROM facts WHERE tactic IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return (
        incident_facts(t)
        .filter(F.col("tactic").isNotNull())
        .groupBy("tactic", "technique", "status")
        .agg(
            F.count(F.lit(1)).alias("incidents"),
            F.count_distinct("source_ip").alias("sources"),
            ratio(F.sum("combined_risk_score"), F.count(F.lit(1)), 2).alias("avg_risk"),
        )
    )


@query(
    "entity_classification",
    f"""WITH {ALERTS_SQL}, h AS (SELECT DISTINCT target_host AS hostname FROM alerts)
SELECT {n('ROW_NUMBER() OVER (ORDER BY hostname)')} AS target_key, hostname,
  CASE WHEN hostname LIKE '%prod%' THEN 'production' WHEN hostname LIKE '%dev%' THEN 'development'
       WHEN hostname IN ('vpn-gw-01', 'jump-01') THEN 'dmz' ELSE 'unknown' END AS environment,
  CASE WHEN hostname LIKE 'db-%' OR hostname LIKE 'web-prod%' OR hostname LIKE 'api-prod%' THEN 'critical'
       WHEN hostname LIKE 'mail-%' OR hostname LIKE 'vpn-%' THEN 'high' ELSE 'medium' END AS criticality FROM h""",
)
def _(t: Tables) -> DataFrame:
    return host_dim(event_alerts(t))


_RULE_DIM = ", ".join(f"('{x[0]}', '{x[3]}', '{x[4]}')" for x in RULES)


@query(
    "rule_dim",
    f"""WITH {ALERTS_SQL}, u AS (SELECT DISTINCT rule_id FROM alerts), k AS (SELECT * FROM (VALUES {_RULE_DIM}) AS x(rid, nm, cat))
SELECT {n('ROW_NUMBER() OVER (ORDER BY rule_id)')} AS rule_key, rule_id, COALESCE(nm, rule_id) AS rule_name,
  COALESCE(cat, 'other') AS category FROM u LEFT JOIN k ON rule_id = rid""",
)
def _(t: Tables) -> DataFrame:
    return rule_dim(event_alerts(t), rule_map(t.spark))
