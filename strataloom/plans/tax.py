"""Filings, amendments, taxpayer and preparer profiles, revenue KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import amount, band, flag_sum, money, percent, ratio, rounded
from ..operators.ranking import ntile, rank_values, surrogate_keys
from ..operators.scd import amended
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, day, m, n, pct, r, ratio as sql_ratio
from .standins import LINES_SQL, order_lines

# fixed values
BRACKET_EDGES = (50_000, 100_000, 250_000, 500_000, 1_000_000)
BRACKETS = ("Under $50K", "$50K-$100K", "$100K-$250K", "$250K-$500K", "$500K-$1M", "Over $1M")


def filing_metrics(filings: DataFrame, audit_share: float = 0.40) -> DataFrame:
    """Effective rate, deduction share, audit flag and income bracket of each filing."""
    gross = F.col("gross_income").cast("double")
    share = F.col("deductions").cast("double") / gross
    return filings.withColumns(
        {
            "effective_rate": ratio("tax_owed", "gross_income", 4, default=0),
            "deduction_pct": percent("deductions", "gross_income", default=0),
            "audit_flag": F.coalesce(F.when(gross > 0, share > audit_share), F.lit(False)),
            "income_bracket": band(F.col("gross_income"), BRACKET_EDGES, BRACKETS),
        }
    )


def amendment_deltas(amendments: DataFrame, filings: DataFrame, large: float = 0.20) -> DataFrame:
    """Change of income and tax against the original filing; large above a fifth."""
    joined = amendments.join(
        filings.select("filing_id", F.col("gross_income").alias("original_income"), F.col("tax_owed").alias("original_tax")),
        "filing_id",
    )
    income = F.col("income") - F.col("original_income")
    moved = F.abs(income).cast("double") / F.col("original_income").cast("double")
    return joined.withColumns(
        {
            "income_delta": income,
            "tax_delta": F.col("tax") - F.col("original_tax"),
            "delta_pct": percent(F.abs(income), "original_income", default=0),
            "large_delta": F.coalesce(F.when(F.col("original_income") > 0, moved > large), F.lit(False)),
        }
    )


def effective_filings(filings: DataFrame, amendments: DataFrame) -> DataFrame:
    """Filings with the latest amendment taking the place of the original values."""
    rows = amended(filings, amendments, "filing_id", "amendment_date", ["amendment_id"], ["income", "tax"])
    return rows.withColumns(
        {
            "effective_income": F.coalesce("amended_income", "gross_income"),
            "effective_tax": F.coalesce("amended_tax", "tax_owed"),
        }
    ).drop("amended_income", "amended_tax")


def taxpayer_profiles(taxpayers: DataFrame, filings: DataFrame, amendments: DataFrame) -> DataFrame:
    """One row per taxpayer over all filings, with the bracket of the latest one."""
    stats = filings.groupBy("taxpayer_id").agg(
        F.count(F.lit(1)).alias("_filings"),
        F.sum("gross_income").alias("_income"),
        F.sum("tax_owed").alias("_tax"),
        ratio(F.sum(F.col("deduction_pct").cast("decimal(18,2)")), F.count(F.lit(1)), 2).alias("_deduction"),
        F.max(F.col("filing_status") == "Audited").alias("_audited"),
        F.max_by("income_bracket", F.struct("fiscal_year", "filing_date", "filing_id")).alias("latest_bracket"),
    )
    changes = amendments.join(filings.select("filing_id", "taxpayer_id"), "filing_id").groupBy("taxpayer_id").agg(
        F.count(F.lit(1)).alias("_amendments")
    )
    zero = F.lit(0)
    return (
        taxpayers.join(stats, "taxpayer_id", "left")
        .join(changes, "taxpayer_id", "left")
        .select(
            "taxpayer_id",
            F.coalesce("_filings", zero).cast("bigint").alias("total_filings"),
            F.coalesce("_amendments", zero).cast("bigint").alias("total_amendments"),
            F.coalesce("_income", zero).cast("double").alias("lifetime_income"),
            F.coalesce("_tax", zero).cast("double").alias("lifetime_tax"),
            "latest_bracket",
            F.coalesce("_deduction", F.lit(0.0)).alias("avg_deduction_pct"),
            F.coalesce("_audited", F.lit(False)).alias("ever_audited"),
        )
    )


def revenue_kpi(facts: DataFrame) -> DataFrame:
    """Jurisdiction and year: volumes, compliance rate, amendments and audit yield."""
    flagged = F.col("audit_flag")
    gained = F.when(flagged & F.col("was_amended"), F.col("effective_tax") - F.col("tax_owed")).otherwise(0)
    return facts.groupBy("fiscal_year", "jurisdiction").agg(
        F.count(F.lit(1)).alias("total_filings"),
        F.sum("effective_income").alias("total_income"),
        F.sum("effective_tax").alias("total_tax"),
        flag_sum(flagged).alias("audit_flag_count"),
        percent(flag_sum(F.col("filing_status").isin("Accepted", "Filed")), F.count(F.lit(1))).alias("compliance_rate"),
        flag_sum(F.col("was_amended")).alias("amendment_count"),
        percent(F.sum(gained), F.sum(F.when(flagged, F.col("tax_owed")).otherwise(0))).alias("audit_yield_pct"),
    )


def preparer_quality(facts: DataFrame) -> DataFrame:
    whole = F.count(F.lit(1))
    amended_rows = flag_sum(F.col("was_amended"))
    audited = flag_sum(F.col("filing_status") == "Audited")
    return facts.groupBy("preparer").agg(
        whole.alias("total_filings"),
        amended_rows.alias("amended_filings"),
        percent(amended_rows, whole).alias("amendment_rate_pct"),
        audited.alias("audit_count"),
        percent(audited, whole).alias("audit_rate_pct"),
        ratio(F.sum("gross_income"), whole, 2).alias("avg_income"),
        ratio(F.sum(F.col("deduction_pct").cast("decimal(18,2)")), whole, 2).alias("avg_deduction_pct"),
    )


def fiscal_years(filings: DataFrame, amendments: DataFrame) -> DataFrame:
    """One row per fiscal year: deadline on 15 April of the next year and counts."""
    counted = filings.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("total_filings"), flag_sum(F.col("audit_flag")).alias("audit_flag_count")
    )
    changes = amendments.groupBy((F.year("amendment_date") - 1).alias("fiscal_year")).agg(
        F.count(F.lit(1)).alias("_amendments")
    )
    joined = counted.join(changes, "fiscal_year", "left").select(
        "fiscal_year",
        F.make_date(F.col("fiscal_year") + 1, F.lit(4), F.lit(15)).alias("filing_deadline"),
        "total_filings",
        F.coalesce("_amendments", F.lit(0)).cast("bigint").alias("total_amendments"),
        "audit_flag_count",
    )
    return surrogate_keys(joined, ["fiscal_year"], "fiscal_year_key")


def year_over_year(facts: DataFrame, group: str, year: str, value: Column) -> DataFrame:
    """Yearly total per group with the change against the year before."""
    yearly = facts.groupBy(group, year).agg(F.sum(value).alias("total"))
    # one row per group and year
    before = F.lag("total").over(Window.partitionBy(group).orderBy(year))
    return yearly.withColumn("previous", before).withColumn(
        "change_pct", percent(F.col("total") - F.col("previous"), "previous")
    )


# stand-ins: orders as filings, returned lines as amendments


def order_filings(t: Tables) -> DataFrame:
    sums = order_lines(t).groupBy("l_orderkey").agg(
        F.sum("discount_amount").alias("_d"), F.sum("tax_amount").alias("_t")
    )
    status = F.col("o_orderstatus")
    nations = t.customer.select("c_custkey", "c_nationkey").join(
        t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    filings = (
        t.orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(nations.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("filing_id"),
            F.col("o_custkey").alias("taxpayer_id"),
            F.col("n_name").alias("jurisdiction"),
            F.col("o_orderpriority").alias("preparer"),
            F.year("o_orderdate").alias("fiscal_year"),
            F.col("o_orderdate").alias("filing_date"),
            amount("o_totalprice").alias("gross_income"),
            F.coalesce(money("_d") * 10, F.lit(0)).cast("decimal(18,2)").alias("deductions"),
            F.coalesce(money("_t"), F.lit(0)).cast("decimal(18,2)").alias("tax_owed"),
            F.when(status == "F", "Accepted").when(status == "P", "Filed").otherwise("Audited").alias("filing_status"),
        )
    )
    return filing_metrics(filings)


def return_amendments(t: Tables) -> DataFrame:
    returned = order_lines(t).filter("l_returnflag = 'R'")
    return returned.groupBy(F.col("l_orderkey").alias("filing_id"), F.col("l_shipdate").alias("amendment_date")).agg(
        F.min("l_partkey").alias("amendment_id"), F.sum("price").alias("income"), money(F.sum("tax_amount")).alias("tax")
    )


FILINGS_SQL = f"""{LINES_SQL},
filings AS (
  SELECT *, COALESCE({sql_ratio('tax_owed', 'gross_income', 4)}, 0) AS effective_rate, COALESCE({pct('deductions', 'gross_income')}, 0) AS deduction_pct,
    COALESCE(CASE WHEN gross_income > 0 THEN CAST(deductions AS DOUBLE) / CAST(gross_income AS DOUBLE) > 0.40 END, FALSE) AS audit_flag,
    CASE WHEN gross_income < 50000 THEN 'Under $50K' WHEN gross_income < 100000 THEN '$50K-$100K' WHEN gross_income < 250000 THEN '$100K-$250K'
      WHEN gross_income < 500000 THEN '$250K-$500K' WHEN gross_income < 1000000 THEN '$500K-$1M' ELSE 'Over $1M' END AS income_bracket
  FROM (SELECT o_orderkey AS filing_id, o_custkey AS taxpayer_id, n_name AS jurisdiction, o_orderpriority AS preparer,
      CAST(year(o_orderdate) AS BIGINT) AS fiscal_year, o_orderdate AS filing_date, {m('o_totalprice')} AS gross_income,
      COALESCE(CAST(s.dd AS DECIMAL(18,2)) * 10, 0)::DECIMAL(18,2) AS deductions, COALESCE(CAST(s.tt AS DECIMAL(18,2)), 0)::DECIMAL(18,2) AS tax_owed,
      CASE o_orderstatus WHEN 'F' THEN 'Accepted' WHEN 'P' THEN 'Filed' ELSE 'Audited' END AS filing_status
    FROM orders LEFT JOIN (SELECT l_orderkey, SUM(discount_amount) AS dd, SUM(tax_amount) AS tt FROM lines GROUP BY 1) s ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)),
amendments AS (SELECT l_orderkey AS filing_id, l_shipdate AS amendment_date, MIN(l_partkey) AS amendment_id, SUM(price) AS income,
  CAST(SUM(tax_amount) AS DECIMAL(18,2)) AS tax FROM lines WHERE l_returnflag = 'R' GROUP BY 1, 2),
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY filing_id ORDER BY amendment_date DESC, amendment_id DESC) AS rn,
  COUNT(*) OVER (PARTITION BY filing_id) AS k FROM amendments) WHERE rn = 1),
facts AS (SELECT f.*, a.filing_id IS NOT NULL AS was_amended, COALESCE(k, 0) AS amendment_count,
  COALESCE(a.income, gross_income) AS effective_income, COALESCE(a.tax, tax_owed) AS effective_tax
  FROM filings f LEFT JOIN latest a ON f.filing_id = a.filing_id)"""


def filing_facts(t: Tables) -> DataFrame:
    return effective_filings(order_filings(t), return_amendments(t))


@query(
    "filing_metrics",
    f"""WITH {FILINGS_SQL}
SELECT filing_id, {d('gross_income')} AS gross_income, {d('deductions')} AS deductions, effective_rate, deduction_pct, audit_flag, income_bracket FROM filings""",
)
def _(t: Tables) -> DataFrame:
    return order_filings(t).select(
        "filing_id", "gross_income", "deductions", "effective_rate", "deduction_pct", "audit_flag", "income_bracket"
    )


@query(
    "amendment_deltas",
    f"""WITH {FILINGS_SQL}
SELECT a.filing_id, amendment_date, {d('a.income - gross_income')} AS income_delta, {d('a.tax - tax_owed')} AS tax_delta,
  COALESCE({pct('abs(a.income - gross_income)', 'gross_income')}, 0) AS delta_pct,
  CAST(abs(a.income - gross_income) AS DOUBLE) / CAST(gross_income AS DOUBLE) > 0.20 AS large_delta
FROM amendments a JOIN filings f ON a.filing_id = f.filing_id""",
)
def _(t: Tables) -> DataFrame:
    return amendment_deltas(return_amendments(t), order_filings(t)).select(
        "filing_id", "amendment_date", "income_delta", "tax_delta", "delta_pct", "large_delta"
    )


@query(
    "ledger_amendments",
    f"""WITH {FILINGS_SQL}
SELECT filing_id, {d('effective_income')} AS effective_income, {d('effective_tax')} AS effective_tax, was_amended, amendment_count FROM facts""",
)
def _(t: Tables) -> DataFrame:
    return filing_facts(t).select("filing_id", "effective_income", "effective_tax", "was_amended", "amendment_count")


@query(
    "customer_lifetime_profile",
    f"""WITH {FILINGS_SQL},
s AS (SELECT taxpayer_id, COUNT(*) AS k, SUM(gross_income) AS i, SUM(tax_owed) AS x, {sql_ratio('SUM(CAST(deduction_pct AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS dp,
  bool_or(filing_status = 'Audited') AS aud, arg_max(income_bracket, ROW(fiscal_year, filing_date, filing_id)) AS br FROM filings GROUP BY 1),
a AS (SELECT taxpayer_id, COUNT(*) AS k FROM amendments JOIN filings USING (filing_id) GROUP BY 1)
SELECT c_custkey AS taxpayer_id, COALESCE(s.k, 0) AS total_filings, COALESCE(a.k, 0) AS total_amendments, COALESCE({d('i')}, 0) AS lifetime_income,
  COALESCE({d('x')}, 0) AS lifetime_tax, br AS latest_bracket, COALESCE(dp, 0) AS avg_deduction_pct, COALESCE(aud, FALSE) AS ever_audited
FROM customer LEFT JOIN s ON c_custkey = s.taxpayer_id LEFT JOIN a ON c_custkey = a.taxpayer_id""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.select(F.col("c_custkey").alias("taxpayer_id"))
    return taxpayer_profiles(people, pin(order_filings(t), "filings"), return_amendments(t))


@query(
    "compliance_kpi",
    f"""WITH {FILINGS_SQL}
SELECT fiscal_year, jurisdiction, COUNT(*) AS total_filings, {d('SUM(effective_income)')} AS total_income, {d('SUM(effective_tax)')} AS total_tax,
  COUNT(CASE WHEN audit_flag THEN 1 END) AS audit_flag_count,
  {pct("COUNT(CASE WHEN filing_status IN ('Accepted', 'Filed') THEN 1 END)", 'COUNT(*)')} AS compliance_rate,
  COUNT(CASE WHEN was_amended THEN 1 END) AS amendment_count,
  {pct('SUM(CASE WHEN audit_flag AND was_amended THEN effective_tax - tax_owed ELSE 0 END)', 'SUM(CASE WHEN audit_flag THEN tax_owed ELSE 0 END)')} AS audit_yield_pct
FROM facts GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return revenue_kpi(filing_facts(t))


@query(
    "preparer_quality",
    f"""WITH {FILINGS_SQL}
SELECT preparer, COUNT(*) AS total_filings, COUNT(CASE WHEN was_amended THEN 1 END) AS amended_filings,
  {pct('COUNT(CASE WHEN was_amended THEN 1 END)', 'COUNT(*)')} AS amendment_rate_pct, COUNT(CASE WHEN filing_status = 'Audited' THEN 1 END) AS audit_count,
  {pct("COUNT(CASE WHEN filing_status = 'Audited' THEN 1 END)", 'COUNT(*)')} AS audit_rate_pct, {sql_ratio('SUM(gross_income)', 'COUNT(*)', 2)} AS avg_income,
  {sql_ratio('SUM(CAST(deduction_pct AS DECIMAL(18,2)))', 'COUNT(*)', 2)} AS avg_deduction_pct FROM facts GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return preparer_quality(filing_facts(t))


@query(
    "year_dim_counts",
    f"""WITH {FILINGS_SQL}, a AS (SELECT year(amendment_date) - 1 AS y, COUNT(*) AS k FROM amendments GROUP BY 1),
f AS (SELECT fiscal_year, COUNT(*) AS total_filings, COUNT(CASE WHEN audit_flag THEN 1 END) AS audit_flag_count FROM filings GROUP BY 1)
SELECT {n('ROW_NUMBER() OVER (ORDER BY fiscal_year)')} AS fiscal_year_key, fiscal_year, {day('make_date(fiscal_year + 1, 4, 15)')} AS filing_deadline,
  total_filings, COALESCE(k, 0) AS total_amendments, audit_flag_count FROM f LEFT JOIN a ON fiscal_year = y""",
)
def _(t: Tables) -> DataFrame:
    return fiscal_years(order_filings(t), return_amendments(t))


@query(
    "yoy_growth",
    f"""WITH {FILINGS_SQL}, y AS (SELECT jurisdiction, fiscal_year, SUM(effective_tax) AS total FROM facts GROUP BY 1, 2),
p AS (SELECT *, LAG(total) OVER (PARTITION BY jurisdiction ORDER BY fiscal_year) AS previous FROM y)
SELECT jurisdiction, fiscal_year, {d('total')} AS total, {d('previous')} AS previous, {pct('(total - previous)', 'previous')} AS change_pct FROM p""",
)
def _(t: Tables) -> DataFrame:
    return year_over_year(filing_facts(t), "jurisdiction", "fiscal_year", F.col("effective_tax"))


@query(
    "income_quartiles",
    f"""WITH {FILINGS_SQL}
SELECT filing_id, income_bracket, {n('NTILE(4) OVER (ORDER BY gross_income, filing_id)')} AS income_quartile, was_amended FROM facts""",
)
def _(t: Tables) -> DataFrame:
    facts = filing_facts(t).select("filing_id", "income_bracket", "gross_income", "was_amended")
    return ntile(facts, ["gross_income", "filing_id"], 4, "income_quartile").drop("gross_income")


@query(
    "contribution_percentile",
    f"""WITH {FILINGS_SQL}, s AS (SELECT taxpayer_id, SUM(effective_tax) AS total, COUNT(DISTINCT fiscal_year) AS years_filed,
  {n('SUM(amendment_count)')} AS total_amendments FROM facts GROUP BY 1)
SELECT taxpayer_id, {d('total')} AS total_tax, years_filed, total_amendments, {r('PERCENT_RANK() OVER (ORDER BY total)', 5)} AS tax_percentile FROM s""",
)
def _(t: Tables) -> DataFrame:
    sums = filing_facts(t).groupBy("taxpayer_id").agg(
        F.sum("effective_tax").alias("total_tax"), F.count_distinct("fiscal_year").alias("years_filed"),
        F.sum("amendment_count").alias("total_amendments"),
    )
    ranked = rank_values(sums, "total_tax", percent_rank="_share")
    return ranked.withColumn("tax_percentile", rounded("_share", 5)).drop("_share")


@query(
    "refund_analysis",
    f"""WITH {FILINGS_SQL}
SELECT fiscal_year, preparer, COUNT(*) AS filings, COUNT(CASE WHEN effective_tax < tax_owed THEN 1 END) AS got_refund,
  COUNT(CASE WHEN effective_tax > tax_owed THEN 1 END) AS owed_more, {sql_ratio('SUM(tax_owed - effective_tax)', 'COUNT(*)', 2)} AS avg_refund,
  {sql_ratio('SUM(effective_tax)', 'COUNT(*)', 2)} AS avg_effective_tax FROM facts GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    whole = F.count(F.lit(1))
    return filing_facts(t).groupBy("fiscal_year", "preparer").agg(
        whole.alias("filings"),
        flag_sum(F.col("effective_tax") < F.col("tax_owed")).alias("got_refund"),
        flag_sum(F.col("effective_tax") > F.col("tax_owed")).alias("owed_more"),
        ratio(F.sum(F.col("tax_owed") - F.col("effective_tax")), whole, 2).alias("avg_refund"),
        ratio(F.sum("effective_tax"), whole, 2).alias("avg_effective_tax"),
    )
