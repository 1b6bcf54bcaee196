"""Compensation events, workforce KPIs and retention risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import amount, flag_sum, money, percent, points, ratio, rounded
from ..functions.temporal import days_between, quarter_label
from ..operators.aggregates import percentiles
from ..operators.timeline import Timeline
from ..session import pin
from ..sources.tables import Tables
from .registry import query
from .sqltext import d, day, m, n, pct, r, ratio as sql_ratio

AS_OF = "2024-02-01"


def compensation_events(events: DataFrame, positions: DataFrame) -> DataFrame:
    """Total pay, change against the previous event and pay against the grade midpoint."""
    line = Timeline(
        events, ["employee_id"], ["event_date", "event_id"],
        profile=events.select("employee_id", "event_date", "event_id"),
    ).near(before=1, prev_salary=lambda w: F.lag("base_salary").over(w))
    joined = line.rows.join(positions.select("position_id", "grade_min", "grade_max"), "position_id")
    change = percent(F.col("base_salary") - F.col("prev_salary"), "prev_salary", default=0)
    midpoint = (F.col("grade_min") + F.col("grade_max")) / 2
    return joined.withColumns(
        {
            "total_comp": F.col("base_salary") + F.col("bonus"),
            "salary_change_pct": F.when(F.col("prev_salary") > 0, change).otherwise(F.lit(0.0)),
            "compa_ratio": ratio("base_salary", midpoint, 3),
        }
    )


def mean(value: Column, digits: int) -> Column:
    return ratio(F.sum(value), F.count(value), digits)


def pay_gap(group: Column, first: str, second: str) -> Column:
    """Percent by which the second group's mean pay is below the first's."""
    pay = F.col("base_salary").cast("decimal(18,2)")

    def average(name: str) -> Column:
        part = F.when(group == name, pay)
        return F.sum(part).cast("double") / F.nullif(F.count(part), F.lit(0))

    return percent(average(first) - average(second), average(first))


def workforce_kpi(facts: DataFrame, as_of: str) -> DataFrame:
    """Department and quarter: headcount, pay, turnover, promotions, tenure and pay gap.

    Summed per employee first, so that heads are counted as rows.
    """
    rows = facts.withColumn("quarter", quarter_label("event_date"))
    pay, kind, gender = F.col("base_salary").cast("decimal(18,2)"), F.col("event_type"), F.col("gender")
    measures = {
        "salary": F.col("base_salary"),
        "tenure": days_between(F.to_date(F.lit(as_of)), "hire_date"),
        "compa": F.col("compa_ratio").cast("decimal(18,3)"),
        "male": F.when(gender == "Male", pay),
        "female": F.when(gender == "Female", pay),
    }
    per_head = rows.groupBy("department", "quarter", "employee_id").agg(
        *[F.sum(v).alias(f"_sum_{k}") for k, v in measures.items()],
        *[F.count(v).alias(f"_n_{k}") for k, v in measures.items()],
        F.bool_or(kind == "termination").alias("_left"),
        F.bool_or(kind == "promotion").alias("_up"),
    )
    heads, who = F.count("employee_id"), F.col("employee_id")
    total = {k: F.sum(f"_sum_{k}") for k in measures}
    count = {k: F.sum(f"_n_{k}") for k in measures}

    def average(k: str) -> Column:
        return total[k].cast("double") / F.nullif(count[k], F.lit(0))

    agg = per_head.groupBy("department", "quarter").agg(
        heads.alias("headcount"),
        ratio(total["salary"], count["salary"], 2).alias("avg_salary"),
        percent(F.count(F.when(F.col("_left"), who)), heads).alias("turnover_rate"),
        percent(F.count(F.when(F.col("_up"), who)), heads).alias("promotion_rate"),
        rounded(total["tenure"] / count["tenure"] / 365.25, 1).alias("avg_tenure_years"),
        percent(average("male") - average("female"), average("male")).alias("pay_gap_pct"),
        ratio(total["compa"], count["compa"], 3).alias("avg_compa_ratio"),
    )
    middle = percentiles(rows, ["department", "quarter"], "base_salary", {"_median": 0.5})
    return agg.join(middle, ["department", "quarter"], "left").withColumn(
        "median_salary", rounded("_median", 2)
    ).drop("_median")


def retention_risk(staff: DataFrame, events: DataFrame, as_of: str, promoted_since: str) -> DataFrame:
    """25 tenure below a year, 20 last raise below 3 %, 25 no promotion since, 30 pay ratio below 0.85."""
    at = F.struct("event_date", "event_id")
    raised = F.col("event_type").isin("salary_adjustment", "promotion")
    promoted = (F.col("event_type") == "promotion") & (F.col("event_date") >= F.lit(promoted_since).cast("timestamp_ntz"))
    latest = events.groupBy("employee_id").agg(
        F.max_by("salary_change_pct", F.when(raised, at)).alias("_raise"),
        F.max_by("compa_ratio", at).alias("_compa"),
        flag_sum(promoted).alias("_promotions"),
    )
    tenure = days_between(F.to_date(F.lit(as_of)), "hire_date") / 365.25
    rows = staff.join(latest, "employee_id", "left").select(
        "employee_id",
        "department",
        tenure.alias("_tenure"),
        F.coalesce("_raise", F.lit(0.0)).alias("salary_change_pct"),
        F.coalesce("_promotions", F.lit(0)).cast("bigint").alias("promotions"),
        F.coalesce("_compa", F.lit(0.0)).alias("compa_ratio"),
    )
    score = points(
        [
            (F.col("_tenure") < 1, 25),
            (F.col("salary_change_pct") < 3, 20),
            (F.col("promotions") == 0, 25),
            (F.col("compa_ratio") < 0.85, 30),
        ]
    )
    level = F.when(F.col("risk_score") >= 50, "high").when(F.col("risk_score") >= 25, "medium").otherwise("low")
    return (
        rows.withColumn("tenure_years", rounded("_tenure", 1))
        .withColumn("risk_score", score)
        .withColumn("risk_category", level)
        .drop("_tenure")
    )


# stand-ins: users as employees, their events as compensation events


def event_compensation(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    events = t.events.select(
        "event_id",
        F.col("user_id").alias("employee_id"),
        F.col("ts").alias("event_date"),
        F.when(kind == "signup", "hire").when(kind == "purchase", "promotion").when(kind == "click", "salary_adjustment")
        .when(kind == "error", "termination").otherwise("bonus").alias("event_type"),
        kind.alias("position_id"),
        (F.lit(30000) + amount("value") * 100).cast("decimal(18,2)").alias("base_salary"),
        (amount("value") * 5).cast("decimal(18,2)").alias("bonus"),
    )
    grades = events.groupBy("position_id").agg(F.min("base_salary").alias("grade_min"), F.max("base_salary").alias("grade_max"))
    return compensation_events(events, pin(grades, "grades"))


def staff_of(t: Tables) -> DataFrame:
    hired = t.events.groupBy(F.col("user_id").alias("employee_id")).agg(F.min("ts").alias("hire_date"))
    people = t.customer.select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_mktsegment").alias("department"),
        F.when(F.col("c_acctbal") >= 4500, "Male").otherwise("Female").alias("gender"),
    )
    # staff with a balance above 3000 were hired 500 days before their first event
    early = t.customer.select(F.col("c_custkey").alias("employee_id"), (F.col("c_acctbal") > 3000).alias("_early"))
    joined = hired.join(people, "employee_id").join(early, "employee_id")
    back = F.when(F.col("_early"), 500).otherwise(0)
    return joined.withColumn("hire_date", F.col("hire_date") - F.make_dt_interval(back)).drop("_early")


COMP_SQL = f"""
raw AS (SELECT event_id, user_id AS employee_id, ts AS event_date, event_type AS position_id,
  CASE event_type WHEN 'signup' THEN 'hire' WHEN 'purchase' THEN 'promotion' WHEN 'click' THEN 'salary_adjustment' WHEN 'error' THEN 'termination' ELSE 'bonus' END AS event_type,
  CAST(30000 + {m('value')} * 100 AS DECIMAL(18,2)) AS base_salary, CAST({m('value')} * 5 AS DECIMAL(18,2)) AS bonus FROM events),
grades AS (SELECT position_id, MIN(base_salary) AS lo, MAX(base_salary) AS hi FROM raw GROUP BY 1),
prevs AS (SELECT *, LAG(base_salary) OVER (PARTITION BY employee_id ORDER BY event_date, event_id) AS prev_salary FROM raw),
comp AS (SELECT p.*, base_salary + bonus AS total_comp,
  CASE WHEN prev_salary > 0 THEN COALESCE({pct('(base_salary - prev_salary)', 'prev_salary')}, 0) ELSE 0.0 END AS salary_change_pct,
  {sql_ratio('base_salary', '((CAST(lo AS DOUBLE) + CAST(hi AS DOUBLE)) / 2)', 3)} AS compa_ratio FROM prevs p JOIN grades USING (position_id)),
staff AS (SELECT user_id AS employee_id, c_mktsegment AS department, CASE WHEN c_acctbal >= 4500 THEN 'Male' ELSE 'Female' END AS gender,
  MIN(ts) - (CASE WHEN c_acctbal > 3000 THEN 500 ELSE 0 END) * INTERVAL 1 DAY AS hire_date
  FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3, c_acctbal),
fact AS (SELECT comp.*, department, gender, hire_date FROM comp JOIN staff USING (employee_id))"""


def compensation_facts(t: Tables) -> DataFrame:
    return event_compensation(t).join(staff_of(t), "employee_id")


@query(
    "compensation_change",
    f"""WITH {COMP_SQL} SELECT event_id, employee_id, event_type, {d('total_comp')} AS total_comp, salary_change_pct, compa_ratio FROM comp""",
)
def _(t: Tables) -> DataFrame:
    return event_compensation(t).select(
        "event_id", "employee_id", "event_type", "total_comp", "salary_change_pct", "compa_ratio"
    )


_GAP = "(SUM(CASE WHEN gender = '{g}' THEN base_salary END)::DOUBLE / NULLIF(COUNT(CASE WHEN gender = '{g}' THEN 1 END), 0))"
_MALE, _FEMALE = _GAP.format(g="Male"), _GAP.format(g="Female")


@query(
    "workforce_kpi",
    f"""WITH {COMP_SQL}
SELECT department, CAST(year(event_date) AS VARCHAR) || '-Q' || CAST(quarter(event_date) AS VARCHAR) AS quarter, COUNT(DISTINCT employee_id) AS headcount,
  {sql_ratio('SUM(base_salary)', 'COUNT(*)', 2)} AS avg_salary, {r('quantile_cont(CAST(base_salary AS DOUBLE), 0.5)', 2)} AS median_salary,
  {pct("COUNT(DISTINCT CASE WHEN event_type = 'termination' THEN employee_id END)", 'COUNT(DISTINCT employee_id)')} AS turnover_rate,
  {pct("COUNT(DISTINCT CASE WHEN event_type = 'promotion' THEN employee_id END)", 'COUNT(DISTINCT employee_id)')} AS promotion_rate,
  {r(f"CAST(SUM(date_diff('day', hire_date, TIMESTAMP '{AS_OF}')) AS DOUBLE) / COUNT(*) / 365.25", 1)} AS avg_tenure_years,
  {pct(f'({_MALE} - {_FEMALE})', _MALE)} AS pay_gap_pct, {sql_ratio('SUM(CAST(compa_ratio AS DECIMAL(18,3)))', 'COUNT(compa_ratio)', 3)} AS avg_compa_ratio
FROM fact GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return workforce_kpi(pin(compensation_facts(t), "facts"), AS_OF)


@query(
    "retention_risk",
    f"""WITH {COMP_SQL},
l AS (SELECT employee_id, arg_max(salary_change_pct, ROW(event_date, event_id)) FILTER (event_type IN ('salary_adjustment', 'promotion')) AS rs,
  arg_max(compa_ratio, ROW(event_date, event_id)) AS cr, COUNT(CASE WHEN event_type = 'promotion' AND event_date >= TIMESTAMP '2024-01-25' THEN 1 END) AS pr
  FROM comp GROUP BY 1),
x AS (SELECT s.employee_id, department, date_diff('day', hire_date, TIMESTAMP '{AS_OF}') / 365.25 AS ten, COALESCE(rs, 0) AS rs, COALESCE(pr, 0) AS pr, COALESCE(cr, 0) AS cr
  FROM staff s LEFT JOIN l USING (employee_id)),
y AS (SELECT *, CASE WHEN ten < 1 THEN 25 ELSE 0 END + CASE WHEN rs < 3 THEN 20 ELSE 0 END + CASE WHEN pr = 0 THEN 25 ELSE 0 END
  + CASE WHEN cr < 0.85 THEN 30 ELSE 0 END AS score FROM x)
SELECT employee_id, department, {r('ten', 1)} AS tenure_years, rs AS salary_change_pct, pr AS promotions, cr AS compa_ratio, {n('score')} AS risk_score,
  CASE WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'medium' ELSE 'low' END AS risk_category FROM y""",
)
def _(t: Tables) -> DataFrame:
    return retention_risk(staff_of(t), event_compensation(t), AS_OF, "2024-01-25")


@query(
    "budget_vs_actual",
    f"""WITH {COMP_SQL}, b AS (SELECT c_mktsegment AS department, COUNT(*) AS head_budget, SUM({m('c_acctbal')}) AS budget FROM customer GROUP BY 1)
SELECT department, head_budget, {d('budget')} AS budget, COUNT(DISTINCT employee_id) AS headcount, head_budget - COUNT(DISTINCT employee_id) AS open_positions,
  {d('SUM(base_salary)')} AS salary_spend FROM fact JOIN b USING (department) GROUP BY 1, 2, b.budget""",
)
def _(t: Tables) -> DataFrame:
    budgets = t.customer.groupBy(F.col("c_mktsegment").alias("department")).agg(
        F.count(F.lit(1)).alias("head_budget"), F.sum(amount("c_acctbal")).alias("budget")
    )
    actual = compensation_facts(t).groupBy("department").agg(
        F.count_distinct("employee_id").alias("headcount"), F.sum("base_salary").alias("salary_spend")
    )
    return budgets.join(actual, "department").withColumn("open_positions", F.col("head_budget") - F.col("headcount"))


@query(
    "value_trajectory",
    f"""SELECT o_orderkey, o_custkey, {day('o_orderdate')} AS order_day, o_totalprice, LAG(o_totalprice) OVER w AS previous,
  {pct(f"({m('o_totalprice')} - LAG({m('o_totalprice')}) OVER w)", f"(LAG({m('o_totalprice')}) OVER w)")} AS change_pct
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    line = Timeline(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).near(
        before=1, previous=lambda w: F.lag("o_totalprice").over(w)
    )
    return line.rows.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day"), "o_totalprice", "previous",
        percent(amount("o_totalprice") - money("previous"), money("previous")).alias("change_pct"),
    )


@query(
    "underpaid_list",
    f"""WITH {COMP_SQL} SELECT event_id, employee_id, department, event_type, compa_ratio FROM fact
WHERE compa_ratio < 0.8 AND event_type NOT IN ('termination', 'bonus')""",
)
def _(t: Tables) -> DataFrame:
    low = (F.col("compa_ratio") < 0.8) & ~F.col("event_type").isin("termination", "bonus")
    return compensation_facts(t).filter(low).select("event_id", "employee_id", "department", "event_type", "compa_ratio")


@query(
    "pay_gap_by_department",
    f"""WITH {COMP_SQL}
SELECT department, {r(_MALE, 2)} AS avg_male, {r(_FEMALE, 2)} AS avg_female, {pct(f'({_MALE} - {_FEMALE})', _MALE)} AS pay_gap_pct
FROM fact WHERE event_type <> 'termination' GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    pay = F.col("base_salary")
    return (
        compensation_facts(t)
        .filter("event_type <> 'termination'")
        .groupBy("department")
        .agg(
            mean(F.when(F.col("gender") == "Male", pay), 2).alias("avg_male"),
            mean(F.when(F.col("gender") == "Female", pay), 2).alias("avg_female"),
            pay_gap(F.col("gender"), "Male", "Female").alias("pay_gap_pct"),
        )
    )


@query(
    "turnover_by_year",
    f"""SELECT c_mktsegment AS department, {n('year(o_orderdate)')} AS event_year,
  COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS terminations, COUNT(DISTINCT o_custkey) AS employees,
  {pct("COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END)", 'COUNT(DISTINCT o_custkey)')} AS turnover_rate_pct
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    left = F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))
    return joined.groupBy(F.col("c_mktsegment").alias("department"), F.year("o_orderdate").alias("event_year")).agg(
        left.alias("terminations"),
        F.count_distinct("o_custkey").alias("employees"),
        percent(left, F.count_distinct("o_custkey")).alias("turnover_rate_pct"),
    )
