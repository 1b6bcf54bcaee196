"""Data-quality expectations. Every check is a one-row DataFrame of one report."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TESTS = {
    "=": operator.eq, "!=": operator.ne, ">": operator.gt,
    ">=": operator.ge, "<": operator.lt, "<=": operator.le,
}


def _report(df: DataFrame, name: str, observed: Column, passed: Column, severity: str, message: str) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        observed.cast("string").alias("observed"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
        F.lit(message).alias("message"),
    )


def expect_rows(df: DataFrame, name: str, op: str, count: int, severity="warn", message="") -> DataFrame:
    """Row count of the result."""
    counted = df.agg(F.count(F.lit(1)).alias("_v"))
    return _report(counted, name, F.col("_v"), _TESTS[op](F.col("_v"), F.lit(count)), severity, message)


def expect_value(
    df: DataFrame, name: str, value: Column, op: str, bound=None, where: Column | None = None,
    severity="warn", message="",
) -> DataFrame:
    """An aggregate over the (filtered) rows. ``op`` may be 'is not null'."""
    rows = df if where is None else df.filter(where)
    got = rows.agg(value.alias("_v"))
    passed = F.col("_v").isNotNull() if op == "is not null" else _TESTS[op](F.col("_v"), F.lit(bound))
    return _report(got, name, F.col("_v"), passed, severity, message)


def expect_top(
    df: DataFrame, name: str, category: str, expected, weight: Column | None = None, severity="warn", message=""
) -> DataFrame:
    """The most frequent (or heaviest) value of a column; of equals the smaller one."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = df.groupBy(category).agg(size.alias("_n"))
    top = counted.agg(F.min_by(F.col(category), F.struct(-F.col("_n"), F.col(category))).alias("_v"))
    return _report(top, name, F.col("_v"), F.col("_v") == F.lit(expected), severity, message)


def expect_source(df: DataFrame, name: str, severity="error", message="") -> DataFrame:
    """Pre-flight probe as a check: does the source answer with a row? Reads one row at most."""
    probed = df.select(F.lit(1).alias("_one")).limit(1).agg(F.count("_one").alias("_v"))
    return _report(probed, name, F.col("_v"), F.col("_v") > 0, severity, message)


def expect_none(df: DataFrame, violations: Mapping[str, Column], severity="error", message="") -> DataFrame:
    """Counts of rows breaking each rule, all in one pass over the table."""
    counted = df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in violations.items()])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("n"), F.col(n).alias("v")) for n in violations])
    )
    rows = counted.select(pairs.alias("_p")).select("_p.n", "_p.v")
    return rows.select(
        F.col("n").alias("check_name"),
        F.col("v").cast("string").alias("observed"),
        (F.col("v") == 0).alias("passed"),
        F.lit(severity).alias("severity"),
        F.lit(message).alias("message"),
    )


def report(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent does not hold; NULL keys are not orphans."""
    return child.filter(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias("_p")), F.col(key) == F.col("_p"), "left_anti"
    )


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])
    )
    marked = df.withColumn("broken_rules", F.array_join(broken, ","))
    good = marked.filter(F.col("broken_rules") == "").drop("broken_rules")
    return good, marked.filter(F.col("broken_rules") != "")


def reconcile(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Counts of two states and their difference."""
    parts = before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    sums = parts.agg(F.sum("_b").alias("rows_before"), F.sum("_a").alias("rows_after"))
    return sums.select(
        F.lit(label).alias("table_name"),
        F.coalesce("rows_before", F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).cast("bigint").alias("rows_after"),
    ).withColumn("difference", F.col("rows_after") - F.col("rows_before"))


def k_anonymity(df: DataFrame, quasi: Sequence[str], k: int) -> DataFrame:
    """Combinations of coarsened values that fewer than ``k`` rows share."""
    return df.groupBy(*quasi).agg(F.count(F.lit(1)).alias("group_size")).filter(F.col("group_size") < k)


def retain_recent(
    df: DataFrame, keys: Sequence[str], at: str, hours: int, as_of, keep_latest: bool = True
) -> DataFrame:
    """Drop history older than ``hours``; the latest row of each key is kept."""
    cut = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))
    recent = df.filter(F.col(at) >= cut)
    if not keep_latest:
        return recent
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(at, *[c for c in rest if c != at])
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    stale = last.select(*keys, "_row.*").filter(F.col(at) < cut)
    return recent.unionByName(stale.select(*df.columns))
