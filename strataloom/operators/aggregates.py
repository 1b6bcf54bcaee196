"""Aggregates that need more than one built-in function."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..session import pin
from .timeline import Timeline


#: Rows of a group above which its values are not sorted in one place.
LARGE_GROUP = 200_000
#: Relative error of the sketch that brackets a percentile, and how many of them the bracket is wide on either side.
_SKETCH = 10_000
_MARGIN = 2


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], hot_rows: int | None = None
) -> DataFrame:
    """Exact interpolated percentiles per group (at least one key).

    Groups of at most ``hot_rows`` rows are sorted where they are gathered. Of a
    larger one a sketch gives a bracket around each percentile; values outside
    are only counted, those inside are counted one by one and walked in order.
    Where a rank lies outside its bracket, all values of the group are walked.
    """
    hot_rows = hot_rows or LARGE_GROUP
    present = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    large = pin(sizes.filter(F.col("_size") > hot_rows), "large-groups")
    if large.isEmpty():
        return _sorted_percentiles(present, keys, shares)
    few = _sorted_percentiles(_of_groups(present, large, keys, "left_anti"), keys, shares)
    rows = _of_groups(present, large, keys, "inner")
    found = pin(_bracketed_percentiles(rows, keys, shares, hot_rows), "bracketed")
    kept = found.filter("not _missed").select(*keys, *shares)
    missed = found.filter("_missed").select(*keys)
    if not missed.isEmpty():
        counted = _of_groups(rows, missed, keys, "left_semi").groupBy(*keys, "_size", F.col("_v").alias("_at")).agg(
            F.count(F.lit(1)).alias("_n"), F.lit(True).alias("_inside")
        )
        kept = kept.unionByName(_walked(pin(counted, "counted"), keys, shares, hot_rows).drop("_missed"))
    return few.unionByName(kept)


def _of_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of the groups (or of no group of them), with the groups' other columns; a NULL key is a group like others."""
    renamed = groups.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return rows.join(renamed, same, how).drop(*[f"_of_{k}" for k in keys])


def _between(low: Column, high: Column, weight: Column) -> Column:
    low, high = low.cast("double"), high.cast("double")
    return low + weight * (high - low)


def _sorted_percentiles(rows: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    gathered = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_all"))
    found = []
    for name, share in shares.items():
        place = F.lit(share) * (F.size("_all") - 1)
        low, high = (F.element_at("_all", (f(place) + 1).cast("int")) for f in (F.floor, F.ceil))
        found.append(_between(low, high, place - F.floor(place)).alias(name))
    return gathered.select(*keys, *found)


def _bracketed_percentiles(rows: DataFrame, keys: Sequence[str], shares: dict[str, float], hot_rows: int) -> DataFrame:
    margin = _MARGIN / _SKETCH
    edges = [e for s in shares.values() for e in (max(0.0, s - margin), min(1.0, s + margin))]
    brackets = pin(rows.groupBy(*keys).agg(F.percentile_approx("_v", edges, _SKETCH).alias("_edges")), "brackets")
    placed = _of_groups(rows, brackets, keys, "inner")
    pairs = [(F.col("_edges")[2 * k], F.col("_edges")[2 * k + 1]) for k in range(len(shares))]
    inside = reduce(lambda a, b: a | b, [F.col("_v").between(low, high) for low, high in pairs])
    # between two brackets all values are one row; how many edges lie below says between which
    zone = reduce(lambda a, b: a + b, [F.when(F.col("_v") > e, 1).otherwise(0) for pair in pairs for e in pair])
    counted = (
        placed.groupBy(*keys, "_size", inside.alias("_inside"), zone.alias("_zone"), F.when(inside, F.col("_v")).alias("_one"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_at"))
        .drop("_zone", "_one")
    )
    return _walked(pin(counted, "counted"), keys, shares, hot_rows)


def _walked(counted: DataFrame, keys: Sequence[str], shares: dict[str, float], hot_rows: int) -> DataFrame:
    """Percentiles from values and their counts in order; missed where a rank falls on a row of several values."""
    rows = Timeline(counted, keys, ["_at"], hot_rows=hot_rows).running(_upto=F.col("_n")).rows
    found, sure = [], F.lit(True)
    for name, share in shares.items():
        place = F.lit(share) * (F.col("_size") - 1)
        ends = []
        for rank in (F.floor(place), F.ceil(place)):
            reached = F.when(F.col("_upto") > rank, F.col("_at"))
            ends.append(F.min(reached))
            sure = sure & F.min(F.when(F.col("_inside"), reached)).eqNullSafe(ends[-1])
        found.append(_between(*ends, F.max(place - F.floor(place))).alias(name))
    return rows.groupBy(*keys).agg(*found, (~sure).alias("_missed"))


def flag_first(df: DataFrame, keys: Sequence[str], columns: dict[str, str], unique: Sequence[str]) -> DataFrame:
    """For each column one of 1 and 0: 1 on one row per group and value of the column.

    Their sums are the exact distinct counts. The rows must be unique by
    ``keys`` and ``unique``, as they are after an aggregation by both, so no row
    is repeated for each count, and a group of any size is spread over tasks.
    """
    for name, column in columns.items():
        rest = [c for c in unique if c != column]
        first = F.row_number().over(Window.partitionBy(*keys, column).orderBy(*rest)) == 1
        df = df.withColumn(name, F.when(first & F.col(column).isNotNull(), 1).otherwise(0))
    return df


def top_category(
    df: DataFrame, keys: Sequence[str], category: str, name: str, weight: Column | None = None
) -> DataFrame:
    """Most frequent (or heaviest) category per group; ties go to the smaller name."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = df.filter(F.col(category).isNotNull()).groupBy(*keys, category).agg(size.alias("_n"))
    best = F.min_by(F.col(category), F.struct(-F.col("_n"), F.col(category)))
    return counted.groupBy(*keys).agg(best.alias(name))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key. Combines within each task before anything is moved."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row of each key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def distinct_list(c: Column, separator: str = ",") -> Column:
    """Sorted distinct values as text; for columns with few distinct values."""
    return F.array_join(F.array_sort(F.collect_set(c)), separator)


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2) -> DataFrame:
    """Percent of the column total."""
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn(name, percent(F.col(value), total, digits))
