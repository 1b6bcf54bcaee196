"""Whole-table numbering and ranks without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin

_PART = "_part"


def _ordering(order: Sequence) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in order]


_PLACE = "_range_place"


def _ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in globally sorted ranges, each with its range and its place there (from 0).

    Rows are sorted within their range and numbered as they are written; the
    number holds the range in its upper and the place in its lower 33 bits. So
    one exchange is all the rows go through. The number of ranges is the shuffle
    width; adaptive execution joins neighbouring ones where the table is small.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = pin(placed.withColumn(_PLACE, F.monotonically_increasing_id()), "ranges")
    return rows.withColumn(_PART, F.shiftrightunsigned(_PLACE, 33)).withColumn(
        _PLACE, F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    )


def _offsets(sums: DataFrame, name: str) -> DataFrame:
    """Per range: the sum of all ranges before it, and of all ranges. One row per range."""
    ahead = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        _PART,
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy()).alias(f"{name}_total"),
    )


def _running(df: DataFrame, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Whole-table running sum of ``amount``, plus its grand total as ``<name>_total``.

    Used on one row per distinct value.
    """
    rows = _ranges(df, order)
    offsets = _offsets(rows.groupBy(_PART).agg(F.sum(amount).alias("_sum")), name)
    local = F.sum(amount).over(
        Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("_local", local)
        .join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop(_PART, _PLACE, "_local", "_offset")
    )


def number_rows(
    df: DataFrame, order: Sequence, name: str = "row_num", total: str | None = None, start: int = 0
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)``; ``order`` must be unique."""
    rows = _ranges(df, _ordering(order))
    offsets = _offsets(rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("_sum")), "_all")
    out = rows.join(F.broadcast(offsets), _PART).withColumn(name, F.col("_offset") + F.col(_PLACE) + F.lit(start + 1))
    if total is not None:
        out = out.withColumn(total, F.col("_all_total"))
    return out.drop(_PART, _PLACE, "_offset", "_all_total")


def surrogate_keys(df: DataFrame, natural: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Integer keys 1.. (after ``start``) in the order of the natural key."""
    return number_rows(df, natural, name, start=start)


def bucket_of(row_num: Column, total: Column, buckets: int) -> Column:
    """NTILE bucket of a row number: the first ``total % buckets`` buckets get one more row."""
    small = F.floor(total / F.lit(buckets))
    extra = total % F.lit(buckets)
    edge = extra * (small + 1)
    in_large = F.floor((row_num - 1) / (small + 1)) + 1
    in_small = extra + F.floor((row_num - 1 - edge) / F.greatest(small, F.lit(1))) + 1
    return F.when(row_num <= edge, in_large).otherwise(in_small).cast("int")


def ntile(df: DataFrame, order: Sequence, buckets: int, name: str) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` with a unique order."""
    numbered = number_rows(df, order, "_row", total="_all")
    return numbered.withColumn(name, bucket_of(F.col("_row"), F.col("_all"), buckets)).drop(
        "_row", "_all"
    )


def rank_values(
    df: DataFrame,
    value: str,
    descending: bool = False,
    rank: str | None = None,
    dense_rank: str | None = None,
    percent_rank: str | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK and PERCENT_RANK of a column over the whole table.

    Works on one row per distinct value, so ties cost nothing, and joins the
    result back.
    """
    groups = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(value).desc() if descending else F.col(value).asc()]
    summed = _running(groups, order, F.col("_n"), "_upto")
    summed = summed.withColumn("_rank", F.col("_upto") - F.col("_n") + 1)
    if dense_rank is not None:
        summed = number_rows(summed, order, dense_rank)
    outputs = []
    if rank is not None:
        outputs.append(F.col("_rank").alias(rank))
    if dense_rank is not None:
        outputs.append(F.col(dense_rank))
    if percent_rank is not None:
        rest = F.col("_upto_total") - 1
        share = F.when(rest > 0, (F.col("_rank") - 1) / rest).otherwise(F.lit(0.0))
        outputs.append(share.alias(percent_rank))
    looked_up = summed.select(F.col(value).alias("_value"), *outputs)
    return df.join(looked_up, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")
