"""High-watermark loads and recomputation of touched keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upsert import upsert


def watermark(target: DataFrame, *columns: str) -> tuple:
    """Largest stored value per column: one row, read ahead of the load."""
    return tuple(target.agg(*[F.max(c) for c in columns]).first())


def _shifted(value, days: int) -> Column:
    literal = F.lit(value)
    if isinstance(value, datetime):
        return literal - F.make_dt_interval(F.lit(days))
    if isinstance(value, date):
        return F.date_sub(literal, days)
    return literal - F.lit(days)


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows above the stored maximum; everything when the target is empty."""
    (top,) = watermark(target, column)
    return source if top is None else source.filter(F.col(column) > F.lit(top))


def newer_key_and_date(
    source: DataFrame, target: DataFrame, key: str, at: str, overlap_days: int
) -> DataFrame:
    """``key > max(key) AND at > max(at) - overlap``; everything when the target is empty.

    The key test also drops late rows with a small key; use ``with_overlap``
    to catch these.
    """
    top_key, top_at = watermark(target, key, at)
    if top_key is None:
        return source
    return source.filter(
        (F.col(key) > F.lit(top_key)) & (F.col(at) > _shifted(top_at, overlap_days))
    )


def with_overlap(source: DataFrame, target: DataFrame, at: str, overlap_days: int) -> DataFrame:
    """Rows from ``overlap_days`` before the stored maximum on; safe with an upsert."""
    (top,) = watermark(target, at)
    return source if top is None else source.filter(F.col(at) >= _shifted(top, overlap_days))


def load_with_overlap(
    target: DataFrame, source: DataFrame, keys: Sequence[str], at: str, overlap_days: int
) -> DataFrame:
    return upsert(target, with_overlap(source, target, at, overlap_days), keys)


def rows_of_touched(history: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the keys that occur in ``changed``."""
    return history.join(changed.select(*keys).distinct(), list(keys), "left_semi")


def replace_touched(
    table: DataFrame, recomputed: DataFrame, changed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Stored result with the rows of touched keys replaced by recomputed ones."""
    untouched = table.join(changed.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.unionByName(recomputed.select(*table.columns))
