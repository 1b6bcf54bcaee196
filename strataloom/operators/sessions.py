"""Gap sessions and time-bucket deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import bucket_start, seconds_between
from .aggregates import first_row
from .timeline import Timeline


def number_sessions(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    gap_seconds: float,
    tie: Sequence[str],
    end: str | None = None,
    name: str = "session_no",
    hot_rows: int | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Session number per key: a new one starts after a pause longer than the gap.

    The pause counts from the previous event's ``end`` (its start if that is
    NULL). The first event of a key always starts a session.
    """
    until = F.coalesce(F.col(end), F.col(at)) if end else F.col(at)
    line = Timeline(events, keys, [at, *tie], profile=profile, hot_rows=hot_rows)
    line = line.near(before=1, _before=lambda w: F.lag(until).over(w))
    starts = F.col("_before").isNull() | (seconds_between(at, "_before") > F.lit(gap_seconds))
    return line.running(**{name: starts.cast("bigint")}).rows.drop("_before")


def number_day_sessions(
    events: DataFrame, keys: Sequence[str], at: str, gap_days: int, tie: Sequence[str],
    name: str = "session_no", hot_rows: int | None = None,
) -> DataFrame:
    """The same with the pause counted in calendar days."""
    line = Timeline(events, keys, [at, *tie], hot_rows=hot_rows)
    line = line.near(before=1, _before=lambda w: F.lag(at).over(w))
    pause = F.datediff(F.col(at).cast("date"), F.col("_before").cast("date"))
    starts = F.col("_before").isNull() | (pause > gap_days)
    return line.running(**{name: starts.cast("bigint")}).rows.drop("_before")


def first_per_bucket(
    events: DataFrame, keys: Sequence[str], at: str, minutes: int, tie: Sequence[str]
) -> DataFrame:
    """First event per key and tumbling bucket, with the start of the bucket."""
    marked = events.withColumn("bucket", bucket_start(at, minutes))
    order: list[Column] = [F.col(at), *[F.col(c) for c in tie]]
    return first_row(marked, [*keys, "bucket"], order)
