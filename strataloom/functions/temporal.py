"""Dates and times. Input timestamps carry no zone (or the session is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def micros(ts) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(later, earlier) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1000000.0)


def days_between(later, earlier) -> Column:
    """Calendar days, as INT."""
    return F.datediff(col(later).cast("date"), col(earlier).cast("date"))


def truncated(unit: str, ts) -> Column:
    return F.date_trunc(unit, col(ts)).cast("timestamp_ntz")


def month_start(ts) -> Column:
    return F.trunc(col(ts).cast("date"), "month")


def quarter_label(ts) -> Column:
    """2024-Q1"""
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))


def date_key(ts) -> Column:
    return F.date_format(col(ts), "yyyyMMdd").cast("int")


def weekday_from_sunday(ts) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(col(ts)) - 1


def shift_of_day(ts) -> Column:
    hour = F.hour(col(ts))
    return (
        F.when((hour >= 6) & (hour < 14), "SHIFT-AM")
        .when((hour >= 14) & (hour < 22), "SHIFT-PM")
        .otherwise("SHIFT-NIGHT")
    )


def bucket_start(ts, minutes: int) -> Column:
    """Start of the tumbling bucket the time falls into."""
    width = minutes * 60
    start = F.floor(micros(ts) / F.lit(width * 1000000)) * F.lit(width)
    return F.timestamp_seconds(start).cast("timestamp_ntz")
