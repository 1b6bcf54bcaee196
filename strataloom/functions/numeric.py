"""Rounding, guarded ratios and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c, digits: int) -> Column:
    """Half-up rounding that does not depend on the order of a float sum.

    The value is first brought to six decimals, so that 12.345 and
    12.344999999999 round alike.
    """
    return F.round(col(c).cast("decimal(24,6)"), digits).cast("double")


def money(c) -> Column:
    """Exact two-decimal amount of any number."""
    return col(c).cast("decimal(18,2)")


def hundredths(c) -> Column:
    """Whole hundredths, as BIGINT, of a DOUBLE column that holds two decimals."""
    return F.floor(col(c) * F.lit(100.0) + F.lit(0.5))


def amount(c) -> Column:
    """``money`` for a DOUBLE column that holds two decimals.

    Goes through a long integer: casting a double to a decimal prints and
    parses it, which costs several times the rest of a scan.
    """
    unit = F.lit("0.01").cast("decimal(2,2)")
    return (hundredths(c).cast("decimal(18,0)") * unit).cast("decimal(18,2)")


def ten_thousandths(whole: Column) -> Column:
    """A product of two ``hundredths`` as an exact four-decimal amount."""
    unit = F.lit("0.0001").cast("decimal(4,4)")
    return (whole.cast("decimal(18,0)") * unit).cast("decimal(18,4)")


def ratio(numerator, denominator, digits: int, scale: float = 1.0, default=None) -> Column:
    """``scale * numerator / denominator``, NULL (or ``default``) where it is zero."""
    num, den = col(numerator).cast("double"), col(denominator).cast("double")
    value = rounded(F.when(den != 0, F.lit(scale) * num / den), digits)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def percent(part, whole, digits: int = 2, default=None) -> Column:
    return ratio(part, whole, digits, 100.0, default)


def flag_sum(condition: Column) -> Column:
    """Number of rows where the condition holds, as BIGINT."""
    return F.count(F.when(condition, F.lit(1)))


def band(value, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose upper edge exceeds the value; the last label has no edge.

    Bands are half open and leave no gaps for fractional values.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    out = None
    for edge, label in zip(edges, labels):
        test = col(value) < F.lit(edge)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(labels[-1]) if out is not None else F.lit(labels[0])


def points(rules: Sequence[tuple[Column, int]], low: int = 0, high: int = 100) -> Column:
    """Sum of the points of all rules that hold, kept within [low, high]."""
    total = F.lit(0)
    for condition, score in rules:
        total = total + F.when(condition, score).otherwise(0)
    return F.least(F.lit(high), F.greatest(F.lit(low), total)).cast("int")


def planar_km(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance at 111 km per degree."""
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    shrink = F.cos(F.radians((lat1 + lat2) / 2))
    return F.lit(111.0) * F.sqrt(F.pow(lat1 - lat2, 2) + F.pow((lon1 - lon2) * shrink, 2))


def haversine_km(lat1, lon1, lat2, lon2, radius: float = 6371.0) -> Column:
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * radius) * F.asin(F.sqrt(h))
