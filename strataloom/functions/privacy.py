"""Column transforms that hide or coarsen personal values."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col


def redact(c, mask: str = "[REDACTED]") -> Column:
    """Constant text for every present value; NULL stays NULL."""
    return F.when(col(c).isNotNull(), F.lit(mask))


def show_first(c, show: int) -> Column:
    """Keep the first characters and star out the rest."""
    text = col(c).cast("string")
    hidden = F.greatest(F.length(text) - F.lit(show), F.lit(0))
    return F.concat(F.substring(text, 1, show), F.repeat(F.lit("*"), hidden))


def keyed_hash(c, salt: str) -> Column:
    """Salted SHA-256: the same value gives the same token in every table."""
    return F.sha2(F.concat(F.lit(salt), col(c).cast("string")), 256)


def number_band(c, width: int) -> Column:
    """Label of the band the number falls into, such as ``40-49``."""
    low = F.floor(col(c) / F.lit(width)) * F.lit(width)
    return F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string"))


def year_band(c, years: int) -> Column:
    """First year of the band a date falls into."""
    return (F.floor(F.year(col(c)) / F.lit(years)) * years).cast("int")


def drop_tail(c, digits: int) -> Column:
    """Zero out the last characters of a phone-like text."""
    text = col(c).cast("string")
    kept = F.greatest(F.length(text) - F.lit(digits), F.lit(0))
    return F.concat(F.substring(text, F.lit(1), kept), F.lit("0" * digits))


def subnet24(c) -> Column:
    return F.concat(F.substring_index(col(c), ".", 3), F.lit(".0/24"))


def apply_rules(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Replace each named column by its transformed value; absent columns are skipped."""
    present = set(df.columns)
    return df.withColumns({c: fn(F.col(c)) for c, fn in rules.items() if c in present})
