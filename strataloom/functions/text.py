"""Cleaning of text columns before they are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(c: Column | str) -> Column:
    """Without white space at the ends; empty text reads NULL."""
    trimmed = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.nullif(trimmed, F.lit(""))


def clean_code(c: Column | str) -> Column:
    """A code in small letters, without white space at the ends."""
    return F.lower(clean_text(c))
