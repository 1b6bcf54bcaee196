"""Schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Columns that old rows read as NULL."""
    new = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(new)


def conform(df: DataFrame, schema: StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the columns of ``schema``: cast, filled with a default or NULL if missing."""
    filled = defaults or {}
    out = []
    for f in schema.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(filled.get(f.name))
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def unify(
    feeds: Sequence[tuple[int, DataFrame, Mapping[str, object]]],
    schema: StructType,
    tag: str = "schema_version",
) -> DataFrame:
    """Feeds of different schema versions as one table with a version tag."""
    out = None
    for version, df, defaults in feeds:
        part = conform(df, schema, defaults).withColumn(tag, F.lit(version))
        out = part if out is None else out.unionByName(part)
    return out
