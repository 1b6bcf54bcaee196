"""Named queries over a folder of tables, each with SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, FloatType, IntegerType, ShortType, TimestampType,
)

from ..session import prepare
from ..sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_types(self.build(Tables(prepare(spark), sf_dir)))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def _plain_types(df: DataFrame) -> DataFrame:
    """Report types: BIGINT, DOUBLE, STRING, BOOLEAN and zone-free TIMESTAMP."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (DecimalType, FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)
