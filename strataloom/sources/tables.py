"""Readers: table folders, external databases, number and date series, inline rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Parquet tables of one folder, read by attribute: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    lower=None,
    upper=None,
    partitions: int = 64,
    **options,
) -> DataFrame:
    """Table of an external database, read in parallel ranges of ``key`` from ``lower`` to ``upper``."""
    if key is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(url, table, predicates=key_ranges(key, lower, upper, partitions), properties=options)


def key_ranges(key: str, lower: int, upper: int, parts: int) -> list[str]:
    """Conditions that split ``lower``..``upper`` evenly; values outside and NULL belong to the outer ranges.

    They serve as ``predicates`` of a database read and as filters of a file read.
    """
    step = max(1, -(-(upper - lower + 1) // parts))
    edges = list(range(lower + step, upper + 1, step))
    if not edges:
        return ["true"]
    inner = [f"`{key}` >= {a} AND `{key}` < {b}" for a, b in zip(edges, edges[1:])]
    return [f"`{key}` < {edges[0]} OR `{key}` IS NULL", *inner, f"`{key}` >= {edges[-1]}"]


def read_ranges(spark: SparkSession, path: str, key: str, parts: int, name: str = "part") -> DataFrame:
    """A table of Parquet files read as a database is: one scan per range of ``key``, numbered from 0.

    The ends come from the files' statistics. Each scan gets its range as a
    pushed filter, so row groups of other ranges are skipped.
    """
    rows = spark.read.parquet(path)
    lower, upper = rows.agg(F.min(key), F.max(key)).first()
    if lower is None:
        return rows.withColumn(name, F.lit(0))
    scans = [rows.filter(c).withColumn(name, F.lit(k)) for k, c in enumerate(key_ranges(key, lower, upper, parts))]
    return reduce(DataFrame.unionByName, scans)


def has_rows(df: DataFrame) -> bool:
    """Pre-flight probe: does the source answer with at least one row?"""
    return not df.isEmpty()


def number_series(spark: SparkSession, start: int, stop: int, name: str = "n") -> DataFrame:
    """``start`` to ``stop``, both included."""
    return spark.range(start, stop + 1).withColumnRenamed("id", name)


def date_series(spark: SparkSession, first: str, last: str, name: str = "full_date") -> DataFrame:
    """Every day from ``first`` to ``last``, both included."""
    begin = F.to_date(F.lit(first))
    days = F.datediff(F.to_date(F.lit(last)), begin)
    return spark.range(1).select(F.explode(F.sequence(F.lit(0), days)).alias("n")).select(
        F.date_add(begin, F.col("n")).alias(name)
    )


def inline_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A small table given in the code."""
    return spark.createDataFrame(list(rows), schema)
