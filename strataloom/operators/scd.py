"""Slowly changing dimensions: half-open versions [valid_from, valid_to), NULL = open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from .aggregates import first_row
from .ranking import number_rows
from .timeline import Cuts, Timeline


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """NULL-safe: does any column differ between two aliased sides?"""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def changes_only(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    cuts: Cuts | None = None,
) -> DataFrame:
    """Rows where a tracked column differs from the row before; the first row stays."""
    previous = {
        f"_was_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in tracked
    }
    walked = Timeline(df, keys, order, cuts=cuts and cuts.prefix(1)).near(
        before=1, _first=lambda w: F.lag(F.lit(1)).over(w).isNull(), **previous
    )
    moved = F.col("_first")
    for c in tracked:
        moved = moved | ~F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    return walked.rows.filter(moved).drop("_first", *previous)


def build_history(
    versions: DataFrame,
    keys: Sequence[str],
    valid_from: str,
    tie: Sequence[str] = (),
    cuts: Cuts | None = None,
) -> DataFrame:
    """Whole history in one pass: each version ends where the next begins."""

    def following(w: WindowSpec) -> Column:
        return F.lead(valid_from).over(w)

    return (
        Timeline(versions, keys, [valid_from, *tie], cuts=cuts and cuts.prefix(1))
        .near(after=1, valid_to=following)
        .rows.withColumn("is_current", F.col("valid_to").isNull())
    )


def initial_load(
    versions: DataFrame, keys: Sequence[str], valid_from: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The earliest version of each key becomes its current row."""
    first = first_row(versions, keys, [F.col(valid_from), *[F.col(c) for c in tie]])
    return (
        first.withColumn("valid_from", F.col(valid_from))
        .withColumn("valid_to", F.lit(None).cast(versions.schema[valid_from].dataType))
        .withColumn("is_current", F.lit(True))
    )


def apply_batch(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    surrogate: str | None = None,
) -> DataFrame:
    """Expire current rows a batch changes and insert their new versions.

    ``batch`` has one row per key. Keys that are new to the dimension are
    inserted; unchanged keys are left alone. With ``surrogate`` the new rows
    get keys above the largest stored one.
    """
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"d.{k}") == F.col(f"b.{k}"))
    current = dim.filter("is_current")
    touched = (
        current.alias("d")
        .join(batch.alias("b"), on)
        .filter(differs("d", "b", tracked))
        .select(*[F.col(f"b.{k}").alias(k) for k in keys], F.col(f"b.{effective}").alias("_until"))
    )
    ended = dim.join(touched, list(keys), "left")
    ends = F.col("is_current") & F.col("_until").isNotNull()
    expired = (
        ended.withColumn("valid_to", F.when(ends, F.col("_until")).otherwise(F.col("valid_to")))
        .withColumn("is_current", F.col("is_current") & ~ends)
        .drop("_until")
        .select(*dim.columns)
    )
    changed = batch.join(touched.select(*keys), list(keys), "left_semi")
    brand_new = batch.join(dim.select(*keys), list(keys), "left_anti")
    fresh = (
        changed.unionByName(brand_new)
        .withColumn("valid_from", F.col(effective))
        .withColumn("valid_to", F.lit(None).cast(dim.schema["valid_to"].dataType))
        .withColumn("is_current", F.lit(True))
    )
    if surrogate:
        top = dim.agg(F.max(surrogate)).first()[0] or 0
        fresh = number_rows(fresh, list(keys), surrogate, start=top)
    return expired.unionByName(fresh.select(*dim.columns))


def hire_and_change(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    first_kind: Column,
    change_kind: Column,
    take: Sequence[str],
    tie: Sequence[str],
) -> DataFrame:
    """Two rows per key at most: the first event and the latest qualifying change."""
    order = [F.col(at), *[F.col(c) for c in tie]]
    start = first_row(events.filter(first_kind), keys, order)
    change = (
        events.filter(change_kind)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(at, *take), F.struct(at, *tie)).alias("_c"))
    )
    initial = start.join(change, list(keys), "left").select(
        *keys,
        *take,
        F.col(at).alias("valid_from"),
        F.col(f"_c.{at}").alias("valid_to"),
        F.col("_c").isNull().alias("is_current"),
    )
    moved = change.join(start.select(*keys), list(keys), "left_semi").select(
        *keys,
        *[F.col(f"_c.{c}").alias(c) for c in take],
        F.col(f"_c.{at}").alias("valid_from"),
        F.lit(None).cast(events.schema[at].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return initial.unionByName(moved)


def invariant_breaks(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more or fewer than one current version, or an empty interval."""
    empty = F.col("valid_to") < F.col("valid_from")
    return (
        dim.groupBy(*keys)
        .agg(
            F.count(F.when(F.col("is_current"), 1)).alias("current_rows"),
            F.count(F.when(empty, 1)).alias("empty_intervals"),
        )
        .filter((F.col("current_rows") != 1) | (F.col("empty_intervals") > 0))
    )


def amended(
    originals: DataFrame,
    amendments: DataFrame,
    key: str,
    at: str,
    tie: Sequence[str],
    take: Sequence[str],
) -> DataFrame:
    """Append-only ledger: originals with the latest amendment and the number of amendments.

    Amended values come as ``amended_<column>`` and stay NULL without one.
    """
    latest = amendments.groupBy(key).agg(
        F.max_by(F.struct(*take), F.struct(at, *tie)).alias("_a"),
        F.count(F.lit(1)).alias("amendment_count"),
    )
    joined = originals.join(latest, key, "left")
    return joined.select(
        *originals.columns,
        *[F.col(f"_a.{c}").alias(f"amended_{c}") for c in take],
        F.coalesce("amendment_count", F.lit(0)).cast("bigint").alias("amendment_count"),
        F.col("_a").isNotNull().alias("was_amended"),
    )
