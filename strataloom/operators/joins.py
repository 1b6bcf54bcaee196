"""Joins Spark has no direct form for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from ..session import pin
from .timeline import Cuts, Timeline, find_cuts


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str | None,
    take: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    cuts: Cuts | None = None,
    direction: str = "backward",
    strict: bool = False,
) -> DataFrame:
    """Each fact with the version of its key valid at ``at``: [valid_from, valid_to).

    Facts and versions of a key are put on one line and every fact takes the
    last version before it, or with ``direction="forward"`` the first one after
    it. A version at the very time of a fact counts unless ``strict``. No pair
    of fact and version is formed, so a key with many facts and many versions
    stays linear, and facts at one time may go to several tasks. Versions of a
    key must not overlap. ``cuts`` may come from a cheaper table, as for
    ``Timeline``, of which the first order column counts; forward joins find
    their own.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    ahead = direction == "forward"
    if ahead and (valid_to or cuts):
        raise ValueError("a forward join takes no valid_to and no cuts")

    def axis(c):
        moment = F.col(c).cast("timestamp")
        # time runs backwards: the next version is the last one before
        return -F.unix_micros(moment) if ahead else moment

    held = [valid_from, *([valid_to] if valid_to else [])]
    carried = [*held, *[c for c in take if c not in held]]
    # at equal times the smaller kind is seen first
    fact_kind, version_kind = (0, 1) if strict else (1, 0)
    # facts at one time need no order among them, as they have no version to give; a hash deals them out
    plain = [f.name for f in facts.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    left = facts.select(
        *keys, axis(at).alias("_at"), F.lit(fact_kind).alias("_kind"), F.xxhash64(*plain).alias("_tie"),
        F.struct(*facts.columns).alias("_fact"),
    )
    right = versions.select(
        *keys, axis(valid_from).alias("_at"), F.lit(version_kind).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"),
        F.struct(*carried).alias("_version"),
    )
    line = left.unionByName(right, allowMissingColumns=True)
    if cuts is None:
        order = ["_at", "_kind", "_tie"]
        both = left.select(*keys, *order).unionByName(right.select(*keys, *order))
        cuts = find_cuts(both, keys, order, hot_rows)
    else:
        cuts = cuts.prefix(1)
    filled = (
        Timeline(line, keys, ["_at", "_kind", "_tie"], cuts=cuts)
        .latest(_version=F.col("_version"))
        .rows.filter(F.col("_kind") == fact_kind)
    )
    if ahead:
        # without a time of its own a fact comes first and has nothing before it
        filled = filled.withColumn("_version", F.when(F.col("_at").isNotNull(), F.col("_version")))
    if valid_to:
        end = F.col(f"_version.{valid_to}").cast("timestamp")
        valid = end.isNull() | (F.col("_at") < end)
        filled = filled.withColumn("_version", F.when(valid, F.col("_version")))
    if how == "inner":
        filled = filled.filter(F.col("_version").isNotNull())
    taken = [F.col(f"_version.{c}").alias(c) for c in take]
    return filled.select("_fact.*", *taken)


def by_participant(rows: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Each row once per distinct key it names in either column."""
    named = F.array_distinct(F.array_compact(F.array(first, second)))
    return rows.withColumn(key, F.explode(named))


def either_key(left: DataFrame, right: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """``left JOIN right ON key = first OR key = second`` as one equi join.

    A right row that names the key in both columns is returned once. Where only
    aggregates are wanted, group ``by_participant`` rows by the key first.
    """
    return left.join(by_participant(right, key, first, second), key)


def left_if_named(rows: DataFrame, other: DataFrame, key: str, other_key: str, unique: Sequence[str]) -> DataFrame:
    """``rows LEFT JOIN other ON key = other_key`` where ``key`` is often NULL.

    Rows without a key meet nothing. They are dealt out by their ``unique``
    columns, as one task would get all of them otherwise.
    """
    apart = F.concat(F.lit("none "), F.xxhash64(*unique).cast("string"))
    named = rows.withColumn("_named", F.coalesce(F.concat(F.lit("key "), F.col(key).cast("string")), apart))
    met = other.withColumn("_named", F.concat(F.lit("key "), F.col(other_key).cast("string")))
    return named.join(met, "_named", "left").drop("_named")


def through_history(facts: DataFrame, history: DataFrame, key: str, target: str) -> DataFrame:
    """Facts with the ``target`` that their key has had in the history.

    A key with several targets gives a row for each, one without any gives NULL.
    The history is reduced to its distinct pairs before anything is joined.
    """
    pairs = history.filter(F.col(target).isNotNull()).select(key, target).distinct()
    return facts.join(pairs, key, "left")


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats) -> DataFrame:
    """Rows with aggregates of their group, joined back.

    The aggregates are written first: Spark then knows their size and leaves
    the rows where they are if it is small.
    """
    grouped = df.groupBy(*keys).agg(*[c.alias(name) for name, c in stats.items()])
    return df.join(pin(grouped, "stats"), list(keys))
