"""Row-level changes as DataFrame operators: tables in, new table state out.

``merge`` joins target and source on the key and applies ordered clauses, the
first true one winning. Conditions and assignments name columns as ``t.col``
and ``s.col``. NULL keys never match. A key that occurs twice in the source is
an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_width
from .aggregates import first_row


@dataclass(frozen=True)
class Clause:
    """One WHEN clause. ``when`` is matched, absent (from the target) or orphan (not in the source)."""

    when: str
    condition: Column | None = None
    assign: Mapping[str, Column] = field(default_factory=dict)
    delete: bool = False


def matched(assign: Mapping[str, Column] | None = None, condition=None, delete=False) -> Clause:
    return Clause("matched", condition, assign or {}, delete)


def absent(assign: Mapping[str, Column] | None = None, condition=None) -> Clause:
    """Insert. Without assignments every column is taken from the source by name."""
    return Clause("absent", condition, assign or {})


def orphan(assign: Mapping[str, Column] | None = None, condition=None, delete=False) -> Clause:
    return Clause("orphan", condition, assign or {}, delete)


def take(*columns: str) -> dict[str, Column]:
    """Assignments that copy the named columns from the source."""
    return {c: F.col(f"s.{c}") for c in columns}


def merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[Clause]
) -> DataFrame:
    width = shuffle_width(target.sparkSession)

    def spread(df: DataFrame) -> Column:
        """0 for rows with a key; rows without one match nothing and are spread over the tasks."""
        lost = F.lit(False)
        for k in keys:
            lost = lost | df[k].isNull()
        return F.when(lost, F.pmod(F.xxhash64(*df.columns), F.lit(width)) + 1).otherwise(F.lit(0))

    def side_of(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        marks = [F.col(k).alias(f"_{name}{i}") for i, k in enumerate([*keys, "_lost"])]
        return df.select(*marks, F.struct(*columns).alias(name))

    # a repeated key is an error, not a choice; the window shares its shuffle and its order with the
    # join, and numbers rows as they pass, so a key of many rows is not held in memory to say so
    marked = source.withColumn("_lost", spread(source))
    same_key = Window.partitionBy(*keys, "_lost").orderBy(*keys)
    copies = F.when(F.col("_lost") == 0, F.row_number().over(same_key)).otherwise(1)
    t = side_of(target.withColumn("_lost", spread(target)), target.columns, "t")
    s = side_of(marked.withColumn("_copies", copies), [*source.columns, "_copies"], "s")
    on = F.lit(True)
    for i in range(len(keys) + 1):
        on = on & (F.col(f"_t{i}") == F.col(f"_s{i}"))
    joined = t.join(s, on, "full_outer").select("t", "s")
    in_target, in_source = F.col("t").isNotNull(), F.col("s").isNotNull()
    clash = F.col("s._copies") > 1
    side = {
        "matched": in_target & in_source,
        "absent": in_source & ~in_target,
        "orphan": in_target & ~in_source,
    }
    chosen = F.when(clash, F.raise_error(F.lit("the merge source holds a key twice")).cast("int"))
    for number, clause in enumerate(clauses):
        test = side[clause.when]
        if clause.condition is not None:
            test = test & F.coalesce(clause.condition, F.lit(False))
        chosen = chosen.when(test, number)
    # no clause: target rows stay, source rows are not inserted
    chosen = chosen.when(in_target, -1).otherwise(-2)
    acted = joined.withColumn("_do", chosen)

    dropped = [-2, *[n for n, c in enumerate(clauses) if c.delete]]
    kept = acted.filter(~F.col("_do").isin(dropped))
    outputs = []
    for c in target.columns:
        value = F.when(F.col("_do") == -1, F.col(f"t.{c}"))
        for number, clause in enumerate(clauses):
            if clause.delete:
                continue
            if clause.when == "absent" and not clause.assign:
                new = F.col(f"s.{c}") if c in source.columns else F.lit(None)
            elif c in clause.assign:
                new = clause.assign[c]
            else:
                new = F.lit(None) if clause.when == "absent" else F.col(f"t.{c}")
            value = value.when(F.col("_do") == number, new)
        outputs.append(value.cast(target.schema[c].dataType).alias(c))
    return kept.select(*outputs)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], columns=None) -> DataFrame:
    """Update the named columns (all of the source by default), insert what is new."""
    shared = [c for c in source.columns if c in target.columns]
    changed = [c for c in (columns or shared) if c not in keys]
    return merge(target, source, keys, [matched(take(*changed)), absent()])


def insert_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], first_by: Sequence[Column] = ()
) -> DataFrame:
    """Add source rows whose key is new; of several with one key, the first by ``first_by``."""
    order = list(first_by) or [F.struct(*source.columns)]
    fresh = first_row(source, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def newer_wins(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Update only where the source row is newer."""
    changed = [c for c in source.columns if c in target.columns and c not in keys]
    newer = F.col(f"s.{version}") > F.col(f"t.{version}")
    return merge(target, source, keys, [matched(take(*changed), newer), absent()])


def full_sync(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert, and delete what the source no longer holds."""
    changed = [c for c in source.columns if c in target.columns and c not in keys]
    return merge(target, source, keys, [matched(take(*changed)), absent(), orphan(delete=True)])


def add_up(
    target: DataFrame,
    deltas: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    latest: Sequence[str] = (),
) -> DataFrame:
    """Add numeric deltas to the stored values and keep the later of each time."""
    assign = {c: F.col(f"t.{c}") + F.col(f"s.{c}") for c in sums}
    assign |= {c: F.greatest(F.col(f"t.{c}"), F.col(f"s.{c}")) for c in latest}
    return merge(target, deltas, keys, [matched(assign), absent()])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where the condition is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def soft_delete(df: DataFrame, condition: Column, at: Column) -> DataFrame:
    """Flag rows instead of removing them."""
    gone = F.coalesce(condition, F.lit(False))
    return df.withColumn("is_deleted", gone).withColumn("cancelled_at", F.when(gone, at))
