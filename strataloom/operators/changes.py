"""Change feeds, snapshots by version, restore and erasure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feed_from_versions(dim: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Change rows rebuilt from a versioned dimension.

    Closed versions give ``update_preimage``, the current row of a key with
    closed versions gives ``update_postimage``, of a key without ``insert``.
    """
    closed = dim.filter(~F.col("is_current"))
    current = dim.filter("is_current")
    had = closed.select(*keys).distinct()

    def rows(df: DataFrame, kind: str, old: Column, new: Column, at: str) -> DataFrame:
        return df.select(
            *keys,
            old.cast("string").alias("old_value"),
            new.cast("string").alias("new_value"),
            F.lit(kind).alias("change_type"),
            F.col(at).alias("changed_at"),
        )

    nothing = F.lit(None)
    return (
        rows(closed, "update_preimage", F.col(value), nothing, "valid_to")
        .unionByName(
            rows(
                current.join(had, list(keys), "left_semi"),
                "update_postimage",
                nothing,
                F.col(value),
                "valid_from",
            )
        )
        .unionByName(
            rows(
                current.join(had, list(keys), "left_anti"),
                "insert",
                nothing,
                F.col(value),
                "valid_from",
            )
        )
    )


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """insert, delete, update_preimage and update_postimage rows between two states."""
    rest = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*rest).alias("_b"))
    a = after.select(*keys, F.struct(*rest).alias("_a"))
    both = b.join(a, list(keys), "full_outer")
    changed = both.filter(~F.col("_b").eqNullSafe(F.col("_a")))

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    images = (
        F.when(F.col("_b").isNull(), F.array(image("insert", "_a")))
        .when(F.col("_a").isNull(), F.array(image("delete", "_b")))
        .otherwise(F.array(image("update_preimage", "_b"), image("update_postimage", "_a")))
    )
    return changed.select(*keys, F.explode(images).alias("_i")).select(
        *keys, *[F.col(f"_i.row.{c}").alias(c) for c in rest], F.col("_i.kind").alias("change_type")
    )


def column_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], labels: Mapping[str, str]
) -> DataFrame:
    """First differing column per key in the order of ``labels`` with old and new value."""
    columns = list(labels)
    b = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns])
    joined = b.join(after.select(*keys, *columns), list(keys))
    kind = old = new = None
    for c, label in labels.items():
        test = ~F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        was, now = F.col(f"_b_{c}").cast("string"), F.col(c).cast("string")
        if kind is None:
            kind, old, new = F.when(test, label), F.when(test, was), F.when(test, now)
        else:
            kind, old, new = kind.when(test, label), old.when(test, was), new.when(test, now)
    return joined.select(
        *keys, kind.alias("change_type"), old.alias("old_value"), new.alias("new_value")
    ).filter(F.col("change_type").isNotNull())


def as_of_version(
    log: DataFrame, keys: Sequence[str], version: str, number: int, deleted: str | None = None
) -> DataFrame:
    """State of a table at a version: the latest row of each key not after it."""
    rest = [c for c in log.columns if c not in keys]
    latest = (
        log.filter(F.col(version) <= number)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*log.columns)
    )
    return latest.filter(~F.col(deleted)) if deleted else latest


def restore(log: DataFrame, version: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Log without the changes after a version, and a report of what was discarded."""
    kept = log.filter(F.col(version) <= number)
    report = (
        log.filter(F.col(version) > number)
        .groupBy(F.col(version).alias("discarded_version"))
        .agg(F.count(F.lit(1)).alias("discarded_rows"))
    )
    return kept, report


def erase(
    tables: Mapping[str, DataFrame], subjects: DataFrame, keys: Mapping[str, str]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Remove all rows of the subjects from every table, with an audit of counts.

    ``subjects`` has one column; ``keys`` names the matching column per table.
    The audit counts rows per table, those to erase and those that remain.
    """
    (subject,) = subjects.columns
    marks = subjects.select(F.col(subject).alias("_subject"), F.lit(1).alias("_hit")).distinct()
    cleaned, audits = {}, []
    for name, df in tables.items():
        key = keys[name]
        cleaned[name] = df.join(marks, F.col(key) == F.col("_subject"), "left_anti")
        marked = df.select(key).join(marks, F.col(key) == F.col("_subject"), "left")
        audits.append(
            marked.agg(
                F.count(F.lit(1)).alias("rows_before"), F.count("_hit").alias("rows_erased")
            ).select(
                F.lit(name).alias("table_name"),
                "rows_before",
                "rows_erased",
                (F.col("rows_before") - F.col("rows_erased")).alias("rows_after"),
            )
        )
    report = audits[0]
    for a in audits[1:]:
        report = report.unionByName(a)
    return cleaned, report


def audit_rows(df: DataFrame, table: str, operation: str, key: str, details: Sequence) -> DataFrame:
    """Audit trail entries with a text of the given columns."""
    parts = []
    for label, column in details:
        parts += [F.lit(label), F.coalesce(F.col(column).cast("string"), F.lit(""))]
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(operation).alias("operation"),
        F.col(key).cast("string").alias("record_key"),
        F.concat(*parts).alias("details"),
    )
