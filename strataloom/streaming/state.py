"""Tables that a stream keeps up to date, batch by batch.

Both work inside ``foreachBatch`` on ordinary tables, so the stream itself keeps
no state and events may come as late as they like. A batch that is repeated
after a failure changes nothing: what a batch writes carries its number, and
only what earlier batches wrote counts as known.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.aggregates import first_row
from ..session import pin, scratch_path, scratch_run, shuffle_width

_BATCH = "_batch"


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], label: str) -> None:
    started = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", scratch_path(stream.sparkSession, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Keys agree with their prefixed copies; NULL agrees with NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _empty_table(stream: DataFrame, schema: StructType, label: str) -> str:
    path = scratch_path(stream.sparkSession, label)
    stream.sparkSession.createDataFrame([], schema).write.parquet(path)
    return path


class KeyTable:
    """Events once per key, in a table by day of ``at`` and batch.

    A repeat of an event has the time of the first, so a batch is compared with
    the days it has events of and with no others, however long the table.
    """

    def __init__(self, stream: DataFrame, keys: Sequence[str], at: str, label: str):
        self.keys, self.at, self.columns = list(keys), at, stream.columns
        self.schema = StructType([*stream.schema.fields, StructField("_day", StringType()), StructField(_BATCH, LongType())])
        self.path = _empty_table(stream, self.schema, label)

    def write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        day = F.coalesce(F.col(self.at).cast("date").cast("string"), F.lit("none"))
        order = [F.col(self.at), *[F.col(c) for c in self.columns if c != self.at and c not in self.keys]]
        with scratch_run(spark):
            once = pin(first_row(batch, self.keys, order).withColumn("_day", day), "batch")
            days = [r["_day"] for r in once.select("_day").distinct().collect()]
            known = spark.read.schema(self.schema).parquet(self.path).filter(
                F.col("_day").isin(days) & (F.col(_BATCH) < number)
            ).select(*[F.col(k).alias(f"_known_{k}") for k in self.keys])
            fresh = once.join(known, _same(self.keys, "_known_"), "left_anti").withColumn(_BATCH, F.lit(number).cast("bigint"))
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", _BATCH).parquet(self.path)


def keep_once(stream: DataFrame, keys: Sequence[str], at: str, label: str) -> DataFrame:
    """All events, each key once, however late it comes or comes again."""
    table = KeyTable(stream, keys, at, label)
    _each_batch(stream, table.write, label)
    return stream.sparkSession.read.schema(table.schema).parquet(table.path).select(*stream.columns)


class StatusTable:
    """The last two events of every entity, their number, first and last time, and extremes of other columns.

    The table lies in buckets of the entity. A batch reads and rewrites the
    buckets it has events of; its cost follows the entities in these, not the
    batches before. Rows carry the number of the batch that changed them last,
    so where a batch is repeated those it had reached stay as they are.
    """

    def __init__(
        self, stream: DataFrame, keys: Sequence[str], at: str, tie: str, status: str, label: str,
        largest: Sequence[str] = (), smallest: Sequence[str] = (),
    ):
        self.keys, self.at, self.tie, self.status = list(keys), at, tie, status
        self.largest, self.smallest = list(largest), list(smallest)
        self.buckets = 4 * shuffle_width(stream.sparkSession)
        self.schema = self._of_batch(stream, 0).schema
        self.path = _empty_table(stream, self.schema, label)

    def _event(self) -> Column:
        return F.struct(F.col(self.at).alias("at"), F.col(self.tie).alias("tie"), F.col(self.status).alias("status"))

    def _of_batch(self, batch: DataFrame, number: int) -> DataFrame:
        """State rows as if there were no events but these."""
        if batch.isStreaming:
            # only the columns and their types are asked for
            batch = batch.sparkSession.createDataFrame([], batch.schema)
        last = Window.partitionBy(*self.keys).orderBy(F.col(self.at).desc(), F.col(self.tie).desc())
        top = batch.withColumn("_row", F.row_number().over(last)).filter("_row <= 2")
        events = top.groupBy(*self.keys).agg(F.collect_list(self._event()).alias("events"))
        sums = batch.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("event_count"), F.min(self.at).alias("first_event"), F.max(self.at).alias("last_event"),
            *[F.max(c).alias(c) for c in self.largest], *[F.min(c).alias(c) for c in self.smallest],
        )
        both = sums.join(events.withColumnsRenamed({k: f"_of_{k}" for k in self.keys}), _same(self.keys, "_of_"))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).alias("_bucket")
        return both.drop(*[f"_of_{k}" for k in self.keys]).select("*", F.lit(number).cast("bigint").alias(_BATCH), bucket)

    def _added(self, rows: DataFrame) -> DataFrame:
        """One row per entity of at most two: the state before and the batch."""
        newest = F.slice(F.reverse(F.array_sort(F.flatten(F.collect_list("events")))), 1, 2)
        return rows.groupBy(*self.keys, "_bucket").agg(
            F.sum("event_count").alias("event_count"), F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"), F.max(_BATCH).alias(_BATCH), newest.alias("events"),
            *[F.max(c).alias(c) for c in self.largest], *[F.min(c).alias(c) for c in self.smallest],
        )

    def write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch_run(spark):
            new = pin(self._of_batch(batch, number), "batch")
            buckets = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]
            old = spark.read.schema(self.schema).parquet(self.path).filter(F.col("_bucket").isin(buckets))
            done = old.filter(F.col(_BATCH) >= number).select(*[F.col(k).alias(f"_done_{k}") for k in self.keys])
            rows = old.unionByName(new.join(done, _same(self.keys, "_done_"), "left_anti"))
            # complete before a bucket is replaced, as it is made of the one it replaces
            state = pin(self._added(rows).select(*self.schema.fieldNames()), "state")
            state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)

    def read(self, spark) -> DataFrame:
        rows = spark.read.schema(self.schema).parquet(self.path)
        latest, before = F.get("events", F.lit(0)), F.get("events", F.lit(1))
        return rows.select(
            *self.keys, latest["status"].alias("latest_status"), before["status"].alias("previous_status"), "event_count",
            latest["at"].alias("latest_at"), before["at"].alias("previous_at"), "first_event", "last_event",
            *self.largest, *self.smallest,
        )


def keep_latest(
    stream: DataFrame, keys: Sequence[str], at: str, tie: str, status: str, label: str,
    largest: Sequence[str] = (), smallest: Sequence[str] = (),
) -> DataFrame:
    """Latest and previous status of every entity, with times and extremes; events may come in any order."""
    table = StatusTable(stream, keys, at, tie, status, label, largest, smallest)
    _each_batch(stream, table.write, label)
    return table.read(stream.sparkSession)
