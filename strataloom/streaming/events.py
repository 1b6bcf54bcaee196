"""Event operators on streams: the same results as the batch forms once time has passed.

Streams read a table folder, run until all available data is processed and
write to shared storage. Windowed results are final: a window is written once
the watermark has passed its end. An end mark closes a feed: it is read after
all data and lets the watermark pass every window that is still open.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def event_stream(
    spark: SparkSession, folder: str, files: str, schema: StructType, at: str, per_trigger: int | None = None
) -> DataFrame:
    """Stream of the Parquet files matching ``files``; ``at`` becomes a zoned timestamp for watermarks."""
    reader = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", files)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(folder).withColumn(at, F.col(at).cast("timestamp"))


#: Time of an end mark: later than any event and early enough to add intervals to.
END = "9000-01-01 00:00:00"


def with_end_mark(stream: DataFrame, at: str) -> tuple[DataFrame, Callable[[], None]]:
    """The stream with a second, empty source, and what puts the end mark into it.

    The mark has only a time. Its own window never closes, so no result shows
    it. Put it in before the operator that sets the watermark.
    """
    spark, folder = stream.sparkSession, scratch_path(stream.sparkSession, "end-mark")
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.parquet(folder)

    def close() -> None:
        one = spark.range(1).select(
            *[
                F.lit(END if f.name == at else None).cast(f.dataType).alias(f.name)
                for f in stream.schema.fields
            ]
        )
        one.write.mode("append").parquet(folder)

    return stream.unionByName(spark.readStream.schema(nothing.schema).parquet(folder)), close


def run_append(stream: DataFrame, label: str, close: Callable[[], None] | None = None) -> DataFrame:
    """Process what is available into a Parquet folder and read it back.

    ``close`` puts the end mark; the same query then goes on from its checkpoint
    and writes the windows that were open.
    """
    spark = stream.sparkSession
    path, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")

    def go() -> None:
        started = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start(path)
        )
        started.awaitTermination()

    go()
    if close is not None:
        close()
        go()
    return spark.read.schema(stream.schema).parquet(path)


def _marked(stream: DataFrame, at: str, delay: str | None) -> DataFrame:
    """A stream has one watermark per column: ``None`` where an operator before has set it."""
    return stream if delay is None else stream.withWatermark(at, delay)


def dedup_within(stream: DataFrame, keys: Sequence[str], at: str, delay: str | None) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return _marked(stream, at, delay).dropDuplicatesWithinWatermark(list(keys))


def first_per_bucket(
    stream: DataFrame, keys: Sequence[str], at: str, minutes: int, tie: str, delay: str | None
) -> DataFrame:
    """First event per key and tumbling bucket, written when the bucket is over."""
    rest = [c for c in stream.columns if c not in keys]
    grouped = (
        _marked(stream, at, delay)
        .groupBy(F.window(at, f"{minutes} minutes").alias("_w"), *keys)
        .agg(F.min_by(F.struct(*rest), F.struct(at, tie)).alias("_row"))
    )
    return grouped.select(*keys, "_row.*", F.col("_w.start").alias("bucket"))


def tumbling(stream: DataFrame, at: str, width: str, delay: str | None, by: Sequence[str], **aggs: Column) -> DataFrame:
    """Aggregates per tumbling window and key."""
    grouped = _marked(stream, at, delay).groupBy(F.window(at, width).alias("_w"), *by)
    out = grouped.agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("_w.start").alias("window_start"), *by, *aggs)


def gap_sessions(stream: DataFrame, keys: Sequence[str], at: str, gap: str, delay: str | None, **aggs: Column) -> DataFrame:
    """Sessions that end after a pause longer than ``gap``, as the batch form numbers them."""
    grouped = _marked(stream, at, delay).groupBy(*keys, F.session_window(at, gap).alias("_w"))
    out = grouped.agg(F.min(at).alias("session_start"), F.max(at).alias("session_end"), *[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, "session_start", "session_end", *aggs)


def unite(*streams: DataFrame) -> DataFrame:
    """Several feeds as one stream; columns a feed lacks read NULL."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
