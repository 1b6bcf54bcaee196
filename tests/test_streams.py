"""Streams over several files give the batch result."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom.operators.sessions import first_per_bucket, number_sessions
from strataloom.session import scratch_path
from strataloom.streaming import events as S
from strataloom.streaming.state import KeyTable, StatusTable, keep_latest, keep_once

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark):
    """Three files in order of arrival; some rows of the first days come late and some twice."""
    raw = spark.read.parquet(f"{ROOT}/events.parquet").drop("props")
    folder = scratch_path(spark, "feed")
    day = F.dayofmonth("ts")
    late = (F.col("event_type") == "error") & (day.isin(9, 10))
    parts = [(day <= 10) & ~late, ((day > 10) & (day <= 20)) | late, day >= 20]
    for i, part in enumerate(parts):
        raw.filter(part).coalesce(1).write.parquet(f"{folder}/part={i}")
    return raw, folder


def stream(spark, feed):
    raw, folder = feed
    return S.event_stream(spark, folder + "/*", "*.parquet", raw.schema, "ts", per_trigger=1)


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_dedup(spark, feed):
    raw, _ = feed
    once = S.run_append(S.dedup_within(stream(spark, feed), ["event_id"], "ts", "12 days"), "t-dedup")
    assert ids(once) == ids(raw)


def test_bucket_first(spark, feed):
    raw, _ = feed
    rows, close = S.with_end_mark(stream(spark, feed), "ts")
    once = S.dedup_within(rows, ["event_id"], "ts", "12 days")
    first = S.first_per_bucket(once, ["user_id"], "ts", 60, "event_id", None)
    got = S.run_append(first, "t-bucket", close)
    assert ids(got) == ids(first_per_bucket(raw, ["user_id"], "ts", 60, ["event_id"]))


def test_open_windows_wait_for_the_end_mark(spark, feed):
    raw, _ = feed
    rows, close = S.with_end_mark(stream(spark, feed), "ts")
    hourly = S.tumbling(rows, "ts", "1 hour", "12 days", [], events=F.count(F.lit(1)))
    open_ = S.run_append(hourly, "t-open")
    whole = S.run_append(hourly, "t-whole", close)
    twice = raw.filter(F.dayofmonth("ts") == 20).count()  # the feed has these rows twice
    assert open_.count() < whole.count() and whole.agg(F.sum("events")).first()[0] == raw.count() + twice


def test_sessions_split_as_in_batch(spark):
    folder = scratch_path(spark, "pauses")
    times = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 02:00:00.000001"]
    raw = spark.createDataFrame([(1, k, t) for k, t in enumerate(times)], "u int, e int, t string")
    raw = raw.withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    raw.coalesce(1).write.parquet(folder)
    rows, close = S.with_end_mark(S.event_stream(spark, folder, "*.parquet", raw.schema, "ts"), "ts")
    found = S.run_append(S.gap_sessions(rows, ["u"], "ts", "1 hour", "1 minute", n=F.count(F.lit(1))), "t-pause", close)
    batch = number_sessions(raw, ["u"], "ts", 3600, ["e"]).groupBy("session_no").count()
    assert sorted(r["n"] for r in found.collect()) == sorted(r["count"] for r in batch.collect()) == [1, 2]


def test_latest_status(spark, feed):
    raw, _ = feed
    once = keep_once(stream(spark, feed), ["event_id"], "ts", "t-status-in")
    assert ids(once) == ids(raw)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = raw.withColumn("before", F.lag("event_type").over(w))
    expected = before.groupBy("user_id").agg(
        F.max_by(F.struct("event_type", "before"), F.struct("ts", "event_id")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    day = F.dayofmonth("ts")
    folder = scratch_path(spark, "one-by-one")
    # days come last first, so the previous status is often found after the latest
    for k, part in enumerate([day > 20, (day > 10) & (day <= 20), day <= 10]):
        raw.filter(part).coalesce(1).write.parquet(f"{folder}/part={k}")
    rows = S.event_stream(spark, folder + "/*", "*.parquet", raw.schema, "ts", per_trigger=1)
    got = keep_latest(rows, ["user_id"], "ts", "event_id", "event_type", "t-status").collect()
    assert {r["user_id"]: (r["latest_status"], r["previous_status"], r["event_count"]) for r in got} == {
        r["user_id"]: (*r["s"], r["n"]) for r in expected.collect()
    }


EVENTS = "event_id int, who string, what string, at timestamp"


def batch(spark, *rows):
    return spark.createDataFrame([(i, w, s, datetime(2024, 1, d, h)) for i, w, s, d, h in rows], EVENTS)


def test_a_repeated_batch_changes_nothing(spark):
    empty = spark.createDataFrame([], EVENTS)
    once = KeyTable(empty, ["event_id"], "at", "t-keys")
    last = StatusTable(empty, ["who"], "at", "event_id", "what", "t-last")
    one = batch(spark, (1, "a", "new", 1, 1), (2, "b", "new", 1, 2), (3, None, "lost", 2, 1))
    two = batch(spark, (4, "a", "sent", 3, 1), (1, "a", "new", 1, 1), (3, None, "lost", 2, 1), (5, "c", "new", 3, 1))
    seen = []
    for number, rows in [(0, one), (0, one), (1, two), (1, two), (1, two)]:
        once.write(rows, number)
        known = spark.read.schema(once.schema).parquet(once.path)
        seen.append(sorted(r["event_id"] for r in known.collect()))
        last.write(rows.filter("event_id not in (1, 3) or %d = 0" % number), number)
    assert seen == [[1, 2, 3]] * 2 + [[1, 2, 3, 4, 5]] * 3
    got = {r["who"]: (r["latest_status"], r["previous_status"], r["event_count"]) for r in last.read(spark).collect()}
    assert got == {"a": ("sent", "new", 2), "b": ("new", None, 1), None: ("lost", None, 1), "c": ("new", None, 1)}
    # a batch that broke off after some of its buckets: those are not counted again
    part = spark.read.schema(last.schema).parquet(last.path).filter("who = 'a'").first()["_bucket"]
    three = batch(spark, (6, "a", "done", 5, 1), (7, "b", "sent", 5, 1), (8, "c", "sent", 5, 1))
    broken = three.filter(F.pmod(F.xxhash64("who"), F.lit(last.buckets)) == part)
    last.write(broken, 2)
    last.write(three, 2)
    got = {r["who"]: (r["latest_status"], r["previous_status"], r["event_count"]) for r in last.read(spark).collect()}
    assert got["a"] == ("done", "sent", 3) and got["b"] == ("sent", "new", 2) and got["c"] == ("sent", "new", 2)


def test_state_does_not_grow_with_batches(spark):
    last = StatusTable(spark.createDataFrame([], EVENTS), ["who"], "at", "event_id", "what", "t-many")
    files = lambda: sum(1 for _ in Path(last.path.removeprefix("file:")).rglob("*.parquet"))
    counts = []
    for number in range(12):
        last.write(batch(spark, (number, "a", f"s{number}", 1 + number, 1), (100 + number, "b", "x", 1 + number, 2)), number)
        counts.append(files())
    assert counts[-1] == counts[0]
    got = {r["who"]: (r["latest_status"], r["previous_status"], r["event_count"]) for r in last.read(spark).collect()}
    assert got == {"a": ("s11", "s10", 12), "b": ("x", "x", 12)}
