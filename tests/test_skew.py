"""Operators give plain-window results when one key holds a third of all rows and is cut."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom import session
from strataloom.operators import aggregates
from strataloom.operators.aggregates import percentiles
from strataloom.operators.joins import as_of, either_key, left_if_named
from strataloom.operators.ranking import number_rows, ntile, rank_values
from strataloom.operators.sessions import number_sessions
from strataloom.operators.timeline import Timeline
from strataloom.session import prepare

ROOT = "/root/testdata/sf0.001"


def same(a, b):
    columns = sorted(a.columns)
    left = sorted((tuple(r[c] for c in columns) for r in a.collect()), key=repr)
    right = sorted((tuple(r[c] for c in columns) for r in b.collect()), key=repr)
    assert left == right


@pytest.fixture(scope="module")
def events(spark):
    raw = spark.read.parquet(f"{ROOT}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    return raw.withColumn("user_id", hot).withColumn("cents", F.round(F.col("value") * 100).cast("long")).drop("props")


def plain(events, **columns):
    return events.select("event_id", *[c.alias(n) for n, c in columns.items()])


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_near(events, hot_rows):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    line = Timeline(events, ["user_id"], ["ts", "event_id"], hot_rows=hot_rows)
    assert line.split == (hot_rows is not None)
    got = line.near(
        before=5,
        after=3,
        past=lambda w: F.sum("cents").over(w.rowsBetween(-5, 0)),
        back=lambda w: F.lag("cents", 4).over(w),
        ahead=lambda w: F.lead("event_type", 3).over(w),
    ).rows
    expected = plain(
        events,
        past=F.sum("cents").over(w.rowsBetween(-5, 0)),
        back=F.lag("cents", 4).over(w),
        ahead=F.lead("event_type", 3).over(w),
    )
    same(got.select(*expected.columns), expected)


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_running_and_latest(events, hot_rows):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    bought = F.when(F.col("event_type") == "purchase", F.col("cents"))
    line = Timeline(events, ["user_id"], ["ts", "event_id"], hot_rows=hot_rows)
    got = line.running(total=F.col("cents"), spent=bought).latest(last=bought).number("n").rows
    expected = plain(
        events,
        total=F.sum("cents").over(w),
        spent=F.sum(bought).over(w),
        last=F.last(bought, ignorenulls=True).over(w),
        n=F.count(F.lit(1)).over(w),
    )
    same(got.select(*expected.columns), expected)


def test_cut_inside_equal_times(events):
    """All rows of the hot key share few times."""
    coarse = events.withColumn("ts", F.date_trunc("week", "ts").cast("timestamp_ntz"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    line = Timeline(coarse, ["user_id"], ["ts", "event_id"], hot_rows=20)
    got = line.near(before=1, prev=lambda w: F.lag("event_id").over(w)).rows.select("event_id", "prev")
    same(got, plain(coarse, prev=F.lag("event_id").over(w)))


def test_one_time_is_cut_evenly(events):
    """All rows at one time: keys are cut by the next order column, facts of a join by a hash."""
    once = events.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    line = Timeline(once, ["user_id"], ["ts", "event_id"], hot_rows=40)
    sizes = [r["count"] for r in line._rows.filter("user_id = 7").groupBy("_piece").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
    w = Window.partitionBy("user_id").orderBy("event_id")
    got = line.near(before=2, prev=lambda w: F.lag("cents", 2).over(w)).running(total=F.col("cents")).rows
    same(
        got.select("event_id", "prev", "total"),
        plain(once, prev=F.lag("cents", 2).over(w), total=F.sum("cents").over(w.rowsBetween(Window.unboundedPreceding, 0))),
    )
    versions = events.groupBy("user_id").agg(F.max("cents").alias("level")).withColumn("since", F.lit("2023-01-01").cast("timestamp"))
    facts = once.select("event_id", "user_id", "ts")
    found = as_of(facts, versions, ["user_id"], "ts", "since", None, ["level"], hot_rows=40)
    same(found, facts.join(versions, "user_id").select("event_id", "user_id", "ts", "level"))


def test_pieces_are_balanced(events):
    line = Timeline(events, ["user_id"], ["ts", "event_id"], hot_rows=40)
    sizes = [r["count"] for r in line._rows.filter("user_id = 7").groupBy("_piece").count().collect()]
    assert len(sizes) >= 4
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_sessions(events):
    same(
        number_sessions(events, ["user_id"], "ts", 1800, ["event_id"], hot_rows=30),
        number_sessions(events, ["user_id"], "ts", 1800, ["event_id"]),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_as_of(events, how):
    versions = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("since"), F.col("cents").alias("level"))
    w = Window.partitionBy("user_id").orderBy("since")
    # every second version ends early, so there are gaps
    versions = versions.withColumn("until", F.lead("since").over(w)).withColumn(
        "until", F.when(F.col("level") % 2 == 0, F.col("since") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("until"))
    )
    nxt = F.lead("since").over(w)
    versions = versions.withColumn("until", F.least("until", nxt))
    facts = events.select("event_id", "user_id", "ts")
    got = as_of(facts, versions, ["user_id"], "ts", "since", "until", ["level"], how=how, hot_rows=30)
    on = (F.col("f.user_id") == F.col("v.user_id")) & (F.col("ts") >= F.col("since")) & (
        F.col("until").isNull() | (F.col("ts") < F.col("until"))
    )
    expected = facts.alias("f").join(versions.alias("v"), on, how).select("event_id", "f.user_id", "ts", "level")
    same(got, expected)


def test_strictly_later(spark):
    facts = spark.createDataFrame([(1, "k", "2024-01-01 10:00:00"), (2, "k", "2024-01-01 12:00:00"), (3, "q", None)], "id int, k string, t string")
    ships = spark.createDataFrame([("k", "2024-01-01 10:00:00"), ("k", "2024-01-01 10:00:00.5"), ("k", "2024-01-01 12:00:00")], "k string, s string")
    facts, ships = facts.withColumn("t", F.col("t").cast("timestamp")), ships.withColumn("s", F.col("s").cast("timestamp"))

    def found(strict):
        got = as_of(facts, ships, ["k"], "t", "s", None, ["s"], how="left", direction="forward", strict=strict)
        return {r["id"]: str(r["s"])[11:21] for r in got.collect()}

    assert found(True) == {1: "10:00:00.5", 2: "", 3: ""}
    assert found(False) == {1: "10:00:00", 2: "12:00:00", 3: ""}
    back = as_of(facts, ships, ["k"], "t", "s", None, ["s"], how="left", strict=True)
    assert {r["id"]: str(r["s"])[11:21] for r in back.collect()} == {1: "", 2: "10:00:00.5", 3: ""}


@pytest.mark.parametrize("hot_rows,margin", [(None, 2), (25, 2), (25, 0), (25, 900)])
def test_percentiles(events, monkeypatch, hot_rows, margin):
    """Sorted, bracketed, with brackets that miss some ranks, and with wide ones."""
    monkeypatch.setattr(aggregates, "_MARGIN", margin)
    events = events.withColumn("user_id", F.when(F.col("user_id") != 3, F.col("user_id"))).withColumn(
        "cents", F.when(F.col("event_id") % 5 != 0, F.col("cents"))
    )
    got = percentiles(events, ["user_id"], "cents", {"mid": 0.5, "high": 0.9}, hot_rows=hot_rows)
    expected = events.groupBy("user_id").agg(
        F.expr("percentile(cents, 0.5)").alias("mid"), F.expr("percentile(cents, 0.9)").alias("high")
    )
    same(
        got.select("user_id", F.round("mid", 6).alias("mid"), F.round("high", 6).alias("high")),
        expected.select("user_id", F.round("mid", 6).alias("mid"), F.round("high", 6).alias("high")),
    )


def test_brackets_leave_most_values_uncounted(spark):
    """Of a large group only the values around the percentiles are kept apart."""
    rows = spark.range(300_000).select(F.lit(1).alias("k"), F.pmod(F.col("id") * 7919, F.lit(300_007)).alias("_v"), F.lit(300_000).cast("long").alias("_size"))
    seen = []
    walked = aggregates._walked
    try:
        aggregates._walked = lambda counted, *rest: seen.append(counted.count()) or walked(counted, *rest)
        got = aggregates._bracketed_percentiles(rows, ["k"], {"mid": 0.5, "high": 0.9}, 1000).first()
    finally:
        aggregates._walked = walked
    want = rows.select(F.expr("percentile(_v, 0.5)"), F.expr("percentile(_v, 0.9)")).first()
    assert (got["mid"], got["high"]) == pytest.approx(tuple(want)) and not got["_missed"]
    assert seen[0] < 2000


@pytest.mark.parametrize("buckets", [1, 4, 7, 100, 5000])
def test_ntile(events, buckets):
    rows = events.select("event_id", "cents")
    w = Window.orderBy("cents", "event_id")
    same(ntile(rows, ["cents", "event_id"], buckets, "b"), rows.withColumn("b", F.ntile(buckets).over(w)))


def test_numbers_with_heavy_ties(events):
    """A third of the rows share the first order column."""
    w = Window.orderBy(F.col("user_id").desc(), F.col("event_id").asc())
    rows = events.select("user_id", "event_id")
    same(
        number_rows(rows, [F.col("user_id").desc(), "event_id"], "n"),
        rows.withColumn("n", F.row_number().over(w).cast("long")),
    )


@pytest.mark.parametrize("descending", [True, False])
def test_ranks(events, descending):
    rows = events.select("event_id", "user_id").withColumn(
        "user_id", F.when(F.col("user_id") != 3, F.col("user_id"))  # some NULL values
    ).filter("user_id IS NOT NULL OR event_id < 100000")
    order = F.col("user_id").desc() if descending else F.col("user_id").asc()
    w = Window.orderBy(order)
    got = rank_values(rows, "user_id", descending, rank="r", dense_rank="d", percent_rank="p")
    expected = rows.select(
        "*", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"),
        F.percent_rank().over(w).alias("p"),
    )
    same(got, expected)


def test_either_key(spark):
    people = spark.createDataFrame([(1,), (2,), (3,)], "who long")
    calls = spark.createDataFrame([(10, 1, 2), (11, 2, 2), (12, None, 1), (13, 9, 8), (14, 1, None)], "id long, a long, b long")
    got = either_key(people, calls, "who", "a", "b").select("who", "id")
    expected = people.join(calls, (F.col("who") == F.col("a")) | (F.col("who") == F.col("b"))).select("who", "id")
    same(got, expected)


@pytest.mark.parametrize(
    "name",
    ["fraud_score", "scd2_build", "pit_join_orders", "incident_correlation", "funnel_stage", "fact_pit_ranked",
     "workforce_kpi", "maintenance_signals", "market_median_quarter", "lifecycle_fact", "running_balance", "value_trajectory",
     "moving_anomaly_2sigma", "version_history", "pit_sale_enrichment", "zscore_outliers", "demand_signals",
     "compensation_change", "timeline_status", "sessions_30min", "clean_text_history", "pit_join_unmatched"],
)
def test_queries_with_cut_keys(spark, monkeypatch, name):
    """Whole queries stay right when nearly every key counts as hot."""
    import duckdb
    from test_queries import QUERIES, TABLES, table

    from strataloom.operators import timeline

    monkeypatch.setattr(timeline, "HOT_ROWS", 25)
    monkeypatch.setattr(aggregates, "LARGE_GROUP", 25)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    df = QUERIES[name](spark, ROOT)
    found = con.execute(QUERIES[name].sql)
    names = [c[0] for c in found.description]
    assert table([tuple(r) for r in df.collect()], df.columns, sorted(names)) == table(found.fetchall(), names, sorted(names))


def test_what_a_task_takes_is_bounded(spark):
    """Joined small partitions and splits of files do not grow with the tables; smaller settings stay."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for given, most in (("128MB", 32 << 20), ("1g", 32 << 20), ("134217728b", 32 << 20), ("16k", 16 << 10)):
            for n in names:
                spark.conf.set(n, given)
            prepare(spark)
            assert all(session._bytes(spark.conf.get(n)) <= most for n in names)
        assert all(spark.conf.get(n) == "16k" for n in names)
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_rows_without_a_key_are_dealt_out(spark):
    rows = spark.range(600).select(F.col("id").alias("row"), F.when(F.col("id") % 100 == 0, F.col("id")).alias("key"))
    other = spark.createDataFrame([(0, "a"), (100, "b"), (100, "c"), (None, "d")], "of long, name string")
    held = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = left_if_named(rows, other, "key", "of", ["row"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for n, value in held.items():
            spark.conf.set(n, value)
    assert sorted((r["row"], r["name"]) for r in got if r["name"]) == [(0, "a"), (100, "b"), (100, "c")]
    assert len(got) == 601
    sizes = Counter(r["task"] for r in got)
    assert len(sizes) > 2 and max(sizes.values()) < 300
