"""Merge, history, change-feed, quality, privacy and layout behaviour on small rows."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataloom.functions import privacy as P
from strataloom.functions.numeric import band, points, ratio, rounded
from strataloom.operators import changes as C
from strataloom.operators import incremental as I
from strataloom.operators import quality as Q
from strataloom.operators import scd
from strataloom.operators import upsert as U
from strataloom.operators.evolve import add_columns, unify
from strataloom.session import scratch_path
from strataloom.sources import tables as T
from strataloom.sources import writers as W
from strataloom.sources.tables import key_ranges, read_ranges


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)], "k long, s string, v long")


def test_upsert_and_null_keys(spark, target):
    source = spark.createDataFrame([(2, "B", 21), (4, "d", 40), (None, "N", 1)], "k long, s string, v long")
    once = U.upsert(target, source, ["k"])
    assert rows(once) == sorted(
        [(1, "a", 10), (2, "B", 21), (3, "c", 30), (4, "d", 40), (None, "n", 0), (None, "N", 1)], key=repr
    )


def test_upsert_is_idempotent(spark, target):
    source = spark.createDataFrame([(2, "B", 21), (4, "d", 40)], "k long, s string, v long")
    once = U.upsert(target, source, ["k"])
    assert rows(U.upsert(once, source, ["k"])) == rows(once)


def test_repeated_source_key_raises(spark, target):
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "k long, s string, v long")
    with pytest.raises(Exception, match="holds a key twice"):
        U.upsert(target, source, ["k"]).collect()


def test_first_true_clause_wins(spark, target):
    source = spark.createDataFrame([(1, "a", 99), (2, "b", 99), (3, "c", 99)], "k long, s string, v long")
    merged = U.merge(
        target, source, ["k"],
        [
            U.matched({"s": F.lit("first")}, F.col("t.k") == 1),
            U.matched(delete=True, condition=F.col("t.k") <= 2),
            U.matched(U.take("v")),
        ],
    )
    assert rows(merged) == sorted([(1, "first", 10), (3, "c", 99), (None, "n", 0)], key=repr)


def test_unmatched_source_without_clause_is_ignored(spark, target):
    source = spark.createDataFrame([(9, "z", 9)], "k long, s string, v long")
    assert rows(U.merge(target, source, ["k"], [U.matched(U.take("v"))])) == rows(target)


def test_full_sync_and_newer_wins(spark, target):
    source = spark.createDataFrame([(1, "A", 5), (2, "B", 50)], "k long, s string, v long")
    assert rows(U.full_sync(target, source, ["k"])) == [(1, "A", 5), (2, "B", 50)]
    newer = U.newer_wins(target.filter("k IS NOT NULL"), source, ["k"], "v")
    assert rows(newer) == [(1, "a", 10), (2, "B", 50), (3, "c", 30)]


def test_insert_absent_keeps_target_and_dedupes(spark, target):
    source = spark.createDataFrame([(1, "x", 0), (7, "late", 2), (7, "early", 1)], "k long, s string, v long")
    added = U.insert_absent(target, source, ["k"], [F.col("v")])
    assert (7, "early", 1) in rows(added) and (1, "a", 10) in rows(added) and added.count() == 5


def test_delete_keeps_null(spark, target):
    extra = target.unionByName(spark.createDataFrame([(5, None, None)], "k long, s string, v long"))
    assert (5, None, None) in rows(U.delete_where(extra, F.col("v") > 5))


@pytest.fixture
def history(spark):
    raw = [
        (1, datetime.date(2024, 1, 1), "x"), (1, datetime.date(2024, 2, 1), "x"), (1, datetime.date(2024, 3, 1), "y"),
        (2, datetime.date(2024, 1, 5), None), (2, datetime.date(2024, 1, 9), "z"), (3, datetime.date(2024, 1, 1), "q"),
    ]
    steps = scd.changes_only(spark.createDataFrame(raw, "id long, valid_from date, tier string"), ["id"], ["valid_from"], ["tier"])
    return scd.build_history(steps, ["id"], "valid_from")


def test_history(history):
    got = rows(history, "id", "tier", "valid_from", "valid_to", "is_current")
    d = datetime.date
    assert got == sorted(
        [
            (1, "x", d(2024, 1, 1), d(2024, 3, 1), False), (1, "y", d(2024, 3, 1), None, True),
            (2, None, d(2024, 1, 5), d(2024, 1, 9), False), (2, "z", d(2024, 1, 9), None, True),
            (3, "q", d(2024, 1, 1), None, True),
        ],
        key=repr,
    )
    assert scd.invariant_breaks(history, ["id"]).count() == 0


def test_apply_batch(spark, history):
    batch = spark.createDataFrame(
        [(1, "y", datetime.date(2024, 5, 1)), (3, None, datetime.date(2024, 5, 1)), (9, "new", datetime.date(2024, 5, 1))],
        "id long, tier string, at date",
    )
    after = scd.apply_batch(history, batch, ["id"], ["tier"], "at")
    assert scd.invariant_breaks(after, ["id"]).count() == 0
    assert after.count() == history.count() + 2  # id 1 is unchanged, NULL counts as a change
    again = scd.apply_batch(after, batch, ["id"], ["tier"], "at")
    assert rows(again) == rows(after)


def test_feed_from_versions(history):
    kinds = [r["change_type"] for r in C.feed_from_versions(history, ["id"], "tier").collect()]
    assert sorted(kinds) == ["insert", "update_postimage", "update_postimage", "update_preimage", "update_preimage"]


def test_snapshot_diff_replays(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k long, s string, v long")
    after = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, "d", 4)], "k long, s string, v long")
    diff = C.snapshot_diff(before, after, ["k"])
    gone = diff.filter("change_type IN ('delete', 'update_preimage')").drop("change_type")
    come = diff.filter("change_type IN ('insert', 'update_postimage')").drop("change_type")
    replayed = before.exceptAll(gone).unionByName(come)
    assert rows(replayed) == rows(after)
    assert diff.count() == 4


def test_versions_and_erase(spark):
    log = spark.createDataFrame(
        [(1, 1, "a", False), (1, 2, "b", False), (2, 1, "x", False), (2, 3, "x", True)], "k long, ver long, s string, gone boolean"
    )
    assert rows(C.as_of_version(log, ["k"], "ver", 1, "gone"), "k", "s") == [(1, "a"), (2, "x")]
    assert rows(C.as_of_version(log, ["k"], "ver", 3, "gone"), "k", "s") == [(1, "b")]
    kept, report = C.restore(log, "ver", 1)
    assert kept.count() == 2 and rows(report) == [(2, 1), (3, 1)]
    subjects = spark.createDataFrame([(1,)], "who long")
    cleaned, audit = C.erase({"log": log}, subjects, {"log": "k"})
    assert cleaned["log"].count() == 2
    assert rows(audit) == [("log", 4, 2, 2)]


def test_watermarks(spark):
    stored = spark.createDataFrame([(5, datetime.date(2024, 1, 10))], "k long, d date")
    source = spark.createDataFrame(
        [(4, datetime.date(2024, 1, 9)), (6, datetime.date(2024, 1, 9)), (7, datetime.date(2024, 1, 1)), (8, datetime.date(2024, 1, 12))],
        "k long, d date",
    )
    assert rows(I.newer_than(source, stored, "d"), "k") == [(8,)]
    assert rows(I.newer_key_and_date(source, stored, "k", "d", 3), "k") == [(6,), (8,)]
    assert rows(I.with_overlap(source, stored, "d", 3), "k") == [(4,), (6,), (8,)]
    assert I.with_overlap(source, stored.filter("k < 0"), "d", 3).count() == 4


def test_unify(spark):
    from pyspark.sql.types import StructType

    v1 = spark.createDataFrame([(1, 5)], "id int, n int")
    v2 = spark.createDataFrame([(2, 2**40, "x")], "id int, n long, s string")
    got = unify([(1, v1, {"s": "none"}), (2, v2, {})], StructType.fromDDL("id long, n long, s string"))
    assert rows(got) == [(1, 5, "none", 1), (2, 2**40, "x", 2)]
    assert rows(add_columns(v1, {"s": "string"})) == [(1, 5, None)]


def test_quality(spark, target):
    report = Q.report(
        Q.expect_rows(target, "rows", "=", 4),
        Q.expect_value(target, "top", F.max("v"), "<", 30, where=F.col("k") < 3),
        Q.expect_none(target, {"null_key": F.col("k").isNull(), "negative": F.col("v") < 0}),
    )
    assert rows(report, "check_name", "passed") == [("negative", True), ("null_key", False), ("rows", True), ("top", True)]
    good, bad = Q.split_valid(target, {"key": F.col("k") > 0, "value": F.col("v") < 30})
    assert rows(good, "k") == [(1,), (2,)]
    assert rows(bad, "s", "broken_rules") == [("c", "value"), ("n", "key")]
    assert Q.reconcile(target, good, "t").first()["difference"] == -2


def test_privacy(spark):
    df = spark.createDataFrame([("Alice", "10.1.2.3", 47, "5551234567", datetime.date(1987, 5, 1)), (None, None, None, None, None)], "n string, ip string, age int, tel string, d date")
    got = df.select(
        P.redact("n").alias("r"), P.show_first("n", 2).alias("m"), P.subnet24("ip").alias("s"),
        P.number_band("age", 10).alias("b"), P.drop_tail("tel", 4).alias("t"), P.year_band("d", 10).alias("y"),
        P.keyed_hash("n", "x").alias("h"),
    ).collect()
    import hashlib

    assert tuple(got[0]) == (
        "[REDACTED]", "Al***", "10.1.2.0/24", "40-49", "5551230000", 1980, hashlib.sha256(b"xAlice").hexdigest(),
    )
    assert all(v is None for v in got[1])


def test_columns(spark):
    df = spark.createDataFrame([(1.005, 2.0, 0.0), (50000.5, 3.0, 1.0)], "a double, b double, z double")
    got = df.select(
        rounded("a", 2).alias("r"), ratio("a", "z", 2).alias("q"), ratio("a", "z", 2, default=-1).alias("w"),
        band("a", [10, 100000], ["low", "mid", "high"]).alias("band"), points([(F.col("b") > 2, 60), (F.col("z") > 0, 60)]).alias("p"),
    ).collect()
    assert tuple(got[0]) == (1.01, None, -1.0, "low", 0)
    assert tuple(got[1]) == (50000.5, 50000.5, 50000.5, "mid", 100)


def test_sources_and_writers(spark):
    assert rows(T.number_series(spark, 3, 5)) == [(3,), (4,), (5,)]
    assert T.date_series(spark, "2024-02-27", "2024-03-01").count() == 4
    assert T.has_rows(T.inline_rows(spark, "a int", [(1,)])) and not T.has_rows(spark.range(0))
    path = scratch_path(spark, "t")
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    W.append(df, path, ["g"])
    W.overwrite(spark.read.parquet(path).filter("id < 50"), path, ["g"])  # reads and replaces the same folder
    assert spark.read.parquet(path).count() == 50
    broken = df.withColumn("g", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        W.overwrite(broken, path)
    assert spark.read.parquet(path).count() == 50
    W.truncate_insert(df.withColumn("id", F.col("id").cast("string")), path)
    assert spark.read.parquet(path).count() == 100 and dict(spark.read.parquet(path).dtypes)["id"] == "bigint"
    bloomed = W.write_with_bloom(df, scratch_path(spark, "b"), ["id"])
    assert bloomed.filter("id = 7").count() == 1


def test_scratch_of_a_run_goes(spark):
    import os

    from strataloom.plans import load_all
    from strataloom.session import scratch_run

    with scratch_run(spark) as folder:
        found = load_all()["surrogate_keys"](spark, "/root/testdata/sf0.001").count()
        assert found and os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_zorder_box_needs_few_files(spark):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    stored = W.cluster(df, scratch_path(spark, "z"), {"a": (0, 63), "b": (0, 63)}, files=16)
    box = stored.filter("a < 16 and b < 16").select(F.input_file_name().alias("f")).distinct().count()
    assert stored.count() == 4096 and box <= 4 < stored.select(F.input_file_name().alias("f")).distinct().count()


def test_zorder_key_interleaves(spark):
    df = spark.createDataFrame([(0b101, 0b010)], "a long, b long")
    assert df.select(W.interleaved_key([F.col("a"), F.col("b")], 3).alias("z")).first()["z"] == 0b011001


def _names(path):
    return {str(f.relative_to(path)): f.stat().st_size for f in Path(path).rglob("*.parquet") if not f.name.startswith(".")}


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 2).alias("k:ey"))
    rows.filter("id < 40000").coalesce(1).write.partitionBy("k:ey").parquet(path)
    large = _names(path)
    rows.filter("id >= 40000 and id < 59000").repartition(9).write.mode("append").partitionBy("k:ey").parquet(path)
    rows.filter("id >= 59000").coalesce(1).withColumn("more", F.lit("new")).write.mode("append").partitionBy("k:ey").parquet(path)
    before, target = _names(path), min(large.values())
    want = sorted(r["id"] for r in spark.read.parquet(path).select("id").collect())
    gone = W.compact(spark, path, target)
    after = _names(path)
    assert gone == len(before) - len(large) and {n: after[n] for n in large} == large
    assert len(after) < len(before) / 2 and all(n in large or "/compacted-" in n for n in after)
    table = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted(r["id"] for r in table.select("id").collect()) == want == list(range(60_000))
    assert table.filter("more = 'new'").count() == 1000 and table.filter("id % 2 <> `k:ey`").count() == 0
    assert W.compact(spark, path, 1) == 0 and _names(path) == after


def test_a_broken_swap_is_finished(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(100).repartition(4).write.parquet(path)
    old = sorted(Path(path).glob("part-*.parquet"))
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "made"))
    (made,) = (tmp_path / "made").glob("part-*.parquet")
    made.rename(Path(path) / ".swap-x.parquet")
    (Path(path) / "_swap-x").write_text("\n".join(f"file:{f}" for f in old))
    (Path(path) / "_swap-y").write_text(f"file:{old[0]}")  # nothing was put in the place of this one
    old[0].unlink()
    assert W.compact(spark, path, 1) == 0
    assert list(_names(path)) == ["compacted-x.parquet"] and spark.read.parquet(path).count() == 100
    assert not list(Path(path).glob("_swap-*"))


def test_key_ranges_cover_everything_once(spark):
    rows = spark.createDataFrame([(k,) for k in [*range(-5, 40), None]], "k long")
    for lower, upper, parts in ((-5, 39, 4), (0, 10, 3), (7, 7, 8), (0, 1, 50)):
        found = [r["k"] for c in key_ranges("k", lower, upper, parts) for r in rows.filter(c).collect()]
        assert len(found) == 46 and set(found) == {*range(-5, 40), None}


def test_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    df = read_ranges(spark, path, "id", 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [") == 4 and "GreaterThanOrEqual(id,750)" in plan
    assert {(r["part"], r["count"]) for r in df.groupBy("part").count().collect()} == {(k, 250) for k in range(4)}
    assert read_ranges(spark, path, "id", 1).count() == 1000
