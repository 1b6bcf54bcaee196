"""The filter over keys refuses none of them, and the copies are dropped without moving the other texts."""

import corpus_pipeline
from pyspark.sql import functions as F
from strataloom.llm import neardup
from strataloom.llm.keyfilter import key_filter


def test_keys_pass_and_few_others(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 5 == 0).alias("own"))
    near = key_filter(rows.filter("own").select("k"))
    got = {r["own"]: r["n"] for r in rows.filter(near(F.col("k"))).groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[True] == 4_000 and got.get(False, 0) < 200
    assert rows.filter(key_filter(rows.filter("false").select("k"))(F.col("k"))).isEmpty()


def test_bounded_filter_refuses_no_key(spark, monkeypatch):
    monkeypatch.setattr("strataloom.llm.keyfilter.MOST_BITS", 1 << 20)
    rows = spark.range(300_000).select(F.xxhash64("id").alias("k"))
    assert rows.filter(key_filter(rows)(F.col("k"))).count() == 300_000


def test_only_texts_that_may_go_are_moved(spark, monkeypatch):
    """Rows that the filter lets through, of 400 texts with 40 copies: the joins of texts see no others."""
    text = lambda k: " ".join(f"w{k * 7 + j}" for j in range(12))
    rows = [(k, text(1000 * k)) for k in range(400)] + [(400 + k, text(1000 * k)) for k in range(40)]
    docs, passed = spark.createDataFrame(rows, "doc_id long, text string"), []

    def watched(keys):
        near = key_filter(keys)
        passed.append(docs.filter(near(F.xxhash64("doc_id", F.xxhash64("text")))).count())
        return near

    monkeypatch.setattr(neardup, "key_filter", watched)
    left = neardup.dedup(docs)
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(400))
    assert 40 <= passed[-1] < 60


def test_encoding_and_decoding_are_apart(spark):
    docs = spark.createDataFrame([(1, "en", "a", "two words")], "doc_id long, lang string, source string, text string")
    done = corpus_pipeline.tokenize(spark, docs, "")
    assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert done.first()["text"] == "two words"
