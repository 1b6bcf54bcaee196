"""Quality: held-out accuracy, pooling and odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from strataloom.llm import quality
from strataloom.llm.queries import QUERIES
from strataloom.llm.textscan import runs

FOLDER = "/root/testdata/sf0.1"


def test_held_out(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = QUERIES["op1_quality"](spark, FOLDER).collect()
    assert len(got) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    out = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    placed, below, hits = sorted(out), 0, 0
    for _, y in placed:
        hits, below = (hits + below, below) if y else (hits, below + 1)
    area = hits / (below * (len(out) - below))
    print("area", area, "agree", np.mean([(s >= 0.3) == y for s, y in out]))
    assert area > 0.95


def only(text):
    batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])
    return next(iter(runs(batch)))


def test_context_sums_by_hand():
    run = only("one two THREE!! one")
    word, shape, _ = quality.tokens(run)
    at_word, at_shape = quality.rows_of(word, shape)
    want = np.zeros((quality.ROWS, quality.DIM))
    marks = [quality._index(h) for h in (word, shape + np.uint64(1))]
    for i in range(4):
        for j in range(4):
            if i != j and abs(i - j) <= quality.REACH:
                for places in marks:
                    for place, sign in places:
                        want[at_word[i], place[j]] += sign
                        want[at_shape[i], place[j]] += sign
    assert np.array_equal(quality.context_sums(run).reshape(want.shape), want)


def test_pooled_by_hand():
    table = np.random.default_rng(0).normal(size=(quality.ROWS, quality.DIM)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b a b a", None, "", "x" * 70_000 + " y", "Q"])], names=["text"])
    x = np.concatenate([quality.pooled(r, table) for r in runs(batch)])
    assert not x[1].any() and not x[2].any()
    word, shape, row = quality.tokens(only("a b a b a"))
    at_word, at_shape = quality.rows_of(word, shape)
    assert np.allclose(x[0, : quality.DIM], table[at_word].mean(axis=0), atol=1e-6)
    assert np.allclose(x[0, quality.DIM : 2 * quality.DIM], table[at_shape].mean(axis=0), atol=1e-6)
    assert np.allclose(x[0, -3:], [np.log1p(5), 3 / 5, 1 / 3])


def test_odd_rows(spark):
    rows = [(k, "good words in a row", 1.0) if k % 2 else (k, "### BAD!! $$$", 1.0) for k in range(60)]
    odd = [(900, None, 1.0), (900, "", 1.0), (None, "good words", 1.0), (901, "BAD!! " * 50_000, 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels, F.lit(True))).collect()
    assert len(got) == 64 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 60)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none, F.lit(True))).collect()} == {0.5}
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels, F.lit(True))).count() == 0
