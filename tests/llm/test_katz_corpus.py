"""Katz back-off over all words among the texts it is learnt from: same scores as a plain rebuild, and what it moves."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from strataloom.llm import katz_corpus, katz_words
from strataloom.llm.queries import QUERIES
from strataloom.session import scratch_run
from test_katz import Plain, made, tokens


@pytest.mark.parametrize("share", [1e-5, 0.004, 0.03, 1.0])
def test_scores_are_those_of_a_plain_rebuild(spark, share, monkeypatch):
    monkeypatch.setattr(katz_corpus, "BLOCK_TOKENS", 700)
    rows = made() + [(200, None), (201, ""), (202, "new words never seen w0 The"), (202, "w0"), (None, "w1 w2"), (203, "w0 The " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    teach = (F.col("doc_id") < 201) & (F.col("doc_id") % 7 != 0)
    plain = Plain([t for i, t in rows if i is not None and i < 201 and i % 7], 0.0)
    got = katz_corpus.score_all(docs, teach, share).collect()
    assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {plain.total}
    want = sorted((str(i), len(tokens(t)), sum(plain.c1[x] > 0 for x in tokens(t)), plain.base(t), plain.score(t)) for i, t in rows)
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9) and math.isclose(a[4], b[4], rel_tol=1e-9), (a, b)


def test_nothing_taught(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz_corpus.score_all(docs, F.lit(False)).collect()
    assert [(r["n_known"], round(r["base_score"], 9), round(r["score"], 9), r["train_tokens"]) for r in got] == [(0, 0, 0, 0)] * 2
    assert katz_corpus.score_all(docs.limit(0), F.lit(True)).count() == 0
    one = katz_corpus.score_all(docs, F.lit(True)).collect()
    model = katz_words.fit(docs, F.lit(True))
    assert sorted((r["doc_id"], round(r["score"], 9)) for r in one) == sorted(
        (r["doc_id"], round(r["score"], 9)) for r in katz_words.score(docs, F.lit(True), model).collect()
    )


def test_packed_numbers_come_back_and_take_few_bytes():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 2**64, 20_000, np.uint64))
    columns = [np.zeros(0, np.uint64), hashes, rng.integers(0, 3, 20_000), np.array([2**64 - 1], np.uint64)]
    for a, b in zip(katz_corpus.unpacked(katz_corpus.packed(*columns)), columns, strict=True):
        assert np.array_equal(a, b.astype(np.uint64))
    assert np.array_equal(np.cumsum(katz_corpus.steps(hashes)), hashes)
    assert len(katz_corpus.packed(katz_corpus.steps(hashes))) < 7 * len(hashes)


def test_query_stores_few_bytes_for_a_token(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(40_000)])
    texts = [" ".join(words[(rng.pareto(0.7, 400) * 20).astype(np.int64) % 40_000]) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    with scratch_run(spark) as folder:
        assert QUERIES["op4_katz"](spark, str(tmp_path)).count() == 500
        stored = sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))
    assert stored < 6 * 200_000, stored
