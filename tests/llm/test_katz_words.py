"""Katz back-off over all words: no word is folded, whatever is answered from the broadcast."""

import math
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from strataloom.llm import katz_words
from strataloom.llm.queries import QUERIES
from test_katz import Plain, made, tokens


@pytest.mark.parametrize("share", [1e-5, 0.004, 0.03, 1.0])
def test_share_changes_no_score(spark, share):
    rows = made() + [(200, None), (201, ""), (202, "new words never seen w0 The"), (202, "w0"), (None, "w1 w2"), (203, "w0 The " * 9000)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double").repartition(5)
    teach = (F.col("doc_id") < 201) & (F.col("doc_id") % 7 != 0)
    model = katz_words.fit(docs, teach, share)
    plain = Plain([t for i, t in rows if i is not None and i < 201 and i % 7], 0.0)  # every word by itself
    got = katz_words.score(docs, teach, model).collect()
    assert len(got) == len(rows) and model.unigrams.total == plain.total
    want = sorted(
        (str(i), len(tokens(t)), sum(plain.c1[x] > 0 for x in tokens(t)), round(plain.base(t), 5), round(plain.score(t), 5)) for i, t in rows
    )
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], abs_tol=1e-4) and math.isclose(a[4], b[4], abs_tol=1e-4), (a, b)


def test_query_scores_rare_words_by_their_own_pairs(spark, tmp_path):
    # so many tokens that words seen three times are under the share of the broadcast
    rows = [(k, "the " * 2000) for k in range(350)] + [(400 + k, f"rare{k % 20} pair{k % 20} end") for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op4_katz"](spark, str(tmp_path)).collect()}
    plain = Plain([t for i, t in rows if crc32(str(i).encode()) % 10], 0.0)
    for i, t in rows:
        assert math.isclose(got[i]["score"], plain.score(t), rel_tol=1e-9), (i, got[i]["score"], plain.score(t))


def test_nothing_taught(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz_words.score(docs, F.lit(False), katz_words.fit(docs, F.lit(False))).collect()
    assert [(r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in got] == [(0, 0, 0)] * 2
    assert katz_words.score(docs.limit(0), F.lit(True), katz_words.fit(docs, F.lit(True))).count() == 0
    assert katz_words.fit(docs.limit(0), F.lit(True)).unigrams.total == 0
    assert np.isfinite(katz_words.fit(docs, F.lit(True)).scorer.log_back).all()
