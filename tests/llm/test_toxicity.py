"""Toxicity: held-out accuracy, unseen spellings and odd rows."""

import random

from pyspark.sql import functions as F
from strataloom.llm import toxicity
from strataloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def area(scores, truth):
    """Share of pairs (positive, negative) in the right order."""
    placed = sorted(zip(scores, truth))
    below = hits = 0
    for _, y in placed:
        if y:
            hits += below
        else:
            below += 1
    return hits / (below * (len(truth) - below))


def test_held_out(spark):
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = QUERIES["op2_toxicity"](spark, FOLDER).collect()
    assert len(got) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    out = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert area([s for s, _ in out], [y for _, y in out]) > 0.92


def made(n=400):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgilmnorstu", k=rng.randrange(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for k in range(n):
        text = rng.choices(words, k=40)
        if k % 4 == 0:
            text[5] = text[20] = rng.choice(["wretched", "horrible"])
        rows.append((k, " ".join(text), 0.5))
        labels.append((k, int(k % 4 == 0)))
    return rows, labels, words


def test_unseen_spellings_and_odd_rows(spark):
    rows, labels, words = made()
    odd = [(900, " ".join(words[:38]) + " wrretched horriblle", 1.0), (901, " ".join(words[:40]), 1.0), (902, None, 1.0),
           (902, "", 1.0), (None, "wretched", 1.0), (903, "horrible " * 60_000, 1.0), (903, "horrible", 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    truth = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, truth, F.lit(True))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[900][0] > 5 * by[901][0]
    assert max(by[903]) > 0.5 and all(0 <= s <= 1 for s in by[902])
    assert by[902][0] == by[902][1]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none, F.lit(True))).collect()
    assert [r["predicted"] for r in got] == [0, 0]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none, F.lit(True))).count() == 0
