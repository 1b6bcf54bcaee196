"""Language identification: held-out accuracy and odd rows."""

import zlib

from pyspark.sql import functions as F
from strataloom.llm import langid
from strataloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op9_language"](spark, FOLDER).collect()
    assert len(got) == len(langs)
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {d for d in langs if zlib.crc32(str(d).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(k, "the cat and the dog " * 3, "en", 1.0) for k in range(30)]
    rows += [(k + 50, "der Hund und die Katze " * 3, "de", 1.0) for k in range(30)]
    rows += [(900, None, "en", 2.0), (901, "", None, 2.0), (902, "12 !! 34", "en", 2.0), (None, "the dog", None, 2.0),
             (903, "и", None, 2.0), (904, "the cat and " * 90_000, None, 2.0), (904, "the cat", None, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = langid.fit(docs, F.col("doc_id").isNotNull())
    assert model.languages == ["de", "en"]
    got = langid.predict(docs, model, reject=False).collect()
    assert len(got) == len(rows) and got[0].__fields__.count("score") == 1
    said = {(r["doc_id"], r["text"][:12] if r["text"] else r["text"]): r["lang_pred"] for r in got}
    assert said[900, None] == said[901, ""] == said[902, "12 !! 34"[:12]] == "und"
    assert said[None, "the dog"] == "en" and said[904, "the cat and "] == "en" and said[903, "и"] in ("de", "en")
    unsure = langid.predict(docs, langid.Model(model.languages, model.table, model.bias, model.heat, 1.1)).collect()
    assert {r["lang_pred"] for r in unsure} == {"und"} and all(r["rejected"] for r in unsure)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert langid.fit(docs, F.lit(True)) is None
    assert langid.predict(docs, None).first()["lang_pred"] == "und"
    assert langid.predict(docs.limit(0), None).count() == 0


def test_no_language_is_left_out_of_the_sample(spark):
    rows = [(k, f"text {k}", f"l{k % 30}") for k in range(900)] + [(1000 + k, f"rare {k}", "rare") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [r["lang"] for r in langid.sample(docs, F.lit(True), 20, 5).collect()]
    assert len(set(got)) == 31 and got.count("rare") == 3
