"""The stages against plain Python, on the smallest tables."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import test_neardup
import test_pii
from pyspark.sql import functions as F
from strataloom.llm import mixing
from strataloom.session import pin
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.01"
NAMES = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")


def redacted(text, spans):
    out, at = "", 0
    for start, kind, end in sorted((s, k, e) for k, s, e in spans):
        if start >= at:
            out += text[at:start] + NAMES[kind]
        at = max(at, end)
    return out + text[at:]


def targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    goal, full = share * sum(sizes.values()), set()
    while len(full) < len(names):
        level = (goal - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and most * sizes[s] <= level * weight[s]}
        if not more:
            break
        full |= more
    return {s: most * sizes[s] if s in full else level * weight[s] for s in names}


def copies(doc_id, rate):
    u = int(hashlib.md5(f"mix:{doc_id}".encode()).hexdigest()[:13], 16) / 16**13
    return int(rate) + (u < rate - int(rate))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = pin(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns and len(docs.dtypes) == 5
        kept.append([r.asDict() for r in docs.collect()])
    last = [r.asDict() for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()]

    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean, unique, cleaned, mixed = kept
    gone = set(range(1000)) - {r["doc_id"] for r in clean}
    assert 10 < len(gone) < 200 and sum(labels.get(i) == 0 for i in gone) <= 0.2 * len(gone)

    want = test_neardup.brute([(r["doc_id"], r["text"]) for r in clean], 80)
    assert {i for i, _, _, stays in want if stays} == {r["doc_id"] for r in unique}
    texts = {r["doc_id"]: r["text"] for r in unique}
    found = test_pii.rebuilt(list(texts.values()))
    for r in cleaned:
        own, added = found[texts[r["doc_id"]]]
        assert r["text"] == redacted(texts[r["doc_id"]], own + added) and r["n_chars"] == len(r["text"])

    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in cleaned}
    per = defaultdict(int)
    for r in cleaned:
        per[r["source"]] += size[r["doc_id"]]
    goal = targets(per)
    times = Counter(r["doc_id"] for r in mixed)
    for r in cleaned:
        assert times[r["doc_id"]] == copies(r["doc_id"], goal[r["source"]] / per[r["source"]])

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    final = {r["doc_id"]: r["text"] for r in cleaned}
    assert Counter(r["doc_id"] for r in last) == times
    for r in last:
        assert r["text"] == final[r["doc_id"]]
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_run_and_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_names_in_every_stage(spark, tmp_path):
    """Columns named like results, names with dots, nulls, repeated ids and long texts go through all stages."""
    plain = " ".join(f"word{k}" for k in range(60))
    texts = [(1, plain), (1, plain), (2, None), (3, ""), (None, plain), (4, "mail me at jo@ex.org " + plain[::-1]), (4, "another text"),
             (5, " ".join(f"long{k}" for k in range(60_000))), (6, "a b"), (6, "a b")]
    extra = {"score": 0.25, "predicted": 7, "a.b": "dot", "copies": 9, "target": None, "kind": "own", "c": "see", "t": 1, "ids": "no", "v": -1}
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, `a.b` string, copies int, "
        "target string, kind string, c string, t int, ids string, v int"
    )
    rows = [(i, t, "en", None if i == 3 else "s", None if t is None else len(t), *extra.values()) for i, t in texts]
    docs = spark.createDataFrame(rows, schema)
    columns = docs.columns
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        docs = pin(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
        got = docs.collect()
        for r in got:
            assert {c: r[c] for c in extra} == extra and r["lang"] == "en" and r["source"] == (None if r["doc_id"] == 3 else "s")
            assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
            assert name == "personal_data" or (r["doc_id"], r["text"]) in before
        if name == "toxicity":
            assert len(got) == len(rows)
        if name == "near_duplicates":
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, k) for k in (1, 2, 3, 4, 4, 5, 6)] + [(True, 0)]
        if name == "personal_data":
            assert [r["text"][:18] for r in got if r["doc_id"] == 4 and "mail" in r["text"]] == ["mail me at [EMAIL]"]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in last) == sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect())


def test_mixing_of_odd_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "q r", None), (4, "a " * 50_000, "y"), (5, " ", "z")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    per = {"x": 6, None: 2, "y": 50_000, "z": 0}
    goal = targets(per)
    for r in got.collect():
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == per[r["source"]]
        assert abs(r["target"] - goal[r["source"]]) < 1e-6 * max(1, goal[r["source"]])
        assert 0 <= r["copies"] <= 2 and (r["source"] != "z" or r["copies"] == 1)
    same = [r["copies"] for r in got.filter(F.col("doc_id") == 1).collect()]
    assert len(same) == 2 and same[0] == same[1]
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    clash = mixing.mixed(docs.withColumn("copies", F.lit("own")).withColumn("target", F.lit(7)))
    assert clash.columns == [*docs.columns, "copies", "target"] and clash.filter("copies = 'own' and target = 7").count() == mixing.mixed(docs).count()
    again = mixing.mixed(docs.repartition(4)).groupBy("doc_id", "text").count().collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixing.mixed(docs).groupBy("doc_id", "text").count().collect()))
