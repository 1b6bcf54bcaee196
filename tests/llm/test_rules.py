"""Quality rules against plain Python, and odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from strataloom.llm import rules
from strataloom.llm.queries import QUERIES
from strataloom.llm.textscan import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines, earlier, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    triples = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = set()
    for k in range(len(words) - 2):
        if triples[tuple(words[k : k + 3])] > 1:
            inside.update((k, k + 1, k + 2))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


def test_base_values_of_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = QUERIES["op3_rules"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain(texts[r["doc_id"]])
        assert tuple(r[c] for c in rules._BASE) == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["base_failed"] and r["kept"])
    good = [r["kept"] for r in got if truth.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if truth.get(r["doc_id"]) == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) < 0.4 * len(bad)


def test_base_values_of_odd_texts():
    texts = ["", None, "\n\n", " a\na\n a\n\n \n a", "a a a a", "a b c a b c", "x\x1cy\x0bz q é#|漢", "w " * 90_000, "a b", "\n".join(["l m"] * 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = [tuple(int(getattr(s, c)[k]) for c in rules._BASE) for r in runs(batch) for s in [rules.scan(r)] for k in range(r.hi - r.lo)]
    assert got == [plain(t) for t in texts]


def test_distance_by_hand():
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    want = math.sqrt((kl(p) + kl(q)) / 2)
    got = rules.js_distance(np.array([[4, 4, 0], [0, 0, 0]]), np.array(q))
    assert np.allclose(got, [want, 1.0])


def test_references_and_odd_rows(spark):
    rows = [(k, "the cat and the dog sat on a mat " * 12, "en", k) for k in range(5)]
    rows += [(9, "%%% $$$ " * 100, None, 0), (9, None, "en", 0), (9, "", None, 0), (None, "the cat", "xx", 0)]
    rows.append((10, "the cat and the dog sat on a mat " * 12, None, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept long")
    ref = rules.references(docs)
    assert ref.languages == ["en", "xx"] and np.allclose(ref.words.sum(axis=1), 1) and np.allclose(ref.classes.sum(axis=1), 1)
    counts = Counter(("the cat and the dog sat on a mat " * 60).split())
    assert math.isclose(max(ref.words[0]), counts["the"] / sum(counts.values()))
    got = rules.judge(docs, ref).collect()
    assert len(got) == len(rows) and all(isinstance(r["kept"], bool) for r in got)
    near = {r["text"]: r["word_distance"] for r in got}
    assert near["the cat and the dog sat on a mat " * 12] < 0.05 < near["%%% $$$ " * 100]
    empty = docs.limit(0)
    assert rules.judge(empty, rules.references(empty)).count() == 0
    assert rules.judge(docs, rules.references(empty)).filter("kept").count() == 0  # all fail the base rules


def test_every_language_has_a_reference(spark):
    texts = {k: " ".join(f"w{k}x{j % 7}" for j in range(100)) for k in range(230)}
    rows = [(k, t, f"l{k:03}") for k, t in texts.items()] + [(1000 + k, texts[k], f"l{k:03}") for k in range(225)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ref = rules.references(docs)
    assert ref.languages == [f"l{k:03}" for k in range(230)]
    got = {r["doc_id"]: r for r in rules.judge(docs.select("doc_id", "text"), ref).collect()}
    assert all(got[k]["nearest"] == f"l{k:03}" and got[k]["word_distance"] < 1e-6 for k in range(230))
    few = rules.references(docs, languages=3)  # how many a task holds changes nothing
    assert few.languages == ref.languages and np.allclose(few.words, ref.words) and (few.cells == ref.cells).all()
