"""Fingerprints against a plain rebuild, and odd rows."""

import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F
from strataloom.llm import fingerprints as fp
from strataloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<Q", v)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def sketch(text):
    words = [hashed([w]) for w in WORD.findall(text)]
    if not words:
        return set()
    n = len(words)
    all_ = {hashed(words[k : k + 5]) for k in range(n - 4)} if n > 4 else {hashed(words)}
    short = sorted({h >> 16 for h in all_})
    return set(short[: fp.LEAST]) | {h for h in short if h < (1 << 48) // fp.SCALE}


def limit(s):
    return 1 << 48 if len(s) < fp.LEAST else max((1 << 48) // fp.SCALE, max(s) + 1)


def written(s):
    return "".join(f"{h:012x}" for h in sorted(s))


def alike(a, b):
    if not a | b:
        return 1.0
    top = min(limit(a), limit(b))
    a, b = {h for h in a if h < top}, {h for h in b if h < top}
    return len(a & b) / len(a | b) if a | b else 0.0


def check(rows, got):
    """rows: (doc_id, text) in any order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((i, len(text), sha, written(a), written(b), alike(a, b), alike(a, c)))
    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    have = [tuple(r[c] for c in names) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_query_against_plain_rebuild(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op8_fingerprints"](spark, folder).collect()
    check(rows, got)
    apart = [r["near_edited"] - r["near_next"] for r in got if r["n_chars"] > 600]
    assert sum(d > 0 for d in apart) > 0.95 * len(apart)


def test_odd_rows(spark):
    rows = [(5, "a b c"), (5, "a b c"), (5, None), (4, ""), (None, "x y z é漢🙂 w v u"), (None, "q"), (9, "w é " * 40_000),
            (3, "one two three four five six seven eight nine ten"), (-2, "\t\n "), (1 << 60, "k")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, sketch string")
    for ranges in (1, 3, 50):
        got = fp.with_next(docs.select("doc_id", "text"), ranges).count()
        assert got == len(rows)
    check(rows, fp.compare_edited(docs).collect())
    assert fp.compare_edited(docs.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    check([(1, "a b c d e f g")], fp.compare_edited(alone).collect())


def test_merge_and_containment(spark):
    words = [f"w{k}" for k in range(4000)]
    df = spark.createDataFrame([(" ".join(words[:1000]), " ".join(words))], "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "sa"), "b", "sb")
    row = df.select(
        fp.containment(F.col("sa"), F.col("sb")).alias("c"), fp.likeness(F.col("sa"), F.col("sb")).alias("j"),
        (fp.merged(F.col("sa"), F.col("sb")) == F.col("sb")).alias("m"),
    ).first()
    assert row["c"] == 1.0 and abs(row["j"] - 0.25) < 0.06 and row["m"]


def test_short_texts_inside_longer_ones(spark):
    """Containment of short texts is near the truth, and merging gives the sketch of the union, for all lengths."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    pairs, truth = [], []
    for n in (5, 8, 14, 24, 60, 140, 400, 1200):
        for _ in range(40):
            more = rng.choice((0, n, 5 * n))
            part = [word() for _ in range(n)]
            own = [word() for _ in range(n // 3 + 5)]
            whole = [word() for _ in range(more // 2)] + part + [word() for _ in range(more - more // 2)]
            pairs.append((" ".join(part + own), " ".join(whole)))
            grams = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (part + own, whole)]
            truth.append(len(grams[0] & grams[1]) / len(grams[0]))
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    both = fp.with_sketch(fp.with_sketch(df, "a", "sa"), "b", "sb").select(
        "k", fp.containment(F.col("sa"), F.col("sb")).alias("c"), fp.merged(F.col("sa"), F.col("sb")).alias("m"),
        fp.containment(F.col("sa"), F.col("sa")).alias("self"),
    )
    errors = []
    for r in both.collect():
        a, b = pairs[r["k"]]
        words = [[hashed([w]) for w in t.split()] for t in (a, b)]
        union = {hashed(w[k : k + 5]) >> 16 for w in words for k in range(len(w) - 4)}
        short = sorted(union)
        assert r["m"] == sorted(set(short[: fp.LEAST]) | {h for h in short if h < (1 << 48) // fp.SCALE})
        assert r["self"] == 1.0
        errors.append(abs(r["c"] - truth[r["k"]]))
    # a short text beside a long one has few hashes below the common limit, so a single estimate may be further off
    assert sum(errors) / len(errors) < 0.1
