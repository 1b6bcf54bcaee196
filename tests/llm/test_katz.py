"""Katz back-off against a plain rebuild, normalisation, and odd rows."""

import math
import random
import re
import statistics
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from strataloom.llm import katz
from strataloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END, BEGIN, SHARED = ("end",), ("begin",), ("shared",)


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), END]


def good_turing(counts):
    n, top = Counter(counts.values()), katz.TOP
    seen = [r for r in range(1, top + 2) if n[r]]
    slope = -2.0
    if len(seen) > 1:
        slope = statistics.linear_regression([math.log(r) for r in seen], [math.log(n[r]) for r in seen]).slope
    smooth = lambda r: r ** min(slope, -katz.LEAST_FALL)
    beyond = (top + 1) * smooth(top + 1) / smooth(1)
    d = {r: ((r + 1) * smooth(r + 1) / (r * smooth(r)) - beyond) / (1 - beyond) for r in range(1, top + 1)}
    return lambda c: d.get(c, 1.0)


def test_discounts_are_good_turing_for_any_counts():
    for n in ([0, 900, 300, 150, 80, 120, 60, 30], [0, 5, 9, 20, 40, 80, 160, 320], [0, 0, 0, 7, 0, 0, 0, 0], [0] * 8, [0, 1, 0, 0, 0, 0, 0, 0]):
        d = katz.discounts(np.array((n + [0] * katz.TOP)[: katz.TOP + 2], float))
        assert d[0] == d[-1] == 1.0 and (0 < d[1:-1]).all() and (np.diff(d[1:]) > 0).all()


class Plain:
    def __init__(self, texts, share):
        seqs = [tokens(t) for t in texts]
        self.c1 = Counter(x for s in seqs for x in s)
        self.total = sum(self.c1.values())
        d1 = good_turing(self.c1)
        self.frequent = {x for x, c in self.c1.items() if x is not END and c >= max(1.0, share * self.total)}
        scale = 1 / max(self.total, 1)
        unseen = 1 - sum(d1(c) * c for c in self.c1.values()) * scale
        if self.total and unseen < 1e-12:
            scale = unseen = 1 / (self.total + 1)
        self.p1 = {x: d1(c) * c * scale for x, c in self.c1.items()}
        self.unseen = unseen
        self.mass = {x: self.p1[x] for x in self.frequent} | {END: self.p1.get(END, 0.0)}
        self.mass[SHARED] = 1 - sum(self.mass.values())
        pairs = Counter()
        for s in seqs:
            h = BEGIN
            for x in s:
                pairs[h, self.kind(x)] += 1
                h = self.kind(x)
        d2 = good_turing(pairs)
        after = defaultdict(dict)
        for (h, x), c in pairs.items():
            after[h][x] = c
        self.after, self.d2 = after, d2

    def kind(self, x):
        return x if x is END or x in self.frequent else SHARED

    def of_class(self, h, x):
        seen = self.after.get(h)
        if not seen:
            return self.mass[x]
        c, left = sum(seen.values()), sum(self.d2(v) * v for v in seen.values())
        rest = 1 - sum(self.mass[y] for y in seen)
        if rest < 1e-12:
            return self.d2(seen[x]) * seen[x] / left if x in seen else 0.0
        total = c if 1 - left / c >= 1e-12 else c + 1
        if x in seen:
            return self.d2(seen[x]) * seen[x] / total
        return (1 - left / total) / rest * self.mass[x]

    def score(self, text):
        out, h = 0.0, BEGIN
        for x in tokens(text):
            k = self.kind(x)
            p = self.of_class(h, k)
            if k is SHARED:
                p *= self.p1.get(x, self.unseen) / self.mass[SHARED]
            out += math.log10(p)
            h = k
        return out

    def base(self, text):
        types = len(self.c1)
        return sum(math.log10((self.c1[x] + 0.1) / (self.total + 0.1 * (types + 1))) for x in tokens(text))


def made(seed=1, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    weight = [1 / (k + 1) for k in range(400)]
    rows = []
    for k in range(n):
        text = []
        for _ in range(rng.randrange(60)):
            text.append("The" if text and text[-1] == "w0" and rng.random() < 0.7 else rng.choices(words, weight)[0])
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("share", [1e-5, 0.004, 0.03, 1.0])
def test_against_plain_rebuild(spark, share, monkeypatch):
    rows = made() + [(200, None), (201, ""), (202, "new words never seen w0 The"), (202, "w0"), (None, "w1 w2"), (203, "w0 The " * 9000)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double").repartition(5)
    teach = (F.col("doc_id") < 201) & (F.col("doc_id") % 7 != 0)
    model = katz.fit(docs, teach, share)
    plain = Plain([t for i, t in rows if i is not None and i < 201 and i % 7], share)
    got = katz.score(docs, teach, model).collect()
    assert len(got) == len(rows) and model.unigrams.total == plain.total
    want = sorted(
        (str(i), len(tokens(t)), sum(plain.c1[x] > 0 for x in tokens(t)), round(plain.base(t), 5), round(plain.score(t), 5)) for i, t in rows
    )
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], abs_tol=1e-4) and math.isclose(a[4], b[4], abs_tol=1e-4), (a, b)


@pytest.mark.parametrize("share", [1e-5, 0.01])
def test_every_context_sums_to_one(spark, share):
    docs = spark.createDataFrame(made(5), "doc_id long, text string")
    m = katz.fit(docs, F.lit(True), share)
    u, s = m.unigrams, m.held()
    table = {}
    for r in m.pairs.collect():
        table.update(zip(np.frombuffer(r["a"], np.uint64).tolist(), np.frombuffer(r["b"], np.int64).tolist(), strict=True))
    for h in range(u.width):
        pair = np.array([h * u.width + x for x in range(u.width - 1)], np.uint64)
        logs = s.pair_log(pair, np.array([table.get(int(p), 0) for p in pair]))
        assert math.isclose((10**logs).sum(), 1, rel_tol=1e-9)
    counts = np.concatenate([np.frombuffer(r["b"], np.int64) for r in m.words.collect()])
    assert math.isclose(u.probability(counts).sum() + u.mass[u.end] + u.unseen, 1, rel_tol=1e-9)


def test_nothing_taught(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = katz.fit(docs, F.lit(False))
    got = katz.score(docs, F.lit(False), model).collect()
    assert [(r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in got] == [(0, 0, 0)] * 2
    assert katz.score(docs.limit(0), F.lit(True), model).count() == 0
    assert katz.fit(docs.limit(0), F.lit(True)).unigrams.total == 0


def test_query_beats_its_base(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(x for i, t in texts.items() if not out(i) for x in tokens(t))
    total = sum(c.values())
    got = QUERIES["op4_katz"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        own = tokens(texts[r["doc_id"]])
        assert r["held_out"] == out(r["doc_id"]) and r["train_tokens"] == total and r["n_tokens"] == len(own)
        assert r["n_known"] == sum(c[x] > 0 for x in own)
        base = sum(math.log10((c[x] + 0.1) / (total + 0.1 * (len(c) + 1))) for x in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
