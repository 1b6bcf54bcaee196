"""Spelling variants against SQL, against every pair of words, and odd rows."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from strataloom.llm import spelling as sp
from strataloom.llm.queries import QUERIES, SQL

LATIN = "abcdefghijklmnopqrstuvwxyzÀÉÖ×ßàéñö÷øÿ"


def near(a, b):
    """One inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_of(counts):
    words = sorted(counts)
    out = {}
    for w in words:
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v)) if close else None
        form = best if best and counts[best] >= 2 * counts[w] else None
        out[w] = [form, w, counts[w], len(close), counts[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def read_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "À" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                k = h % len(run)
                counts[run[:k] + run[k + 1 :] if h % 97 == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def check(got, want):
    assert {r["word"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = QUERIES["op13_spelling_variants"](spark, folder)
    found = con.execute(SQL["op13_spelling_variants"])
    assert got.columns == [c[0] for c in found.description]
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(found.fetchall()) and sum(r[1] is not None for r in rows) > 50


@pytest.mark.parametrize("letters,largest", [("ab", 4096), ("ab", 5), (LATIN, 4096), (LATIN, 3), ("aé", 1)])
def test_every_pair(spark, letters, largest):
    rng = random.Random(len(letters) + largest)
    counts = {}
    while len(counts) < 300:
        w = "".join(rng.choice(letters) for _ in range(rng.choice((5, 6, 7, 9, 12))))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w))
            w = rng.choice((w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]))
            if len(w) >= 5:
                counts[w] = rng.choice((3, 3, 4, 8, 8, 30))
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {r["word"]: tuple(r)[1:] for r in sp.near_words(words, largest).collect()}
    want = {}
    for w, row in variants_of(counts).items():
        close = [v for v in counts if near(w, v)]
        if close:
            best = min(close, key=lambda v: (-counts[v], v))
            want[w] = (len(close), best, counts[best])
    assert got == want and want


def test_one_prefix_holds_most_words(spark):
    """Groups above the limit are halved until they fit; no pair is lost or counted twice."""
    rng = random.Random(3)
    counts = {"interchange" + "".join(rng.choice("abc") for _ in range(rng.choice((4, 5, 6)))): rng.choice((3, 9)) for _ in range(400)}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    groups = sp._groups(words, 20)
    sizes = groups.groupBy(*sp._KEY).count().filter("j - i > 1").agg({"count": "max"}).first()[0]
    assert sizes <= 20
    got = {r["word"]: r["near"] for r in sp.near_words(words, 20).collect()}
    assert got == {w: k for w in counts if (k := sum(near(w, v) for v in counts))}


def test_odd_rows(spark):
    long = "x" * 3000
    rows = [(1, None), (2, ""), (3, "Hello, HELLO hello hallo hallo hallö"), (4, "ÉCOLE école École ecole ecole Ecole"),
            (5, "hello " * 30), (5, "hello " * 30), (None, "hallo hallo 漢字漢字漢字 abcd abcd abcd"),
            (6, f"{long} {long} {long} {long}y {long}y {long}y"), (7, "a×b÷c a×b÷c a×b÷c tail tails tails tails")]
    rows += [(k, "slipping " * 20 + "slippering") for k in range(100, 160)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = variants_of(read_words(rows))
    assert want["hallo"][:2] == ("hello", "hello") and len(want) > 8
    check(sp.variants(docs).collect(), want)
    check(sp.variants(docs.repartition(5), largest=2).collect(), want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.variants(docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sp.variants(docs).count() == 0


def test_roots_follow_long_chains(spark):
    chain = [(f"w{k}", f"w{k + 1}" if k < 40 else None) for k in range(41)] + [("alone", None)]
    got = sp._roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert sorted(map(tuple, got)) == sorted((f"w{k}", "w40") for k in range(40))
