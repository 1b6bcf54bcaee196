"""Near-duplicates against all pairs, with large nodes, cut clusters and odd rows."""

import random
import re

import pytest
from strataloom.llm import groups, neardup
from strataloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORD.findall(folded(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def brute(rows, percent):
    """(doc_id, n_shingles, component_id, kept) of every row; links between texts."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(top(k)) if i is not None else None
        out.append((i, len(sets[k]), c, i is None or i == c))
    return sorted(out, key=repr)


def made(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijk", k=4)) for _ in range(900)]
    text = lambda n: rng.choices(words, k=n)
    passage = text(40)
    rows = []
    base = text(150)
    for _ in range(70):  # near copies, more and less alike
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(150)] = rng.choice(words)
        rows.append(" ".join(copy))
    for _ in range(60):  # one passage that many share
        rows.append(" ".join(passage + text(rng.randrange(4, 120))))
    for _ in range(12):
        one = text(90)
        rows += [" ".join(one), " ".join(one).upper(), " ".join(one[:-2] + text(2))]
    rows += ["a b", "A  b", "a b c", "", "\n\t", None, "é É", "É é", "x y z v w", "x y z v w"]
    rows += [" ".join(base)] * 25
    rng.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


def have(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"leaf": 6, "depth": 3}, {"percent": 80}])
def test_against_all_pairs(spark, options):
    rows = made()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    assert have(neardup.near_duplicates(docs, **options)) == brute(rows, options.get("percent", 85))


def test_cut_clusters(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", 9)
    rows = made(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert have(neardup.near_duplicates(docs, leaf=5, depth=1)) == brute(rows, 85)


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "G h i j k l"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None),
            (3, long), (4, long + " end"), (5, None), (5, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    assert have(neardup.near_duplicates(docs)) == brute(rows, 85)
    left = neardup.dedup(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 3, 5, None}
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.dedup(docs.limit(0)).count() == 0


def test_dedup_with_repeated_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a), (5, a), (5, b), (7, b), (8, "x y z"), (8, "x y z"), (8, "X y z"), (9, ""), (9, ""), (None, a), (None, a)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    left = neardup.dedup(docs)
    assert left.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"].lower()) for r in left.collect())
    assert got == sorted([("3", a), ("5", b), ("8", "x y z"), ("9", ""), ("9", ""), ("None", a), ("None", a)])


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert have(QUERIES["op10_near_duplicates"](spark, folder)) == brute(rows, 85)


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)]
    edges += [(2000 + rng.randrange(100), 2000 + rng.randrange(100)) for _ in range(80)] + [(7, 7)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[top(a)] = top(b)
    got = groups.components(spark.createDataFrame(edges, "a long, b long")).collect()
    labels = {r["v"]: r["label"] for r in got}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert set(labels) == linked and len(got) == len(linked)
    want, found = {}, {}
    for v in linked:
        want.setdefault(top(v), set()).add(v)
        found.setdefault(labels[v], set()).add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, found.values()))
