"""Source divergence against SQL, a plain rebuild, and odd rows."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from strataloom.llm import divergence as dv
from strataloom.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rebuilt(rows, fewest=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= fewest]

        def prices(count, kept=kept):
            total = sum(count[t] for t in kept)
            return np.array([1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept], np.int64)

        p = {s: prices(counts[lang, s]) for s in sources}
        q = prices(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(int(f(p[s], p[o]).sum()), o) for o in sources if o != s]
            terms = [(int(f(a, b)), t) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(order, 1)}
    return out


def check(got, want):
    got = [tuple(r) for r in got]
    assert set(got) == want and len(got) == len(want)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = QUERIES["op11_divergence"](spark, folder)
    found = con.execute(SQL["op11_divergence"])
    assert got.columns == [c[0] for c in found.description] and dict(got.dtypes)["rank"] == "int"
    check(got.collect(), set(found.fetchall()))


ODD = [
    ("en", "a", "One two TWO three " * 3), ("en", "b", None), ("en", "c", ""), (None, None, "x y"), ("en", None, "two twO É é"),
    ("de", "only", "eins zwei"), ("fr", "é", "mot mot 漢字 🙂 mot's"), ("fr", "z", "mot " * 20_000), ("fr", "Z", "a1b2 c3"),
] + [("en", f"s{k}", f"two only{k} shared" + " two" * k) for k in range(14)] + [("fr", "é", "mot mot 漢字 🙂 mot's")] * 3


@pytest.mark.parametrize("fewest", [1, 2, 10, 100])
def test_odd_rows(spark, fewest):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in ODD], "lang string, source string, text string, term string, row int")
    check(dv.audit(docs, fewest).collect(), rebuilt(ODD, fewest))
    check(dv.audit(docs.repartition(7), fewest, top=2).collect(), rebuilt(ODD, fewest, 2))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    got = dv.audit(docs)
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_blocks_of_rows_and_columns(spark, monkeypatch):
    """More sources and terms than a square has rows and columns."""
    rng = np.random.default_rng(5)
    rows = [("en", f"s{rng.integers(700):03}", " ".join(f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (6, 2)))) for _ in range(1500)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    want = rebuilt(rows, 2, 3)
    check(dv.audit(docs, 2, 3).collect(), want)


def test_walk_of_two_trees():
    """Sums over trees of any fill equal those over the whole matrix, in pieces of any size."""
    rng = np.random.default_rng(11)
    for fill, n_a, n_b, width in ((0.0, 3, 5, 7), (0.01, 90, 40, 512), (0.3, 7, 60, 300), (1.0, 5, 5, 512), (0.002, 512, 3, 100)):
        sides = []
        for n in (n_a, n_b):
            rest = rng.integers(1, 10**6, n)
            prices = np.where(rng.random((n, width)) < fill, rng.integers(1, 10**9, (n, width)), 0)
            r, c = np.nonzero(prices)
            raw = dv.tree(r, c, prices[r, c]) if len(r) else None
            sides.append((rest, np.where(prices > 0, prices, rest[:, None]), dv.Tree(raw)))
        (rest, p, one), (rest_2, q, two) = sides
        want = ((p[:, None] - q[None]) ** 2 // (p[:, None] + q[None])).sum(2)
        for most in (1 << 17, 50):
            dv._NODES_AT_ONCE = most
            pairs = dv.Pairs(rest, rest_2, False)
            pairs.add(one, two, width)
            a, b, value = pairs.values()
            assert np.array_equal(value.reshape(n_a, n_b), want) and len(a) == n_a * n_b
        own = dv.Pairs(rest, rest, True)
        own.add(one, one, width)
        a, b, value = own.values()
        want = ((p[:, None] - p[None]) ** 2 // (p[:, None] + p[None])).sum(2)
        assert np.array_equal(value, want[a, b]) and len(a) == n_a * (n_a - 1) // 2
    dv._NODES_AT_ONCE = 1 << 17
