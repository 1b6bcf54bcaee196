"""Identifiers written in several words are found and redacted whole."""

import random

from strataloom.llm import pii


def test_unseen_identifiers_of_several_words(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    unseen = [f"({d(3)}) 555-{d(4)}", f"{d(3)} 555 {d(4)}", " ".join(d(2) for _ in range(5))]
    rows = [(k, f"{some(9)} call me +1 ({d(3)}) 555-{d(4)}, {some(4)}") for k in range(60)]
    want = []
    for k, number in enumerate(unseen):
        left, right = f"{some(9)} call me ", f", {some(4)}"
        rows.append((100 + k, left + number + right))
        want.append((left, number, right))
    rows.append((200, "in 12 34 rooms of 1999 2000"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["added"]] for r in pii.spans(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    for k, (left, number, right) in enumerate(want):
        assert found[100 + k] == [(3, len(left), len(left) + len(number))], number
        assert clean[100 + k] == f"{left}[PHONE]{right}"
    assert clean[200] == rows[-1][1] and not any(found[k] for k in range(60))


def test_word_found_in_a_run_takes_the_run(spark):
    rows = [(k, f"my number here +1 (132) 555-{1000 + 7 * k} is new") for k in range(40)]
    rows.append((100, "w x y (415) 555-0199 z"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}[100] == "w x y [PHONE] z"
