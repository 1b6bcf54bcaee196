"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from strataloom.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as f:
        return bpe.Coder(f.read())


def ids_of(coder, texts):
    flat, counts = coder.encode(texts)
    out, at = [], 0
    for n in counts:
        out.append(flat[at : at + n].tolist())
        at += n
    return out


def test_every_code_point(coder, library):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} " for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    for text, own, other in zip(texts, ids_of(coder, texts), library.encode_batch(texts, add_special_tokens=False)):
        assert own == other.ids, hex(ord(text[1]))


def test_random_texts(coder, library):
    rng = random.Random(5)
    letters = "abcdefgh ééßñ\n\t 0123456789.,!?-' 　漢字🙂=_()" + "etaoin" * 4
    texts = ["".join(rng.choices(letters, k=rng.randrange(400))) for _ in range(800)]
    texts += ["", None, " ", "-" * 700, "a" * 5000, "<|endoftext|>x<|endoftext|>", "I'll don't we've", " \n \n  x  "]
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert ids_of(coder, texts) == [w.ids for w in want]


def test_round_trip(spark, library):
    rows = [(1, "Hello  wörld 🙂 <|endoftext|>", "a"), (2, None, "b"), (2, "", "c"), (2, "", "c"), (None, "x" * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.decode(bpe.encode(docs, PATH), PATH)
    got = coded.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["decoded"] == (r["text"] or "")
        assert list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_bad_bytes_decode_to_the_replacement(spark, library):
    whole = library.encode("é🙂", add_special_tokens=False).ids
    for ids in (whole[:-1], whole[1:], [id for id in whole for _ in (0, 1)]):
        row = spark.createDataFrame([(ids,)], "ids array<int>")
        assert bpe.decode(row, PATH).first()["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_query(spark, library):
    from strataloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op7_bpe"](spark, folder).collect()
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
