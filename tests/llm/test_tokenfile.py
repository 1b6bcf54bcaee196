"""Token files against the tokenizers library, exact round trips, and odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from strataloom.llm import tokenfile as tf
from strataloom.llm import pieces, textscan
from strataloom.llm.queries import QUERIES
from strataloom.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(rows, library):
    """rows: (doc_id, text) in the order of the files."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_files"](spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(sorted(rows), library))


ODD = [
    (3, None), (4, ""), (5, " "), (6, "a  b   c \n d\t e"), (7, "don't we'll  'S x 's"), (8, "né é é naïve élan"),
    (9, "<|endoftext|> a <|endoftext|>b  <|endoftext|>"), (10, "漢字 漢 字　空 🙂 🙂🙂 x y \u0085 z"),
    (11, "word " * 30_000), (12, "x" * 70_000), (13, " lead and trail "), (14, "a\x00 b \x7f c \x1c d"),
    (-5, "same"), (1 << 60, "high"), (15, "12 345  6,7 .8 !? -- é- -é"),
]


@pytest.mark.parametrize("file_ids", [1, 700, 1 << 22])
def test_odd_rows(spark, library, file_ids):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in ODD], "doc_id long, text string, content string, _start int")
    folder = scratch_path(spark, "odd")
    tf.write(docs.repartition(3), folder, PATH, file_ids=file_ids)
    got = tf.read(spark, folder).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(expected(sorted(ODD), library))
    for r in got:
        assert r["ids"] == [*library.encode(dict(ODD)[r["doc_id"]] or "", add_special_tokens=False).ids, 0]


def test_repeated_rows_and_rows_without_id(spark, library):
    rows = [(1, "one two")] * 40 + [(1, "three")] + [(None, "four")] * 5 + [(None, None)]
    folder = scratch_path(spark, "again")
    tf.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), folder, PATH, file_ids=8)
    got = sorted((tuple(r)[:4] for r in tf.read(spark, folder, keep_ids=False).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1] * 41 + [None] * 6
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    assert sorted(map(repr, (r[::2] for r in got))) == sorted(repr(r[::2]) for r in expected(rows, library))


def test_empty_table(spark):
    folder = scratch_path(spark, "none")
    tf.write(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert tf.read(spark, folder).count() == 0


def test_blocks_round_trip_and_random_access():
    rng = np.random.default_rng(7)
    kinds = [
        np.zeros(1000), rng.integers(0, 2**32, 3000), rng.integers(0, 50, 5000), np.full(257, 2**32 - 1),
        np.where(rng.random(20_000) < 0.04, rng.integers(0, 2**31, 20_000), rng.integers(1000, 1200, 20_000)), np.zeros(1), [],
    ]
    for ids in map(lambda k: np.asarray(k, np.uint32), kinds):
        content = tf.packed(ids, np.array([len(ids)]), np.array([4]), np.array([False])) + b"\n"
        one = tf.TokenFile(content)
        assert np.array_equal(one.ids_at(0, len(ids)), ids)
        for first, end in rng.integers(0, len(ids) + 300, (20, 2)):
            assert np.array_equal(one.ids_at(int(first), int(end)), ids[first:end])
    # four in a hundred are exceptions: about 8 bits and their patches instead of 31 bits
    assert len(tf.packed(np.asarray(kinds[4], np.uint32), np.array([1]), np.array([1]), np.array([False]))) < 1.5 * 20_000


def test_equal_hashes_do_not_mix_pieces(monkeypatch, library):
    import pyarrow as pa

    texts = ["the cat the dog the end", "dog cat", "", "tac the act"]
    monkeypatch.setattr(pieces, "mixed", lambda h: h & np.uint64(1))
    coder = tf.Encoder(open(PATH, "rb").read())
    batch = pa.record_batch({"text": pa.array(texts)})
    (run,) = textscan.runs(batch)
    flat, counts = coder.encode(run)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])


def test_other_vocabularies_get_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    coder = tf.Encoder(open(path, "rb").read())
    assert not coder.in_pieces
    import pyarrow as pa

    (run,) = textscan.runs(pa.record_batch({"text": pa.array(["Hello World  x", "y"])}))
    flat, counts = coder.encode(run)
    own = Tokenizer.from_file(path)
    assert flat.tolist() == own.encode("Hello World  x", add_special_tokens=False).ids + own.encode("y", add_special_tokens=False).ids


def plain_block(content, one, k):
    """Ids of one block by the description of the format, with Python's whole numbers."""
    low, width, patches, at = (int(c[k]) for c in (one.low, one.width, one.patches, one.begin))
    body = content[len(content) - len(one.body) + at :]
    bits = int.from_bytes(body[: 32 * width], "little")
    out = [bits >> width * i & (1 << width) - 1 for i in range(256)]
    for i in range(patches):
        value = 32 * width + patches + 4 * i
        out[body[32 * width + i]] = int.from_bytes(body[value : value + 4], "little")
    return [low + v for v in out]


@pytest.mark.parametrize("width", range(33))
def test_blocks_of_each_width_by_the_format(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 768)
    ids[:2] = 0, (1 << width) - 1
    ids[300:305] = (1 << 32) - 1
    content = tf.packed(ids.astype(np.uint32), np.array([len(ids)]), np.array([4]), np.array([False])) + b"\n"
    one = tf.TokenFile(content)
    assert sum((plain_block(content, one, k) for k in range(3)), []) == ids.tolist() == one.ids_at(0, 768).tolist()


def run_of(texts):
    import pyarrow as pa

    (run,) = textscan.runs(pa.record_batch({"text": pa.array(texts)}))
    return run


def test_only_distinct_pieces_are_hashed_and_looked_up(monkeypatch, library):
    """What is done for each piece of a run bounds the CPU seconds; it was hashed, sorted and compared."""
    sizes, mixed = [], pieces.mixed
    monkeypatch.setattr(pieces, "mixed", lambda h: sizes.append(len(h)) or mixed(h))
    coder = tf.Encoder(open(PATH, "rb").read())
    texts = ["the cat and the dog " * 500, "", "the dog " * 300]
    for _ in range(2):
        flat, counts = coder.encode(run_of(texts))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])
    assert max(sizes) < 20


def test_long_pieces_alike_at_first_do_not_mix(library):
    coder = tf.Encoder(open(PATH, "rb").read())
    for end in ["ab", "ba", "ab é×", "é", "×é 漢é", "ba"]:
        for texts in (["a " + "x" * 70 + end, " " + "x" * 63 + end], [" " + "x" * 70 + end[::-1]]):
            flat, counts = coder.encode(run_of(texts))
            want = [library.encode(t, add_special_tokens=False).ids for t in texts]
            assert counts.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])
