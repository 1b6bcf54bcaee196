"""Token ids as binary files of patched frame-of-reference blocks, and reading them back.

``write`` sorts the documents by id into ranges, encodes each range with the
tokenizers library and writes it as binary files through Spark's own writer, so
a lost task leaves nothing behind. A file holds whole documents, about
``file_ids`` ids of them, and is complete in itself:

    4 bytes   the mark PFR1
    3 x 8     number of ids, of documents, of blocks
    documents id (8), 1 if there is none (1), number of ids (8)
    blocks    smallest id (4), width (1), number of exceptions (2), first byte (8)
    body      the blocks; a line feed ends the file

All numbers are little-endian and each of the columns above lies in one piece.
A block holds 256 ids. Each is stored as its distance from the smallest of the
block, in ``width`` bits, which is the width of one of the PERCENTILES of these
distances: the one that makes the block smallest. Distances that are wider go
to the list of exceptions after the packed bits, with their place (1 byte) and
their value (4 bytes). The table of first bytes leads to any block without
reading those before it (``ids_at``).

Texts are encoded in pieces, which end where the pattern of a byte-level
vocabulary cuts for certain, so each distinct piece of a run of texts goes
through the library once. Vocabularies of other kinds get whole texts.

Defined cases: a null or empty text has only the end id; documents without an
id come last; rows with one id are in the order of a hash of their text, and
rows that agree in both are alike in any order; very long texts stay whole, in
a file of their own if need be; an empty table gives files without documents
and an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import pin
from .bpe import byte_letters
from .pieces import Known, encode_run
from .textscan import Run, runs

MARK = b"PFR1"
BLOCK = 256
#: Shares of a block whose widest distance may set the width.
PERCENTILES = (0.9, 0.95, 0.98, 1.0)
FILE_IDS = 1 << 22
#: Bytes of one entry of the list of exceptions.
_PATCH = 5
_BLOCKS_AT_ONCE = 2048

RUN_BYTES = 4 << 20
KNOWN_PIECES = 1_000_000


# blocks


def _widths(far: np.ndarray) -> np.ndarray:
    """Bits of each number."""
    return np.frexp(far.astype(np.float64))[1].astype(np.int64)


def _holder(width: int) -> np.dtype:
    """The smallest whole number that has ``width`` bits."""
    return np.dtype("u1" if width <= 8 else "<u2" if width <= 16 else "<u4")


def _bits_of(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers as rows of bytes, ``width`` bits a number."""
    raw = values.astype(_holder(width)).view(np.uint8)
    if width == 8 * _holder(width).itemsize:
        return raw
    bits = np.unpackbits(raw.reshape(*values.shape, -1), axis=2, count=width, bitorder="little")
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _from_bits(raw: np.ndarray, width: int) -> np.ndarray:
    """The numbers of ``_bits_of``."""
    kind = _holder(width)
    if width < 8 * kind.itemsize:
        bits = np.zeros((len(raw), BLOCK, 8 * kind.itemsize), np.uint8)
        bits[:, :, :width] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(raw), BLOCK, width)
        raw = np.packbits(bits.reshape(len(raw), -1), axis=1, bitorder="little")
    return raw.view(kind)


def _pack_some(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smallest ids, widths, numbers of exceptions, sizes and bytes of some blocks."""
    low = blocks.min(1)
    far = blocks - low[:, None]
    order = np.sort(far, 1)
    best = width = patches = None
    for share in PERCENTILES:
        bits = _widths(order[:, int(np.ceil(share * BLOCK)) - 1])
        beyond = np.count_nonzero(far > ((1 << bits) - 1).astype(np.uint32)[:, None], axis=1)
        size = bits * (BLOCK // 8) + beyond * _PATCH
        if best is None:
            best, width, patches = size, bits, beyond
        else:
            better = size < best
            best, width, patches = (np.where(better, *x) for x in ((size, best), (bits, width), (beyond, patches)))
    size = best
    begin = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    beyond = far > ((1 << width) - 1).astype(np.uint32)[:, None]
    kept = np.where(beyond, np.uint32(0), far)
    for w in np.unique(width).tolist():
        if w:
            some = np.flatnonzero(width == w)
            for at, row in zip(begin[some].tolist(), _bits_of(kept[some], w), strict=True):
                body[at : at + len(row)] = row
    block, place = np.nonzero(beyond)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(patches) - patches)[block]
        at = begin[block] + width[block] * (BLOCK // 8)
        body[at + nth] = place
        value = far[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        body[(at + patches[block] + 4 * nth)[:, None] + np.arange(4)] = value
    return low, width, patches, size, body


def packed(ids: np.ndarray, counts: np.ndarray, doc_ids: np.ndarray, absent: np.ndarray) -> bytes:
    """One file: the ids of whole documents in a row."""
    n_blocks = -(-len(ids) // BLOCK)
    whole = np.zeros(n_blocks * BLOCK, np.uint32)
    whole[: len(ids)] = ids
    if len(ids):
        whole[len(ids) :] = ids[-1]
    whole = whole.reshape(-1, BLOCK)
    parts = [_pack_some(whole[k : k + _BLOCKS_AT_ONCE]) for k in range(0, n_blocks, _BLOCKS_AT_ONCE)]
    low, width, patches, size = (
        np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in range(4)
    )
    return b"".join(
        [
            MARK, struct.pack("<QQQ", len(ids), len(counts), n_blocks),
            doc_ids.astype("<i8").tobytes(), absent.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes(),
            low.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), patches.astype("<u2").tobytes(),
            (np.cumsum(size) - size).astype("<u8").tobytes(), *[p[4].tobytes() for p in parts],
        ]
    )


class TokenFile:
    """What lies in one file, read from its bytes."""

    def __init__(self, content: bytes):
        if content[:4] != MARK:
            raise ValueError("not a token file")
        self.n_ids, n_docs, self.n_blocks = struct.unpack_from("<QQQ", content, 4)
        at = 28

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.absent = column("<i8", n_docs), column("u1", n_docs).astype(bool)
        self.counts = column("<u8", n_docs).astype(np.int64)
        self.low = column("<u4", self.n_blocks)
        self.width = column("u1", self.n_blocks).astype(np.int64)
        self.patches = column("<u2", self.n_blocks).astype(np.int64)
        self.begin = column("<u8", self.n_blocks).astype(np.int64)
        self.body = np.frombuffer(content, np.uint8, offset=at)

    def _blocks(self, some: np.ndarray) -> np.ndarray:
        out = np.zeros((len(some), BLOCK), np.uint32)
        for w in np.unique(self.width[some]).tolist():
            if w:
                own = np.flatnonzero(self.width[some] == w)
                raw = np.empty((len(own), w * (BLOCK // 8)), np.uint8)
                for row, at in zip(raw, self.begin[some[own]].tolist(), strict=True):
                    row[:] = self.body[at : at + len(row)]
                out[own] = _from_bits(raw, w)
        patches = self.patches[some]
        block = np.repeat(np.arange(len(some)), patches)
        if len(block):
            nth = np.arange(len(block)) - np.repeat(np.cumsum(patches) - patches, patches)
            at = (self.begin[some] + self.width[some] * (BLOCK // 8))[block]
            value = self.body[(at + patches[block] + 4 * nth)[:, None] + np.arange(4)]
            out[block, self.body[at + nth]] = np.ascontiguousarray(value).view("<u4")[:, 0]
        return out + self.low[some][:, None]

    def ids_at(self, first: int, end: int) -> np.ndarray:
        """Ids first..end (exclusive); only the blocks that hold them are unpacked."""
        end = min(end, self.n_ids)
        if first >= end:
            return np.empty(0, np.uint32)
        lo, hi = first // BLOCK, -(-end // BLOCK)
        out = np.empty((hi - lo) * BLOCK, np.uint32)
        for k in range(lo, hi, _BLOCKS_AT_ONCE):
            some = np.arange(k, min(k + _BLOCKS_AT_ONCE, hi))
            out[(k - lo) * BLOCK : (some[-1] + 1 - lo) * BLOCK] = self._blocks(some).reshape(-1)
        return out[first - lo * BLOCK : end - lo * BLOCK]


# encoding


class Encoder:
    """The tokenizers library over runs of texts. Its memory of pieces is bounded and only saves time."""

    def __init__(self, raw: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(raw)
        before = spec.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        lone = all(
            " " not in t["content"] and not (t.get("single_word") or t.get("lstrip") or t.get("rstrip"))
            for t in spec.get("added_tokens") or []
        )
        self.in_pieces = bool(plain and lone and spec["model"]["type"] == "BPE" and not spec.get("normalizer"))
        self.special = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self.model = self.tokenizer.model
        self.letters = np.zeros(256, "<u4")
        for letter, byte in byte_letters().items():
            self.letters[byte] = ord(letter)
        self.known = Known(KNOWN_PIECES)

    def ids_of(self, pieces: list[bytes], words: list[bool]) -> list[tuple[int, ...]]:
        """Ids of each piece. Words go to the library's merges directly, as they would be cut as they are."""
        found: list[tuple[int, ...]] = [()] * len(pieces)
        own, rest = ([k for k, w in enumerate(words) if w is kind] for kind in (True, False))
        spelt = self.letters[np.frombuffer(b"".join([pieces[k] for k in own]), np.uint8)].tobytes().decode("utf-32-le")
        tokenize, at = self.model.tokenize, 0
        for k in own:
            end = at + len(pieces[k])
            found[k] = tuple([t.id for t in tokenize(spelt[at:end])])
            at = end
        if rest:
            done = self.tokenizer.encode_batch_fast([pieces[k].decode() for k in rest], add_special_tokens=False)
            for k, one in zip(rest, done, strict=True):
                found[k] = tuple(one.ids)
        return found

    def encode(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run in a row, and the number of ids of each text."""
        return encode_run(run, self.in_pieces, self.special, self.known, self.ids_of)


_encoders: dict[str, Encoder] = {}


def encoder_of(raw: bytes) -> Encoder:
    """The vocabulary, read once per process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(raw)
    return _encoders[key]


# files


def _files(batches: Iterator[pa.RecordBatch], coder: Encoder, end_id: int, file_ids: int) -> Iterator[bytes]:
    ids, counts, doc_ids, absent, held = [], [], [], [], 0

    def file() -> bytes:
        return packed(*(np.concatenate(x) for x in (ids, counts, doc_ids, absent)))

    for batch in batches:
        keys = batch.column(0)
        for run in runs(batch, size=RUN_BYTES):
            flat, count = coder.encode(run)
            stops = np.cumsum(count)
            own = keys.slice(run.lo, run.hi - run.lo)
            own_ids = own.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own_absent = own.is_null().to_numpy(zero_copy_only=False)
            flat = np.insert(flat, stops, end_id).astype(np.uint32)
            count = count + 1
            stops = np.cumsum(count)
            lo = 0
            while lo < len(count):
                hi = min(len(count), int(np.searchsorted(stops, (stops[lo - 1] if lo else 0) + file_ids - held)) + 1)
                ids.append(flat[stops[lo - 1] if lo else 0 : stops[hi - 1]])
                counts.append(count[lo:hi])
                doc_ids.append(own_ids[lo:hi])
                absent.append(own_absent[lo:hi])
                held += len(ids[-1])
                lo = hi
                if held >= file_ids:
                    yield file()
                    ids, counts, doc_ids, absent, held = [], [], [], [], 0
    if held:
        yield file()


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, file_ids: int = FILE_IDS) -> None:
    """Files of all documents (doc_id, text) in the order of their ids.

    The file at ``vocabulary`` is read by the driver. The ranges come from a
    sample of the ids, so their number follows the shuffle width and the sizes
    that adaptive execution sees; rows of one id are dealt out by text and place.
    """
    with open(vocabulary, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def task(batches):
        for content in _files(batches, encoder_of(held.value), end_id, file_ids):
            yield pa.record_batch({"content": pa.array([content], pa.binary())})

    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash"), F.col("_place")]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"),
    )
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    contents = ranges.mapInArrow(task, "content binary")
    # the text writer puts out the bytes as they are, and the line feed that ends a file
    contents.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", "\n"
    ).text(folder)


def _contents(spark: SparkSession, folder: str) -> DataFrame:
    """Files with their range and their number in it, from the names that Spark's writer gives."""
    name = F.element_at(F.split("path", "/"), -1)
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).filter("length > 0")
        .select(
            F.regexp_extract(name, r"^part-(\d+)-", 1).cast("bigint").alias("range"),
            F.regexp_extract(name, r"-c(\d+)\.", 1).cast("bigint").alias("file"),
            "content",
        )
    )


def read(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked, ids of every document in the files.

    ``start`` counts the ids of all documents before; the sums of the files,
    one row each, give it.
    """
    fields = "range bigint, file bigint, doc_id bigint, _start bigint, n_tokens bigint, ids_crc32 bigint"

    def task(batches):
        for batch in batches:
            for k in range(len(batch)):
                one = TokenFile(batch.column(2)[k].as_py())
                stops = np.cumsum(one.counts)
                lo, n = 0, len(stops)
                while lo < n:
                    begin = stops[lo - 1] if lo else 0
                    hi = min(n, max(lo + 1, int(np.searchsorted(stops, begin + (1 << 20), side="right"))))
                    ids = one.ids_at(int(begin), int(stops[hi - 1]))
                    edge = np.concatenate([[0], stops[lo:hi] - begin])
                    raw = memoryview(ids.astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    columns = [
                        pa.array([batch.column(0)[k].as_py()] * (hi - lo), pa.int64()),
                        pa.array([batch.column(1)[k].as_py()] * (hi - lo), pa.int64()),
                        pa.array(one.doc_ids[lo:hi], pa.int64(), mask=one.absent[lo:hi]),
                        pa.array(begin + edge[:-1], pa.int64()), pa.array(one.counts[lo:hi], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ]
                    names = ["range", "file", "doc_id", "_start", "n_tokens", "ids_crc32"]
                    if keep_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    lo = hi

    rows = pin(_contents(spark, folder).mapInArrow(task, fields + (", ids array<int>" if keep_ids else "")), "tokens")
    sums = rows.groupBy("range", "file").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("range", "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", "file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    out = rows.join(offsets, ["range", "file"]).withColumn("start", F.col("_before") + F.col("_start"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))
