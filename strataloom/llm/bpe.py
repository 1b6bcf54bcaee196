"""Byte-level BPE: encoding by a shared-prefix walk over distinct words, and decoding.

A text is cut into words by the vocabulary's pattern. The distinct words of a
run of texts, sorted as bytes, are the leaves of their trie in depth-first
order: what a word has in common with the one before is the path that both
share. Along the path one token is kept per prefix, the last token of that
prefix's encoding, so a shared prefix is worked out once. The last token of a
prefix is the token which ends it and which merging leaves beside the last
token of what comes before; there is exactly one. A word's ids are read off
from its end backwards.

Defined cases: a null or empty text has no ids and decodes to the empty text;
the strings of special tokens inside a text become their ids, as the library
does by default; bytes that are not UTF-8 decode to U+FFFD. Repeated rows stay
repeated and an empty table gives an empty one. Columns of the input named like
a result column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .pieces import Known, encode_run
from .textscan import Run, runs

#: The arrays of a run take some fifty times its bytes.
RUN_BYTES = 1 << 19
KNOWN_PIECES = 500_000
KNOWN_PAIRS = 200_000
#: Fixed value: how byte-level vocabularies of this kind cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Coder:
    """One vocabulary. Its memory of words and pairs is bounded and only saves time."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("a byte-level BPE vocabulary without a prefix space is needed")
        if not before.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("normalizers, other patterns and ignored merges are not supported")
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in word): i for word, i in model["vocab"].items()}
        self.longest = max(map(len, self.ids))
        pairs = (tuple(p) if not isinstance(p, str) else tuple(p.split(" ")) for p in model["merges"])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = model["vocab"][a], model["vocab"][b]
            token = model["vocab"][a + b]
            self.merges.setdefault((left, right), (rank, token))
            self.parts.setdefault(token, (rank, left, right))
        self.ranks = {p: rank for p, (rank, _) in self.merges.items()}
        self.edge_of: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.special = {}
        for t in spec.get("added_tokens") or []:
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or " " in t["content"]:
                raise ValueError("special tokens with conditions are not supported")
            self.special[t["content"]] = t["id"]
        by_length = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self.words_of = regex.compile(PATTERN).findall
        self.bytes_of = {i: w for w, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.marks = [m.encode() for m in self.special]
        self.known = Known(KNOWN_PIECES)
        self.pairs: dict[int, bool] = {}

    def edges(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of ``token`` while it is merged, the last one first.

        Beside each is the rank of the merge that ends its time there.
        """
        held = self.edge_of.get((token, side))
        if held is None:
            held, ends = [(token, len(self.merges))], self.parts.get(token)
            while ends is not None:
                token = ends[1 + side]
                held.append((token, ends[0]))
                ends = self.parts.get(token)
            self.edge_of[(held[0][0], side)] = held
        return held

    def stand(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens side by side.

        It does unless some merge joins what stands at both edges at its time.
        Of equal ranks the leftmost goes first: before one inside ``right``,
        after one inside ``left``.
        """
        ranks = self.ranks
        for x, until in self.edges(left, 1):
            for y, till in self.edges(right, 0):
                rank = ranks.get((x, y))
                if rank is not None and rank < until and rank <= till:
                    return False
        return True

    def walk(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """Ids of distinct words, in depth-first order of their trie."""
        token_of, pairs, longest, size = self.ids.get, self.pairs, self.longest, self.bytes_of
        if len(pairs) > KNOWN_PAIRS:
            pairs.clear()
        last: list[int] = [-1]
        path = b""
        for word in sorted(words):
            shared, top = 0, min(len(path), len(word))
            while shared < top and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for begin in range(end - longest if end > longest else 0, end):
                    token = token_of(word[begin:end])
                    if token is None:
                        continue
                    if begin:
                        key = last[begin] << 32 | token
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = self.stand(last[begin], token)
                        if not fits:
                            continue
                    last.append(token)
                    break
            path, found, at = word, [], len(word)
            while at:
                found.append(last[at])
                at -= len(size[last[at]])
            found.reverse()
            yield word, tuple(found)

    def cut_words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.cut is None or not self.cut.search(text):
            return self.words_of(text)
        parts = self.cut.split(text)
        return list(chain.from_iterable([p] if k % 2 else self.words_of(p) for k, p in enumerate(parts)))

    def ids_of(self, pieces: list[bytes], words: list[bool]) -> list[tuple[int, ...]]:
        """Ids of each piece; all words of the pieces go down the trie together."""
        cut = [[p.decode()] if word else self.cut_words(p.decode()) for p, word in zip(pieces, words, strict=True)]
        new = set().union(*cut).difference(self.special)
        known = {s: (i,) for s, i in self.special.items()}
        known |= {word.decode(): ids for word, ids in self.walk(w.encode() for w in new)}
        return [known[c[0]] if len(c) == 1 else tuple(chain.from_iterable(known[w] for w in c)) for c in cut]

    def encode_run(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts in a row, and the number of ids of each text."""
        return encode_run(run, True, self.marks, self.known, self.ids_of)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are at hand."""
        batch = pa.record_batch({"text": pa.array(texts, pa.string())})
        done = [self.encode_run(run) for run in runs(batch, size=RUN_BYTES)]
        return tuple(np.concatenate([d[k] for d in done]) for k in (0, 1)) if done else (np.empty(0, np.int64),) * 2


_coders: dict[str, Coder] = {}


def coder_of(raw: bytes) -> Coder:
    """The vocabulary, read once per process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _coders:
        _coders[key] = Coder(raw)
    return _coders[key]


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def token_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Length of each id's bytes, and all of them in the order of ids; read once per process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _tables:
        spec, letters = json.loads(raw), byte_letters()
        table = {i: bytes(letters[c] for c in word) for word, i in spec["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or []}
        held = [table.get(i, b"") for i in range(max(table) + 1)]
        _tables[key] = np.array([len(w) for w in held], np.int64), np.frombuffer(b"".join(held), np.uint8)
    return _tables[key]


def _out(docs: DataFrame, name: str, gone: set[str], kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in docs.schema.fields if f.name not in gone] + [T.StructField(name, kind)])


def _with(batch: pa.RecordBatch, name: str, gone: set[str], values: pa.Array) -> pa.RecordBatch:
    kept = [k for k, n in enumerate(batch.schema.names) if n not in gone]
    return pa.RecordBatch.from_arrays(
        [batch.column(k) for k in kept] + [values], names=[batch.schema.names[k] for k in kept] + [name]
    )


def encode(
    docs: DataFrame, path: str, column: str = "text", name: str = "ids", keep_text: bool = True
) -> DataFrame:
    """All rows with the ids of ``column`` as an array. The file at ``path`` is read by the driver."""
    gone = {name} if keep_text else {name, column}
    with open(path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def task(batches):
        coder = coder_of(held.value)
        for batch in batches:
            for run in runs(batch, column, RUN_BYTES):
                flat, counts = coder.encode_run(run)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
                yield _with(batch.slice(run.lo, run.hi - run.lo), name, gone, ids)

    return docs.mapInArrow(task, _out(docs, name, gone, T.ArrayType(T.IntegerType())))


def decode(coded: DataFrame, path: str, column: str = "ids", name: str = "decoded") -> DataFrame:
    """All rows with the text that the ids of ``column`` stand for."""
    with open(path, "rb") as f:
        held = coded.sparkSession.sparkContext.broadcast(f.read())

    def task(batches):
        size, body = token_bytes(held.value)
        begin = np.cumsum(size) - size
        for batch in batches:
            n = len(batch)
            ids = batch.column(batch.schema.get_field_index(column)).fill_null([])
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            counts = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            lo = 0
            while lo < n:
                hi = int(np.searchsorted(ends, ends[lo] + RUN_BYTES // 4, side="right")) - 1
                hi = min(max(hi, lo + 1), n)
                own = flat[ends[lo] : ends[hi]]
                length = size[own]
                place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                data = body[np.repeat(begin[own], length) + place].tobytes()
                stops = np.concatenate([[0], np.cumsum(length)])[ends[lo : hi + 1] - ends[lo]]
                texts = [
                    data[a:b].decode("utf-8", "replace") for a, b in zip(stops[:-1], stops[1:], strict=True)
                ]
                yield _with(batch.slice(lo, hi - lo), name, {name}, pa.array(texts, pa.string()))
                lo = hi

    return coded.mapInArrow(task, _out(coded, name, {name}, T.StringType()))
