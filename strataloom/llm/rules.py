"""Quality rules: how far a document's letters and common words are from those of a language.

References are made of all documents with a language: for each language, however
many there are, a histogram of character classes and one of words hashed
into a fixed number of cells. The ``common`` fullest cells of a language hold
its common words, all others together are one more cell. A document is compared
with every reference by the Jensen-Shannon distance (base 2, 0 to 1); the
language with the smallest sum of both distances counts. Short documents are
not judged: below ``min_chars`` code points the classes, below ``min_words``
words the words, since few draws are far from any distribution.

Base rules come first: fewer than 50 words, or more than half of the words in
triples that occur twice or more.

Defined cases: a null or empty text has no words and fails the base rules; with
no language known nothing is far; documents without a language make no
reference but are judged; repeated rows count as often as they are there.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textscan import Run, Words, code_points, hash_spans, lowered, mixed, runs, window_hash, words

MIN_WORDS = 50
REPEATED = 0.5
WIDTH = 3
CELLS = 1 << 14
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
#: small letters, capitals, digits, white space, points and commas, exclamations, symbols, other, beyond ASCII
CLASSES = 9


def _class_table() -> np.ndarray:
    table = np.full(256, 7, np.int64)
    for k, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r", b".,;:", b"!?")):
        table[np.frombuffer(members, np.uint8)] = k
    table[SYMBOLS] = 6
    table[128:] = 8
    return table


CLASS_OF = _class_table()


@dataclass
class Scan:
    """What is counted in a run: base values of each row, class histogram, word cells and their rows."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray
    cell: np.ndarray
    row: np.ndarray


def duplicates(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values with the row they belong to: whether another of the row is equal, and whether an earlier one is."""
    own = mixed(h ^ mixed(row.astype(np.uint64) + np.uint64(1)))
    _, first, back, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(h), bool)
    later[first] = False
    return times[back] > 1, later


def histograms(run: Run, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Class histogram of each row, and the cell of each word."""
    n, b = run.hi - run.lo, run.data
    owner = np.repeat(np.arange(n), np.diff(run.offsets))
    lead = code_points(b)
    classes = np.bincount((owner * CLASSES + CLASS_OF[b])[lead], minlength=n * CLASSES).reshape(n, CLASSES)
    return classes, (hash_spans(lowered(b), w.start, w.end) % np.uint64(CELLS)).astype(np.int64)


def scan(run: Run) -> Scan:
    n, b = run.hi - run.lo, run.data
    w = words(run)
    upto = np.concatenate([[0], np.cumsum(code_points(b))])
    owner = np.repeat(np.arange(n), np.diff(run.offsets))
    return Scan(
        np.bincount(w.row, minlength=n),
        np.bincount(w.row, weights=upto[w.end] - upto[w.start], minlength=n).astype(np.int64),
        np.bincount(owner[SYMBOLS[b]], minlength=n),
        _dup_lines(run, w.start, n),
        _repeated(hash_spans(b, w.start, w.end), w.row, n),
        *histograms(run, w),
        w.row,
    )


def _dup_lines(run: Run, word_start: np.ndarray, n: int) -> np.ndarray:
    b = run.data
    begins = np.zeros(len(b) + 1, bool)
    begins[run.offsets] = True
    breaks = np.flatnonzero(b == 10)
    begins[breaks + 1] = True
    start = np.flatnonzero(begins[: len(b)])
    if len(start) == 0:
        return np.zeros(n, np.int64)
    end = np.append(start[1:], len(b))
    end = end - (b[end - 1] == 10)
    filled = np.searchsorted(word_start, end) > np.searchsorted(word_start, start)
    start, end = start[filled], end[filled]
    row = np.searchsorted(run.offsets, start, side="right") - 1
    if len(start) == 0:
        return np.zeros(n, np.int64)
    _, later = duplicates(hash_spans(b, start, end), row)
    return np.bincount(row[later], minlength=n)


def _repeated(word: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    triple, where = window_hash(word, row, WIDTH)
    if len(triple) == 0:
        return np.zeros(n, np.int64)
    twice, _ = duplicates(triple, row[where])
    inside = np.zeros(len(word), bool)
    for k in range(WIDTH):
        inside[where[twice] + k] = True
    return np.bincount(row[inside], minlength=n)


@dataclass
class References:
    languages: list[str]
    classes: np.ndarray
    cells: np.ndarray
    words: np.ndarray

    def cell_of(self, k: int) -> np.ndarray:
        """Place of each cell among the common words of a language; all others share the last."""
        out = np.full(CELLS, self.cells.shape[1])
        out[self.cells[k]] = np.arange(self.cells.shape[1])
        return out


def references(docs: DataFrame, languages: int = 200, common: int = 64) -> References:
    """Histograms of every language over all its documents; a task holds at most ``languages`` of them at a time."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    place = {x: k for k, x in enumerate(names)}

    def packed(sums):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["lang", "sums"],
        )

    def gather(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.array([place.get(x, -1) for x in batch.column(1).to_pylist()], np.int64)
            for run in runs(batch):
                w, own = words(run), at[run.lo : run.hi]
                classes, cell = histograms(run, w)
                for k in set(own.tolist()) - {-1}:
                    if k not in sums and len(sums) >= languages:
                        yield packed(sums)
                        sums = {}
                    held = sums.setdefault(k, np.zeros(CLASSES + CELLS, np.int64))
                    held[:CLASSES] += classes[own == k].sum(axis=0)
                    held[CLASSES:] += np.bincount(cell[own[w.row] == k], minlength=CELLS)
        if sums:
            yield packed(sums)

    def reference(k, counts):
        """One row of a size that depends on ``common`` alone."""
        cells = counts[CLASSES:]
        full = np.argsort(-cells, kind="stable")[:common]
        words = np.append(cells[full], cells.sum() - cells[full].sum()) / max(1, cells.sum())
        values = [v.tobytes() for v in (counts[:CLASSES] / max(1, counts[:CLASSES].sum()), full.astype(np.int64), words)]
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), *[pa.array([v], pa.binary()) for v in values]], names=["lang", "classes", "cells", "words"]
        )

    def add(batches):
        """Languages come one after another."""
        at, sums = None, None
        for batch in batches:
            for i in range(len(batch)):
                k, v = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_py(), np.int64)
                if k != at:
                    if at is not None:
                        yield reference(at, sums)
                    at, sums = k, np.zeros(CLASSES + CELLS, np.int64)
                sums += v
        if at is not None:
            yield reference(at, sums)

    parts = known.select("text", "lang").mapInArrow(gather, "lang int, sums binary")
    parts = parts.repartition("lang").sortWithinPartitions("lang")
    found = parts.mapInArrow(add, "lang int, classes binary, cells binary, words binary").collect()
    out = References(names, np.zeros((len(names), CLASSES)), np.zeros((len(names), common), np.int64), np.zeros((len(names), common + 1)))
    for r in found:
        k = r["lang"]
        out.classes[k], out.words[k] = (np.frombuffer(r[c], np.float64) for c in ("classes", "words"))
        out.cells[k] = np.frombuffer(r["cells"], np.int64)
    return out


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence of each row to the reference; 1 for a row of zeros."""
    total = counts.sum(axis=1, keepdims=True)
    p, q = counts / np.maximum(total, 1), np.broadcast_to(reference, counts.shape)
    m = (p + q) / 2

    def part(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)

    return np.where(total[:, 0] > 0, np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1)), 1.0)


def distances(s: Scan, ref: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and word distance to the nearest language, and which one that is (-1 without any)."""
    n = len(s.n_words)
    best = np.full(n, np.inf)
    near, far = np.zeros(n), np.zeros(n)
    which = np.full(n, -1)
    width = ref.words.shape[1]
    for k in range(len(ref.languages)):
        counts = np.bincount(s.row * width + ref.cell_of(k)[s.cell], minlength=n * width).reshape(n, width)
        a, b = js_distance(s.classes, ref.classes[k]), js_distance(counts, ref.words[k])
        better = a + b < best
        best[better], near[better], far[better], which[better] = (a + b)[better], a[better], b[better], k
    return near, far, which


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame,
    ref: References,
    class_limit: float = 0.3,
    word_limit: float = 0.45,
    min_chars: int = 100,
    min_words: int = 80,
) -> DataFrame:
    """All rows with the base values, base_failed, class_distance, word_distance, nearest and kept."""
    added = [T.StructField(c, T.LongType()) for c in _BASE] + [
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("class_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()),
        T.StructField("nearest", T.StringType()),
        T.StructField("kept", T.BooleanType()),
    ]
    names = [f.name for f in added]
    own = [f for f in docs.schema.fields if f.name not in names]
    held = docs.sparkSession.sparkContext.broadcast(ref)

    def task(batches):
        r = held.value
        for batch in batches:
            for run in runs(batch):
                part = batch.slice(run.lo, run.hi - run.lo)
                s = scan(run)
                near, far, which = distances(s, r)
                failed = (s.n_words < MIN_WORDS) | (s.n_repeat_words > REPEATED * s.n_words)
                odd = (s.classes.sum(axis=1) >= min_chars) & (near > class_limit)
                odd |= (s.n_words >= min_words) & (far > word_limit)
                said = [r.languages[k] if k >= 0 else None for k in which]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in own]
                    + [pa.array(getattr(s, c).astype(np.int64)) for c in _BASE]
                    + [pa.array(failed), pa.array(near), pa.array(far), pa.array(said, pa.string()), pa.array(~failed & ~odd)],
                    names=[f.name for f in own] + names,
                )

    return docs.mapInArrow(task, T.StructType(own + added))
