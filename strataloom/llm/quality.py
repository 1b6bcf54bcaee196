"""Document quality: random-indexing word vectors, pooled, under a two-layer network.

Every word and every word shape (its classes of characters, runs collapsed) has
a sparse random index vector that follows from its hash. The vector of a word
is the sum of the index vectors of its neighbours over all documents; words are
hashed into a fixed number of buckets, so the table has one size whatever the
corpus. A document is the mean of the vectors of its words, the mean of those
of its shapes, its length and how much of it repeats. A network of two layers
in numpy, fitted on about ``per_class`` labelled documents of each label, gives
probabilities; a fifth of that sample sets their temperature.

Defined cases: a null or empty text pools to zeros and is scored as such; rows
without an id teach nothing; where labels of one kind are missing every score is
the share of label 1 (0.5 without any). Repeated rows get equal scores. Result
columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .labelled import labelled_texts
from .subwords import softmax, temperature
from .textscan import Run, Words, hash_spans, lowered, mixed, runs, window_hash, words

DIM = 64
WORD_ROWS = 1 << 14
SHAPE_ROWS = 1 << 10
ROWS = WORD_ROWS + SHAPE_ROWS
PART_ROWS = 256
REACH = 2
EXTRA = 3


def _classes() -> np.ndarray:
    """Byte to class: small and other letters a, capitals A, digits 0, the rest itself."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[128:] = ord("a")
    return table


CLASSES = _classes()


def shape_hashes(run: Run, w: Words) -> np.ndarray:
    """Hash of each word's classes without repeats of neighbours."""
    if len(w.start) == 0:
        return np.empty(0, np.uint64)
    kind = CLASSES[run.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[w.start] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return hash_spans(kind[keep], upto[w.start], upto[w.end])


def tokens(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, shape hashes and rows of a run."""
    w = words(run)
    return hash_spans(lowered(run.data), w.start, w.end), shape_hashes(run, w), w.row


def rows_of(word: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at_word = (word % np.uint64(WORD_ROWS)).astype(np.int64)
    return at_word, WORD_ROWS + (shape % np.uint64(SHAPE_ROWS)).astype(np.int64)


def _index(h: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """The two places of a hash's index vector that are not 0: +1 and -1."""
    g = mixed(h + np.uint64(77))
    up = (g & np.uint64(DIM - 1)).astype(np.int64)
    down = ((g >> np.uint64(20)) & np.uint64(DIM - 1)).astype(np.int64)
    return [(up, 1.0), (down, -1.0)]


def context_sums(run: Run) -> np.ndarray:
    """What a run adds to the table: index vectors of up to ``REACH`` neighbours on either side."""
    word, shape, row = tokens(run)
    out = np.zeros(ROWS * DIM)
    if len(word) < 2:
        return out
    centres = rows_of(word, shape)
    marks = _index(word) + _index(shape + np.uint64(1))
    cells = {1.0: [], -1.0: []}
    for d in range(1, REACH + 1):
        near = np.flatnonzero(row[d:] == row[:-d])
        for a, b in ((near, near + d), (near + d, near)):
            for place, sign in marks:
                for centre in centres:
                    cells[sign].append(centre[a] * DIM + place[b])
    for sign, parts in cells.items():
        out += sign * np.bincount(np.concatenate(parts), minlength=ROWS * DIM)
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table over all documents, rows of unit length. Its size does not depend on the corpus."""

    def gather(batches):
        total, seen = np.zeros(ROWS * DIM), False
        for batch in batches:
            for run in runs(batch, size=2 << 20):
                total += context_sums(run)
                seen = True
        if seen:
            parts = total.astype(np.float32).reshape(-1, PART_ROWS * DIM)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["part", "sums"],
            )

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.frombuffer(sums.as_buffer(), np.float32).astype(np.float64)
                held[part] = held[part] + got if part in held else got
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in held.values()])],
                names=["part", "sums"],
            )

    kind = "part int, sums binary"
    sums = docs.select("text").mapInArrow(gather, kind).repartition(ROWS // PART_ROWS, "part").mapInArrow(add, kind)
    table = np.zeros((ROWS, DIM), np.float32)
    # ROWS / PART_ROWS rows of PART_ROWS * DIM floats
    for r in sums.collect():
        table[r["part"] * PART_ROWS : (r["part"] + 1) * PART_ROWS] = np.frombuffer(r["sums"], np.float32).reshape(-1, DIM)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.maximum(length, 1e-9)


def pooled(run: Run, table: np.ndarray) -> np.ndarray:
    """One row per text: mean word vector, mean shape vector, log length, shares of repeated words and triples."""
    n = run.hi - run.lo
    word, shape, row = tokens(run)
    out = np.zeros((n, 2 * DIM + EXTRA), np.float32)
    if len(word) == 0:
        return out
    count = np.bincount(row, minlength=n)
    full = np.flatnonzero(count)
    first = np.searchsorted(row, full)
    per = np.maximum(count, 1)[:, None]
    step = 1 << 16
    sums = np.zeros((n, 2 * DIM), np.float64)
    for lo in range(0, len(word), step):
        part = row[lo : lo + step]
        here = full[np.searchsorted(full, part[0]) : np.searchsorted(full, part[-1]) + 1]
        at = np.maximum(first[np.searchsorted(full, here)] - lo, 0)
        for k, places in enumerate(rows_of(word[lo : lo + step], shape[lo : lo + step])):
            sums[here, k * DIM : (k + 1) * DIM] += np.add.reduceat(table[places], at, axis=0)
    out[:, : 2 * DIM] = sums / per
    triple, where = window_hash(word, row, 3)
    out[:, 2 * DIM] = np.log1p(count)
    for k, (h, r) in enumerate(((word, row), (triple, row[where]))):
        out[:, 2 * DIM + 1 + k] = repeats(h, r, n) / np.maximum(np.bincount(r, minlength=n), 1)
    return out


def repeats(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """How many values of each row equal an earlier one of that row."""
    if len(h) == 0:
        return np.zeros(n)
    own = mixed(h ^ mixed(row.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(own, return_index=True)
    return np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)


@dataclass
class Model:
    table: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    heat: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.centre) / self.spread @ w1 + b1, 0) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return softmax(self.logits(x).astype(np.float64) / self.heat)[:, 1]


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 11) -> list[np.ndarray]:
    """Two layers, trained by gradient descent with running moments."""
    rng = np.random.default_rng(seed)
    layers = [
        rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden),
        rng.normal(0, (2 / hidden) ** 0.5, (hidden, 2)), np.zeros(2),
    ]
    first = [np.zeros_like(a) for a in layers]
    second = [np.zeros_like(a) for a in layers]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 128):
            pick = order[lo : lo + 128]
            h = np.maximum(x[pick] @ layers[0] + layers[1], 0)
            g = softmax(h @ layers[2] + layers[3])
            g[np.arange(len(pick)), y[pick]] -= 1
            g /= len(pick)
            back = (g @ layers[2].T) * (h > 0)
            grads = [x[pick].T @ back + 1e-3 * layers[0], back.sum(0), h.T @ g + 1e-3 * layers[2], g.sum(0)]
            t += 1
            for a, m, v, d in zip(layers, first, second, grads, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                a -= 0.002 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return layers


def fit(docs: DataFrame, labels: DataFrame, teach: Column, label: str = "quality", per_class: int = 3000) -> Model:
    table = word_vectors(docs)
    held = docs.sparkSession.sparkContext.broadcast(table)

    def features(batches):
        for batch in batches:
            for run in runs(batch):
                x = pooled(run, held.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(run.lo, run.hi - run.lo), pa.array(list(x), pa.list_(pa.float32()))],
                    names=["y", "x"],
                )

    rows = labelled_texts(docs, labels, label, teach, per_class).mapInArrow(features, "y int, x array<float>").toArrow()
    y = np.array(rows.column("y").to_pylist(), np.int64)
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(len(y), 2 * DIM + EXTRA)
    if len(set(y.tolist())) < 2:
        return Model(table, np.zeros(1), np.ones(1), [], 1.0, float(y.mean()) if len(y) else 0.5)
    order = np.lexsort(np.column_stack([x, y]).T)
    x, y = x[order], y[order]
    test = np.arange(len(y)) % 5 == 4
    centre, spread = x[~test].mean(axis=0), x[~test].std(axis=0) + 1e-3
    layers = fit_network((x[~test] - centre) / spread, y[~test])
    model = Model(table, centre, spread, layers, 1.0)
    model.heat = temperature(model.logits(x[test]), y[test])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """All rows with score (probability of the label 1) and predicted (1 from ``threshold`` on)."""
    names = ["score", "predicted"]
    kept = [f for f in docs.schema.fields if f.name not in names]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = held.value
        for batch in batches:
            for run in runs(batch):
                part = batch.slice(run.lo, run.hi - run.lo)
                p = m.score(pooled(run, m.table))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    + [pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=[f.name for f in kept] + names,
                )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(task, T.StructType(kept + added))
