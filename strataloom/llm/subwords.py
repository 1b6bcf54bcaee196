"""Hashed byte n-grams inside words, and a linear softmax over their averaged embeddings.

Texts are lower-cased (A-Z), white space counts as one mark, and every text has
a mark at either end. An n-gram may begin or end with a mark but holds none
inside, so it never crosses words. All sizes share one table of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .textscan import Run, lowered, runs, spread


#: A run's n-grams of all sizes are held at once, 32 bytes and more to a byte of text.
RUN_BYTES = 1 << 18


@dataclass(frozen=True)
class Grams:
    sizes: tuple[int, ...]
    bits: int
    #: n-grams without weight that every text gets beside its own, so that few n-grams say little
    blanks: int = 0

    def of(self, run: Run) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each size: bucket of the n-gram at each place, whether it counts, and where each row begins."""
        lens = np.diff(run.offsets)
        begin = run.offsets[:-1] + np.arange(len(lens))
        b = np.full(len(run.data) + len(lens) + 1, 32, np.uint8)
        b[np.arange(len(run.data)) + np.repeat(np.arange(1, len(lens) + 1), lens)] = lowered(run.data)
        gap = (b == 32) | ((b >= 9) & (b <= 13))
        b[gap] = 32
        gaps = np.cumsum(gap)
        wide = b.astype(np.uint64) + np.uint64(1)
        h = np.zeros(len(b), np.uint64)
        done = 0
        for size in sorted(self.sizes):
            while done < size:
                h = h[: len(b) - done] * np.uint64(0x9E3779B97F4A7C15) + wide[done:]
                done += 1
            bucket = ((h * spread(size)) >> np.uint64(64 - self.bits)).astype(np.int32)
            last = np.arange(len(bucket)) + size - 1
            counts = gaps[last - 1] == gaps[: len(bucket)] if size > 1 else ~gap
            yield bucket, counts, np.minimum(begin, max(len(bucket) - 1, 0))

    def histograms(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Buckets and their shares of each text."""
        out = []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for run in runs(batch, "text", RUN_BYTES):
            n = run.hi - run.lo
            cells = []
            for bucket, counts, begin in self.of(run):
                if len(bucket):
                    row = np.searchsorted(begin, np.flatnonzero(counts), side="right") - 1
                    cells.append((row.astype(np.int64) << self.bits) | bucket[counts])
            found, times = np.unique(np.concatenate(cells or [np.empty(0, np.int64)]), return_counts=True)
            cut = np.searchsorted(found, np.arange(n + 1, dtype=np.int64) << self.bits)
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                share = times[lo:hi] / max(1, times[lo:hi].sum() + self.blanks)
                out.append(((found[lo:hi] & ((1 << self.bits) - 1)).astype(np.int32), share.astype(np.float32)))
        return out

    def means(self, run: Run, table: np.ndarray) -> np.ndarray:
        """Mean row of ``table`` (buckets x columns) over the n-grams of each text; 0 without any."""
        n, width = run.hi - run.lo, table.shape[1]
        sums, times = np.zeros((n, width)), np.zeros(n)
        step = max(1, (4 << 20) // width)
        for bucket, counts, begin in self.of(run):
            for lo in range(0, len(bucket), step):
                part, ok = bucket[lo : lo + step], counts[lo : lo + step]
                rows = np.unique(np.searchsorted(begin, [lo, lo + len(part) - 1], side="right") - 1)
                first, last = int(rows[0]), int(rows[-1])
                at = np.maximum(begin[first : last + 1] - lo, 0)
                values = table[part] * ok[:, None]
                sums[first : last + 1] += np.add.reduceat(values, at, axis=0)
                times[first : last + 1] += np.add.reduceat(ok.astype(np.float64), at)
        return sums / np.maximum(times + self.blanks, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    features: list[tuple[np.ndarray, np.ndarray]],
    classes: np.ndarray,
    n_classes: int,
    bits: int,
    dim: int,
    epochs: int,
    rate: float,
    scale: float,
    weights: np.ndarray | None = None,
    decay: float = 0.0,
    seed: int = 3,
    batch: int = 64,
) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax weights learnt together by stochastic gradient descent.

    Steps are scaled per weight by past gradients. Returns the product of both
    (what an n-gram adds to each class) and the bias.
    """
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, np.float32)
    seen = [np.full(a.shape, 1e-6, np.float32) for a in (emb, out, bias)]
    weight = np.ones(len(classes), np.float32) if weights is None else weights.astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(classes))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            used = np.unique(np.concatenate([features[i][0] for i in pick]))
            if not len(used):
                continue
            x = np.zeros((len(pick), len(used)), np.float32)
            for k, i in enumerate(pick):
                x[k, np.searchsorted(used, features[i][0])] = features[i][1] * scale
            own = emb[used]
            pooled = x @ own
            g = softmax(pooled @ out + bias).astype(np.float32)
            g[np.arange(len(pick)), classes[pick]] -= 1
            g *= weight[pick, None] / len(pick)
            grads = (x.T @ (g @ out.T) + decay * own, pooled.T @ g, g.sum(axis=0))
            seen[0][used] += grads[0] ** 2
            emb[used] -= step * grads[0] / np.sqrt(seen[0][used])
            for a, past, grad in ((out, seen[1], grads[1]), (bias, seen[2], grads[2])):
                past += grad**2
                a -= step * grad / np.sqrt(past)
    return emb @ out * scale, bias


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of the logits under which the true classes are likeliest."""
    if len(classes) == 0:
        return 1.0
    fits = np.geomspace(0.05, 20, 121)
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(classes)), classes], 1e-12)).mean() for t in fits]
    return float(fits[int(np.argmin(losses))])
