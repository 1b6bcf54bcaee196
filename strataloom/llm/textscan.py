"""Vectorised scanning of text columns inside Arrow tasks.

A batch is cut into runs of whole rows of about a megabyte, so the temporary
arrays stay small whatever the row count of a batch; a longer text makes a run
of its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)


@dataclass
class Run:
    """Rows lo..hi of a batch: their UTF-8 bytes and where each text begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


@dataclass
class Words:
    """Words of a run: first byte, end, and row within the run."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def runs(batch: pa.RecordBatch, column: str = "text", size: int = RUN_BYTES) -> Iterator[Run]:
    texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if n == 0:
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield Run(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32)


def words(run: Run) -> Words:
    """Words are runs of code points other than space and U+0009 to U+000D."""
    b = run.data
    if len(b) == 0:
        none = np.empty(0, np.int64)
        return Words(none, none, none)
    inside = np.ones(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((b == 32) | ((b >= 9) & (b <= 13)))
    first = np.zeros(len(b) + 1, bool)
    first[run.offsets] = True
    mid = inside[1:-1]
    start = np.flatnonzero(mid & (~inside[:-2] | first[:-1]))
    end = np.flatnonzero(mid & (~inside[2:] | first[1:])) + 1
    return Words(start, end, np.searchsorted(run.offsets, start, side="right") - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def power(longest: int) -> np.ndarray:
    """Factors of the places of a span, at least ``longest`` of them."""
    global _powers
    if len(_powers) < longest:
        steps = np.full(max(longest, 1024), np.uint64(_STEP))
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and do not overlap."""
    if len(start) == 0:
        return np.empty(0, np.uint64)
    length = end - start
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    at = place + np.repeat(start, length)
    cells = (data[at].astype(np.uint64) + np.uint64(1)) * power(int(length.max()))[place]
    return mixed(np.add.reduceat(cells, np.cumsum(length) - length))


def spread(seed: int) -> np.uint64:
    return mixed(np.array([(seed + 1) * _STEP & (2**64 - 1)], np.uint64))[0]


def window_hash(h: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` neighbouring values of one row, and where each window begins."""
    if len(h) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    whole = np.flatnonzero(row[: len(row) - width + 1] == row[width - 1 :])
    out = np.zeros(len(whole), np.uint64)
    for k in range(width):
        out = out * np.uint64(_STEP) + h[whole + k]
    return mixed(out), whole


def per_row(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=n)


def code_points(data: np.ndarray) -> np.ndarray:
    """True where a code point begins."""
    return (data & 0xC0) != 0x80
