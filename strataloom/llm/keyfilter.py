"""A Bloom filter over 64-bit keys, to leave rows where they are that an exact join would drop anyway.

Its size is bounded, so with many more keys it lets more rows through; none of its keys is ever refused.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .textscan import mixed, spread

#: Bits for a key, and bits in all (16 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 27
#: Bits that are put together in one task.
CHUNK = 1 << 20
_SEEDS = [spread(81), spread(82), spread(83)]


def _places(keys: np.ndarray, size: int) -> list[np.ndarray]:
    own = keys.astype(np.int64).view(np.uint64)
    return [(mixed(own ^ s) & np.uint64(size - 1)).astype(np.int64) for s in _SEEDS]


def key_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """A condition on a column of longs: false only where it is none of ``keys``, which has one such column."""
    spark = keys.sparkSession
    keys = pin(keys.toDF("key"), "keys")
    size = min(MOST_BITS, max(CHUNK, 1 << (BITS_PER_KEY * keys.count()).bit_length()))

    def place(batches):
        for batch in batches:
            if len(batch):
                at = np.unique(np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False), size)))
                chunk, first = np.unique(at // CHUNK, return_index=True)
                parts = [p.astype(np.int32).tobytes() for p in np.split(at % CHUNK, first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(chunk), pa.array(parts, pa.binary())], names=["chunk", "at"])

    def gather(batches):
        """The bits of one chunk after the other."""
        own, cells = None, np.zeros(CHUNK, bool)
        for batch in batches:
            for chunk, at in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own is not None and chunk != own:
                    yield packed(own, cells)
                    cells[:] = False
                own = chunk
                cells[np.frombuffer(at.as_py(), np.int32)] = True
        if own is not None:
            yield packed(own, cells)

    def packed(chunk, cells):
        columns = [pa.array([chunk], pa.int64()), pa.array([np.packbits(cells).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "at"])

    kind = "chunk long, at binary"
    bits = np.zeros(size // 8, np.uint8)
    met = keys.mapInArrow(place, kind).repartition("chunk").sortWithinPartitions("chunk")
    for r in met.mapInArrow(gather, kind).collect():
        lo = r["chunk"] * CHUNK // 8
        bits[lo : lo + CHUNK // 8] = np.frombuffer(r["at"], np.uint8)
    held = spark.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def among(x: pa.Array) -> pa.Array:
        own, found = held.value, np.ones(len(x), bool)
        for at in _places(x.to_numpy(zero_copy_only=False), size):
            found &= (own[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return pa.array(found)

    return among
