"""Distinct pieces of texts: what a byte-level vocabulary encodes on its own, found without a loop over the text.

A piece ends where the pattern of such vocabularies cuts for certain, so a run
of texts is encoded by encoding each of its distinct pieces once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa

from .textscan import Run, mixed, power

LONGEST_KNOWN = 64

#: Kinds of characters as the pattern of a byte-level vocabulary has them; 0 is any other.
_LETTER, _DIGIT, _SIGN, _APOSTROPHE = 1, 2, 3, 4


def _kind_table() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[33:127] = _SIGN
    kind[48:58] = _DIGIT
    kind[65:91] = kind[97:123] = _LETTER
    kind[ord("'")] = _APOSTROPHE
    kind[0xC3] = _LETTER
    return kind


_KIND = _kind_table()


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of the character that each byte belongs to, and the kind of that character."""
    lead = data.copy()
    later = np.flatnonzero((data & 0xC0) == 0x80)
    for _ in range(3 if len(later) else 0):
        lead[later] = lead[later - 1]
    kind = _KIND[lead]
    # the signs of multiplication and division stand among the letters that begin with C3
    odd = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[odd] = kind[odd + 1] = 0
    return lead, kind


def certain_cuts(data: np.ndarray, only_spaces: bool) -> np.ndarray:
    """Bytes before which the pattern cuts for certain.

    It cuts before a space between two characters that are no white space
    (Unicode has white space below U+0021 and where UTF-8 begins with C2, E1,
    E2 or E3), and where letters, digits and signs of ASCII meet, but for a
    letter after an apostrophe. Strings of special tokens may hold such places,
    so where one occurs only spaces count.
    """
    lead, kind = _kinds(data)
    solid = ((lead > 32) & (lead < 127)) | ((lead > 0xC2) & ((lead < 0xE1) | (lead > 0xE3)))
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 32) & solid[:-2] & solid[2:]
    if not only_spaces:
        before, after = kind[:-1], kind[1:]
        cut[1:] |= (
            (before > 0) & (after > 0) & (before != after) & ((before < _SIGN) | (after < _SIGN))
            & ~((before == _APOSTROPHE) & (after == _LETTER))
        )
    return cut


def _steps(length: np.ndarray) -> np.ndarray:
    """0, 1, … of each span, one after the other."""
    return np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)


@dataclass
class Spans:
    """Pieces side by side: their bytes, where each begins, its length and a hash of it."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hashes: np.ndarray


def _bytes_of(pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of pieces that are not empty, where each begins, and its length."""
    _, where, body = pieces.buffers()
    edge = np.frombuffer(where, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    return np.frombuffer(body, np.uint8)[edge[0] : edge[-1]], edge[:-1] - edge[0], np.diff(edge)


def distinct(data: np.ndarray, start: np.ndarray) -> tuple[pa.LargeBinaryArray, Spans, np.ndarray]:
    """Distinct pieces of those that lie side by side over all of ``data``, and the place of every piece among them.

    Arrow tells pieces apart by their bytes; only the distinct ones are hashed.
    """
    edge = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
    whole = pa.Array.from_buffers(pa.large_binary(), len(start), [None, edge, pa.py_buffer(data)])
    coded = whole.dictionary_encode()
    body, begin, length = _bytes_of(coded.dictionary)
    # longer pieces are never kept, so their hash may be a poor one
    place = np.minimum(_steps(length), LONGEST_KNOWN)
    cells = (body.astype(np.uint64) + np.uint64(1)) * power(LONGEST_KNOWN + 1)[place]
    spans = Spans(body, begin, length, mixed(np.add.reduceat(cells, begin)))
    return coded.dictionary, spans, coded.indices.to_numpy()


def words_only(pieces: pa.LargeBinaryArray) -> np.ndarray:
    """Which pieces are Latin letters only, or a space and such letters."""
    body, start, length = _bytes_of(pieces)
    letter = _kinds(body)[1] == _LETTER
    letter[start] |= (body[start] == 32) & (length > 1)
    return np.logical_and.reduceat(letter, start)


class Known:
    """Ids of pieces met before: columns sorted by hash beside the pieces' bytes and ids.

    It forgets all where ``most`` pieces are reached; that costs time and changes no result.
    """

    def __init__(self, most: int):
        self.most = most
        self.hash = np.empty(0, np.uint64)
        self.length, self.at, self.n, self.to = (np.empty(0, np.int64) for _ in range(4))
        self.text, self.flat = np.empty(0, np.uint8), np.empty(0, np.int32)

    def find(self, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
        """Row of each distinct piece and whether it is there, byte for byte."""
        n = len(spans.start)
        if len(self.hash) == 0:
            return np.zeros(n, np.int64), np.zeros(n, bool)
        place, order = np.empty(n, np.int64), np.argsort(spans.hashes)
        place[order] = np.minimum(np.searchsorted(self.hash, spans.hashes[order]), len(self.hash) - 1)
        hit = (self.hash[place] == spans.hashes) & (self.length[place] == spans.length)
        own = np.flatnonzero(hit)
        if len(own):
            length = spans.length[own]
            step = _steps(length)
            same = (
                spans.data[np.repeat(spans.start[own], length) + step]
                == self.text[np.repeat(self.at[place[own]], length) + step]
            )
            hit[own] = np.logical_and.reduceat(same, np.cumsum(length) - length)
        return place, hit

    def add(self, spans: Spans, new: np.ndarray, n_new: np.ndarray, ids: np.ndarray) -> None:
        fit = spans.length[new] <= LONGEST_KNOWN
        if not fit.any():
            return
        if len(self.hash) + len(new) > self.most:
            self.__init__(self.most)
        own, begin = new[fit], (np.cumsum(n_new) - n_new)[fit]
        length, n = spans.length[own], n_new[fit]
        text = spans.data[np.repeat(spans.start[own], length) + _steps(length)]
        flat = ids[np.repeat(begin, n) + _steps(n)]
        columns = {
            "hash": spans.hashes[own], "length": length, "at": len(self.text) + np.cumsum(length) - length,
            "n": n, "to": len(self.flat) + np.cumsum(n) - n,
        }
        order = np.argsort(np.concatenate([self.hash, columns["hash"]]), kind="stable")
        for name, values in columns.items():
            setattr(self, name, np.concatenate([getattr(self, name), values])[order])
        self.text, self.flat = np.concatenate([self.text, text]), np.concatenate([self.flat, flat])


def encode_run(
    run: Run, in_pieces: bool, special: Sequence[bytes], known: Known,
    ids_of: Callable[[list[bytes], list[bool]], list[Sequence[int]]],
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a run in a row, and the number of ids of each text.

    ``ids_of`` gets pieces and whether each is a space and letters only, which
    is a single word; without ``in_pieces`` it gets whole texts.
    """
    data, n_rows = run.data, run.hi - run.lo
    if len(data) == 0:
        return np.empty(0, np.int64), np.zeros(n_rows, np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[run.offsets] = True
    if in_pieces:
        body = data.tobytes()
        first[:-1] |= certain_cuts(data, any(s in body for s in special))
    start = np.flatnonzero(first[:-1])
    pieces, spans, which = distinct(data, start)
    place, hit = known.find(spans)
    new = np.flatnonzero(~hit)
    found = []
    if len(new):
        unknown = pieces.take(pa.array(new))
        found = ids_of(unknown.to_pylist(), words_only(unknown).tolist() if in_pieces else [False] * len(new))
    n_new = np.fromiter(map(len, found), np.int64, len(found))
    new_flat = np.fromiter(chain.from_iterable(found), np.int32, int(n_new.sum()))
    size, begin = np.empty(len(hit), np.int64), np.empty(len(hit), np.int64)
    size[hit], begin[hit] = known.n[place[hit]], known.to[place[hit]]
    size[new], begin[new] = n_new, len(known.flat) + np.cumsum(n_new) - n_new
    flat = np.concatenate([known.flat, new_flat])
    known.add(spans, new, n_new, new_flat)
    each = size[which]
    stops = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(begin[which] - stops[:-1], each) + np.arange(int(stops[-1]))
    return flat[at], np.diff(stops[np.searchsorted(start, run.offsets)])
