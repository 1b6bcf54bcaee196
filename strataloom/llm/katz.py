"""Katz back-off language model: Good-Turing discounts, exactly normalised back-off weights.

Tokens are lower-cased words and one end per text. A word is known by itself as
a context if it makes up at least ``share`` of all training tokens; there are
at most 1 / ``share`` such words, so what is kept per context is bounded
whatever the corpus. All other words share one class::

    P(w | h)   = d(c) c(h, x) / c(h)    where the pair was seen, x the class of w
               = a(h) P(x)              elsewhere
    P(w)       = d(c) c(w) / N, and what the discounts leave for all unseen words
    times P(w) / P(x) for a word that shares its class

a(h) is what the discounts leave of h divided by the unigram mass of the classes
not seen after h, so each context sums to 1. A context without discounted pairs
leaves one count more than it has; one that was followed by every class leaves
nothing. Where counts of counts give no discount between 0 and 1, absolute
discounting by n1 / (n1 + 2 n2) replaces them.

Counting: tasks sum their own tokens by hash (words) or number (pairs of
classes), packed by bucket; the buckets add up into two stored tables, one of
words and one of pairs. Scoring sends the words and pairs that are not among the
frequent ones to the bucket that has their counts, with the place of their text,
and adds up what comes back by text. A pair or word on this way is rarer than
``share``, so no bucket gets much more than another.

Defined cases: a null or empty text is one end token; without training texts
every token has probability 1 and base 0; rows without an id are scored and
teach nothing; repeated rows count, and are scored, as often as they are there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, shuffle_width
from .textscan import hash_spans, lowered, mixed, runs, words

#: Counts up to this are discounted.
TOP = 5
BLOCK_TOKENS = 2_000_000
_PACKED = "bucket int, kind int, block string, a binary, b binary, c binary, d binary"


@dataclass
class Block:
    """Tokens of whole texts: word hashes with the text they are in, and which texts teach."""

    word: np.ndarray
    row: np.ndarray
    teach: np.ndarray
    ids: pa.Array


def blocks(batches, tokens: int = BLOCK_TOKENS) -> Iterator[Block]:
    """Texts of a partition in blocks of about ``tokens`` tokens; columns are doc_id, text, teach."""
    parts, size, n = [], 0, 0

    def whole():
        return Block(
            np.concatenate([p[0] for p in parts]),
            np.concatenate([p[1] for p in parts]),
            np.concatenate([p[2] for p in parts]),
            pa.concat_arrays([p[3] for p in parts]),
        )

    for batch in batches:
        for run in runs(batch, "text"):
            w = words(run)
            h = hash_spans(lowered(run.data), w.start, w.end)
            part = batch.slice(run.lo, run.hi - run.lo)
            parts.append((h, w.row + n, part.column(2).to_numpy(zero_copy_only=False).astype(bool), part.column(0)))
            size, n = size + len(h), n + len(part)
            if size + n >= tokens:
                yield whole()
                parts, size, n = [], 0, 0
    if parts:
        yield whole()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["bucket", "kind", "block", "a", "b", "c", "d"]
    kinds = [pa.int32(), pa.int32(), pa.string()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names
    )


def _dealt(keys: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Bucket and the places in ``keys`` that go there, each in the order of keys."""
    to = ((mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[order], np.arange(buckets + 1))
    return [(k, order[cut[k] : cut[k + 1]]) for k in range(buckets) if cut[k] < cut[k + 1]]


def _count_rows(keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    found, times = np.unique(keys, return_counts=True)
    return _rows(
        [(k, 0, "", found[at].tobytes(), times[at].astype(np.int64).tobytes(), None, None) for k, at in _dealt(found, buckets)]
    )


def _summed(packed: DataFrame, label: str) -> DataFrame:
    """The counts of every bucket added up, as a stored table (bucket, a: keys, b: counts)."""

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for r in batch.select(["bucket", "a", "b"]).to_pylist():
                held.setdefault(r["bucket"], []).append((np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64)))
        for bucket, parts in held.items():
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, back, np.concatenate([p[1] for p in parts]))
            yield _rows([(bucket, 0, "", keys.tobytes(), total.tobytes(), None, None)])

    return pin(packed.repartition("bucket").mapInArrow(add, _PACKED), label)


def _folded(table: DataFrame, fold, schema: str) -> DataFrame:
    """``fold(keys, counts)`` of every stored bucket, as rows."""

    def task(batches):
        for batch in batches:
            for r in batch.select(["a", "b"]).to_pylist():
                yield fold(np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64))

    return table.mapInArrow(task, schema)


def count_stats(table: DataFrame) -> tuple[int, int, np.ndarray]:
    """Sum, number and counts of counts (0..TOP + 1) of a stored table."""
    names = [f"n{r}" for r in range(1, TOP + 2)]

    def fold(_, counts):
        n = np.bincount(np.minimum(counts, TOP + 2), minlength=TOP + 3)
        values = [int(counts.sum()), len(counts), *n[1 : TOP + 2].tolist()]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=["total", "types", *names])

    schema = ", ".join(f"{c} long" for c in ("total", "types", *names))
    row = _folded(table, fold, schema).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "types", *names)]).first()
    return row["total"], row["types"], np.array([0] + [row[c] for c in names], float)


def at_least(table: DataFrame, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, with a count of ``limit`` or more. There are at most total / limit."""

    def fold(keys, counts):
        big = counts >= limit
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[big].tobytes()], pa.binary()), pa.array([counts[big].tobytes()], pa.binary())], names=["a", "b"]
        )

    found = _folded(table, fold, "a binary, b binary").collect()
    keys = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in found] or [np.empty(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r["b"], np.int64) for r in found] or [np.empty(0, np.int64)])
    order = np.argsort(keys)
    return keys[order], counts[order]


#: Least steepness of the line through the counts of counts; any above one keeps the discounts between 0 and 1.
LEAST_FALL = 1.05


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discount of counts 0..TOP + 1 from counts of counts; the last stands for all larger counts.

    The counts of counts are smoothed as in simple Good-Turing: a line through
    their logarithms, n(r) = A r^-b. Then r* / r = (1 + 1/r)^(1 - b), and Katz's
    correction, with which counts above TOP stay as they are, needs no A. So the
    discounts are Good-Turing's for every corpus; where there are too few counts
    for a line, b is 2.
    """
    r = np.flatnonzero(np.asarray(n[1 : TOP + 2]) > 0) + 1
    fall = -np.polyfit(np.log(r), np.log(np.asarray(n, float)[r]), 1)[0] if len(r) > 1 else 2.0
    power = 1 - max(fall, LEAST_FALL)
    beyond = float(TOP + 1) ** power
    d = np.ones(TOP + 2)
    r = np.arange(1, TOP + 1)
    d[1:-1] = ((1 + 1 / r) ** power - beyond) / (1 - beyond)
    return d


@dataclass
class Unigrams:
    """Frequent words (hashes in order) and the probabilities of all classes.

    Classes: the frequent words in order, the shared class, the end, and the
    begin of a text, which is only ever a context.
    """

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    types: int
    texts: int
    discount: np.ndarray
    scale: float
    unseen: float
    mass: np.ndarray

    @property
    def shared(self) -> int:
        return len(self.hashes)

    @property
    def end(self) -> int:
        return len(self.hashes) + 1

    @property
    def begin(self) -> int:
        return len(self.hashes) + 2

    @property
    def width(self) -> int:
        return len(self.hashes) + 3

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Of words with these counts; that of all unseen words together for 0."""
        p = self.discount[np.minimum(counts, TOP + 1)] * counts * self.scale
        return np.where(counts > 0, p, self.unseen)

    def class_of(self, word: np.ndarray) -> np.ndarray:
        if len(self.hashes) == 0:
            return np.full(len(word), self.shared)
        at = np.minimum(np.searchsorted(self.hashes, word), len(self.hashes) - 1)
        return np.where(self.hashes[at] == word, at, self.shared)

    def pairs(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each word, then the number of each token's pair and the text it is in (ends come last)."""
        own, n = self.class_of(block.word), len(block.teach)
        before = np.full(len(own), self.begin)
        before[1:] = np.where(block.row[1:] == block.row[:-1], own[:-1], self.begin)
        last = np.full(n, self.begin)
        last[block.row] = own  # the last of equal places stays
        pair = np.concatenate([before * self.width + own, last * self.width + self.end])
        return own, pair.astype(np.uint64), np.concatenate([block.row, np.arange(n)])


def _unigrams(table: DataFrame, texts: int, share: float) -> Unigrams:
    total, types, n = count_stats(table)
    if texts:
        total, types = total + texts, types + 1
        if texts <= TOP + 1:
            n[texts] += 1
    hashes, counts = at_least(table, max(1.0, share * total))
    d = discounts(n)
    own = Unigrams(hashes, counts, total, types, texts, d, 1 / max(total, 1), 0.0, np.zeros(len(hashes) + 3))
    # mass of all seen words: discounted small counts and the whole of the others
    r = np.arange(TOP + 2)
    small = float((n * r)[1 : TOP + 1].sum())
    seen = ((n * r * d)[1 : TOP + 1].sum() + (total - small)) * own.scale
    own.unseen = 1 - seen
    if total and own.unseen < 1e-12:
        own.scale, own.unseen = 1 / (total + 1), 1 / (total + 1)
    own.mass[: own.shared] = own.probability(counts)
    if not texts:
        own.mass[:] = 1.0
        return own
    own.mass[own.end] = own.probability(np.array([texts]))[0]
    own.mass[own.shared] = max(1 - own.mass.sum(), 1e-300)
    return own


@dataclass
class Model:
    """What scoring needs: two stored tables, and arrays of bounded size."""

    words: DataFrame
    pairs: DataFrame
    unigrams: Unigrams
    discount: np.ndarray
    log_scale: np.ndarray
    log_back: np.ndarray
    frequent: np.ndarray
    frequent_counts: np.ndarray

    def held(self) -> Scorer:
        return Scorer(self.unigrams, self.discount, self.log_scale, self.log_back, self.frequent, self.frequent_counts)


@dataclass
class Scorer:
    """The part of a model that every task has."""

    unigrams: Unigrams
    discount: np.ndarray
    log_scale: np.ndarray
    log_back: np.ndarray
    frequent: np.ndarray
    frequent_counts: np.ndarray

    def pair_log(self, pair: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(class | context) of pairs with these counts."""
        context, token = np.divmod(pair.astype(np.int64), self.unigrams.width)
        with np.errstate(divide="ignore"):
            seen = np.log10(self.discount[np.minimum(counts, TOP + 1)] * counts) + self.log_scale[context]
            back = self.log_back[context] + np.log10(self.unigrams.mass[token])
        return np.where(counts > 0, seen, back)

    def word_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 of a word's share of the class it shares."""
        return np.log10(self.unigrams.probability(counts) / self.unigrams.mass[self.unigrams.shared])

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        u = self.unigrams
        return np.log10((counts + 0.1) / (u.total + 0.1 * (u.types + 1)))


def _contexts(pairs: DataFrame, own: Unigrams, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of what multiplies discounted counts, and of the back-off weight, for each context."""
    chunk = 4096
    held = pairs.sparkSession.sparkContext.broadcast((own.mass, d))

    def gather(batches):
        mass, discount = held.value
        width = len(mass)
        sums = np.zeros((3, width))
        for batch in batches:
            for r in batch.select(["a", "b"]).to_pylist():
                context, token = np.divmod(np.frombuffer(r["a"], np.uint64).astype(np.int64), width)
                counts = np.frombuffer(r["b"], np.int64)
                for k, v in enumerate((counts, discount[np.minimum(counts, TOP + 1)] * counts, mass[token])):
                    sums[k] += np.bincount(context, weights=v, minlength=width)
        rows = [(lo, sums[:, lo : lo + chunk].tobytes()) for lo in range(0, width, chunk) if sums[:, lo : lo + chunk].any()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["lo", "sums"]
            )

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[lo] = total.get(lo, 0) + np.frombuffer(sums, np.float64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                names=["lo", "sums"],
            )

    kind = "lo int, sums binary"
    count, left, mass = np.zeros((3, own.width))
    # three numbers for each of at most 1 / share + 3 contexts
    for r in pairs.mapInArrow(gather, kind).repartition("lo").mapInArrow(add, kind).collect():
        part = np.frombuffer(r["sums"], np.float64).reshape(3, -1)
        at = slice(r["lo"], r["lo"] + part.shape[1])
        count[at], left[at], mass[at] = part
    scale, back = np.ones(own.width), np.ones(own.width)
    known = count > 0
    rest = 1 - left / np.maximum(count, 1)
    open_ = np.maximum(1 - mass, 0)
    scale[known] = 1 / count[known]
    back[known] = rest[known] / np.maximum(open_[known], 1e-300)
    flat = known & (rest < 1e-12)
    scale[flat] = 1 / (count[flat] + 1)
    back[flat] = scale[flat] / np.maximum(open_[flat], 1e-300)
    full = known & (open_ < 1e-12)
    scale[full], back[full] = 1 / left[full], 1e-300
    return np.log10(scale), np.log10(back)


def _taught(docs: DataFrame, teach: Column) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce(teach, F.lit(False)).alias("teach"))


def _buckets(docs: DataFrame) -> int:
    return 4 * shuffle_width(docs.sparkSession)


def fit(docs: DataFrame, teach: Column, share: float = 1e-5) -> Model:
    """Count the texts where ``teach`` holds and work out discounts and back-off weights."""
    taught = _taught(docs, teach).filter("teach")
    buckets = _buckets(docs)

    def count_words(batches):
        for block in blocks(batches):
            if len(block.word):
                yield _count_rows(block.word, buckets)

    word_table = _summed(taught.mapInArrow(count_words, _PACKED), "words")
    own = _unigrams(word_table, taught.count(), share)
    held = docs.sparkSession.sparkContext.broadcast(own)

    def count_pairs(batches):
        for block in blocks(batches):
            yield _count_rows(held.value.pairs(block)[1], buckets)

    pair_table = _summed(taught.mapInArrow(count_pairs, _PACKED), "pairs")
    d = discounts(count_stats(pair_table)[2])
    scale, back = _contexts(pair_table, own, d)
    frequent, frequent_counts = at_least(pair_table, max(1.0, share * own.total))
    return Model(word_table, pair_table, own, d, scale, back, frequent, frequent_counts)


def _asked(keys: np.ndarray, row: np.ndarray, kind: int, name: str, buckets: int) -> list[tuple]:
    """Rows that ask for the counts of keys: distinct keys, how often each is there, and the texts."""
    if len(keys) == 0:
        return []
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.diff(np.append(first, len(keys)))
    out = []
    for k, at in _dealt(keys[first], buckets):
        n = times[at]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)
        out.append((k, kind, name, keys[first[at]].tobytes(), n.astype(np.uint32).tobytes(), row[place].astype(np.uint32).tobytes(), None))
    return out


_HEAD, _WORDS, _PAIRS = 0, 1, 2


def score(docs: DataFrame, teach: Column, model: Model) -> DataFrame:
    """doc_id, teach, n_tokens, n_known, base_score and score of every row."""
    buckets = _buckets(docs)
    held = docs.sparkSession.sparkContext.broadcast(model.held())
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = f"{_PACKED}, ids array<{kind}>"

    def ask(batches):
        m = held.value
        u = m.unigrams
        for number, block in enumerate(blocks(batches)):
            name = f"{TaskContext.get().partitionId()}-{number}"
            n = len(block.teach)
            own, pair, row = u.pairs(block)
            local = np.zeros((4, n))
            local[0] = np.bincount(block.row, minlength=n) + 1
            ends = np.array([u.texts])
            local[1] = float(u.texts > 0)
            local[2] = m.base_log(ends)[0]
            known = own < u.shared
            local[1] += np.bincount(block.row[known], minlength=n)
            local[2] += np.bincount(block.row[known], weights=m.base_log(u.counts)[own[known]], minlength=n)
            at = np.minimum(np.searchsorted(m.frequent, pair), max(len(m.frequent) - 1, 0))
            near = m.frequent[at] == pair if len(m.frequent) else np.zeros(len(pair), bool)
            if near.any():
                logs = m.pair_log(m.frequent, m.frequent_counts)
                local[3] += np.bincount(row[near], weights=logs[at[near]], minlength=n)
            rows = [(crc32(name.encode()) % buckets, _HEAD, name, local.tobytes(), block.teach.tobytes(), None, None)]
            rows += _asked(block.word[~known], block.row[~known], _WORDS, name, buckets)
            rows += _asked(pair[~near], row[~near], _PAIRS, name, buckets)
            out = _rows(rows)
            ids = pa.array([block.ids.to_pylist()] + [None] * (len(rows) - 1), pa.list_(block.ids.type))
            yield pa.RecordBatch.from_arrays([*out.columns, ids], names=[*out.schema.names, "ids"])

    def answer(batches):
        """Tables come first in their bucket, then what asks."""
        m = held.value
        bucket, tables = None, {}
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for k, r in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                if r["bucket"] != bucket:
                    bucket, tables = r["bucket"], {}
                if r["block"] == "":
                    tables[r["kind"]] = (np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64))
                    continue
                if r["kind"] == _HEAD:
                    out = [(0, _HEAD, r["block"], r["a"], r["b"], None, None)]
                    yield _with_ids(out, ids.slice(k, 1))
                    continue
                keys, times = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.uint32)
                texts = np.frombuffer(r["c"], np.uint32).astype(np.int64)
                counts = _looked_up(tables.get(r["kind"]), keys)
                each = np.repeat(np.arange(len(keys)), times)
                where, back = np.unique(texts, return_inverse=True)
                if r["kind"] == _PAIRS:
                    values = [np.zeros(len(keys)), np.zeros(len(keys)), m.pair_log(keys, counts)]
                else:
                    values = [(counts > 0).astype(float), m.base_log(counts), m.word_log(counts)]
                sums = np.stack([np.bincount(back, weights=v[each], minlength=len(where)) for v in values])
                out = [(0, r["kind"], r["block"], where.astype(np.uint32).tobytes(), sums.tobytes(), None, None)]
                yield _with_ids(out, pa.nulls(1, ids.type))

    def gather(batches):
        """Heads come first in their block, then the sums of its buckets."""
        block, ids, teach, local = None, None, None, None
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            for k, r in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                if r["block"] != block:
                    if block is not None:
                        yield _scored(ids, teach, local)
                    block, ids = r["block"], lists.slice(k, 1).flatten()
                    teach = np.frombuffer(r["b"], bool)
                    local = np.frombuffer(r["a"], np.float64).reshape(4, -1).copy()
                else:
                    where = np.frombuffer(r["a"], np.uint32).astype(np.int64)
                    local[1:, where] += np.frombuffer(r["b"], np.float64).reshape(3, -1)
        if block is not None:
            yield _scored(ids, teach, local)

    asked = _taught(docs, teach).mapInArrow(ask, packed)
    stored = [
        t.withColumn("kind", F.lit(k)).withColumn("ids", F.lit(None).cast(f"array<{kind}>"))
        for k, t in ((_WORDS, model.words), (_PAIRS, model.pairs))
    ]
    met = asked.unionByName(stored[0]).unionByName(stored[1]).repartition("bucket").sortWithinPartitions("bucket", "block")
    answered = met.mapInArrow(answer, packed)
    by_block = answered.repartition("block").sortWithinPartitions("block", "kind")
    result = f"doc_id {kind}, teach boolean, n_tokens long, n_known long, base_score double, score double"
    return by_block.mapInArrow(gather, result)


def _with_ids(rows: list[tuple], ids: pa.Array) -> pa.RecordBatch:
    out = _rows(rows)
    return pa.RecordBatch.from_arrays([*out.columns, ids], names=[*out.schema.names, "ids"])


def _looked_up(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> np.ndarray:
    if table is None or len(table[0]) == 0:
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], 0)


def _scored(ids: pa.Array, teach: np.ndarray, local: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(teach), pa.array(np.rint(local[0]).astype(np.int64)), pa.array(np.rint(local[1]).astype(np.int64)),
         pa.array(local[2]), pa.array(local[3])],
        names=["doc_id", "teach", "n_tokens", "n_known", "base_score", "score"],
    )
