"""Katz back-off bigrams over all words: nothing is folded, whatever the size of the corpus.

As ``katz``, but every word of the training texts has its own pairs, as a context
and as the word that follows::

    P(w | h) = d(c) c(h, w) / c(h)    where the pair was seen
             = a(h) P(w)              elsewhere
    P(w)     = d(c) c(w) / N, and what the discounts leave for all unseen words

``share`` changes no result: it only decides which words and pairs (at most
1 / ``share`` of each) are answered from a broadcast.

Counts are in buckets. A pair goes to the bucket of its second word, or, where
that is among the frequent words, to one chosen by the pair, so its unigram
count is at hand and no bucket gets much more than another. For each context the
discounted counts and the unigram mass of what was seen after it are summed
(frequent contexts in the tasks, others in the bucket of the context) and its
a(h) is kept beside its count. A text's score is a sum that needs no join of
tokens: log P(w) of all words, log a(h) of all contexts, and for each pair that
was seen the difference log P(w | h) - log a(h) - log P(w).

Words and pairs are told apart by 64-bit hashes. Defined cases are those of ``katz``.
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

from ..session import pin
from .katz import (
    _PACKED,
    TOP,
    Block,
    Unigrams,
    _buckets,
    _count_rows,
    _dealt,
    _looked_up,
    _rows,
    _scored,
    _summed,
    _taught,
    _unigrams,
    _with_ids,
    blocks,
    count_stats,
    discounts,
)
from .textscan import mixed, spread

#: A pair needs more room than a word.
BLOCK_TOKENS = 750_000
END, BEGIN = spread(71), spread(72)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HEAD, _WORDS, _PAIRS, _VALUES = 0, 1, 2, 3


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(context * _STEP + mixed(word + np.uint64(1)))


def pairs(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and word of each token's pair and the text it is in (ends come last)."""
    w, n = block.word, len(block.teach)
    before = np.full(len(w), BEGIN)
    before[1:] = np.where(block.row[1:] == block.row[:-1], w[:-1], BEGIN)
    last = np.full(n, BEGIN)
    last[block.row] = w  # the last of equal places stays
    return np.concatenate([before, last]), np.concatenate([w, np.full(n, END)]), np.concatenate([block.row, np.arange(n)])


def _each(batch: pa.RecordBatch, names: str | list[str] | None = None) -> Iterator[dict]:
    """Rows one by one, so that no more than one is there twice."""
    columns = [(c, batch.column(batch.schema.get_field_index(c))) for c in names or batch.schema.names]
    for k in range(len(batch)):
        yield {c: x[k].as_py() for c, x in columns}


def _place(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where x is in the sorted keys, and whether it is there."""
    if len(keys) == 0:
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def _dealer(own: Unigrams, key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """What chooses the bucket of a pair."""
    return np.where(_place(own.hashes, word)[1] | (word == END), key, word)


def settled(count: np.ndarray, left: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of what multiplies discounted counts, and of the back-off weight.

    ``left`` is the sum of the discounted counts after a context, ``mass`` the unigram mass of what was seen.
    """
    scale, back = np.ones(len(count)), np.ones(len(count))
    known = count > 0
    rest = 1 - left / np.maximum(count, 1)
    open_ = np.maximum(1 - mass, 0)
    scale[known] = 1 / count[known]
    back[known] = rest[known] / np.maximum(open_[known], 1e-300)
    flat = known & (rest < 1e-12)
    scale[flat] = 1 / (count[flat] + 1)
    back[flat] = scale[flat] / np.maximum(open_[flat], 1e-300)
    full = known & (open_ < 1e-12)
    scale[full], back[full] = 1 / np.maximum(left[full], 1e-300), 1e-300
    return np.log10(scale), np.log10(back)


@dataclass
class Scorer:
    """The part of a model that every task has; of bounded size. The last of the contexts is the begin."""

    unigrams: Unigrams
    discount: np.ndarray
    log_scale: np.ndarray
    log_back: np.ndarray
    frequent: np.ndarray
    frequent_gain: np.ndarray

    def context(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of contexts among the frequent ones, and which of them are there."""
        at, near = _place(self.unigrams.hashes, h)
        first = h == BEGIN
        return np.where(first, len(self.unigrams.hashes), at), near | first

    def gain(self, counts: np.ndarray, own: np.ndarray, value: np.ndarray) -> np.ndarray:
        """What a seen pair has above back-off; ``own`` counts the word, ``value`` is scale less back-off of the context."""
        u = self.unigrams
        return np.log10(self.discount[np.minimum(counts, TOP + 1)] * counts) + value - np.log10(u.probability(own))

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        u = self.unigrams
        return np.log10((counts + 0.1) / (u.total + 0.1 * (u.types + 1)))


@dataclass
class Model:
    """Stored tables: words with their counts and back-off, pairs, and what the buckets of pairs need of contexts."""

    words: DataFrame
    pairs: DataFrame
    values: DataFrame
    scorer: Scorer

    @property
    def unigrams(self) -> Unigrams:
        return self.scorer.unigrams


def _pair_table(taught: DataFrame, word_table: DataFrame, own: Unigrams, buckets: int) -> DataFrame:
    """Stored by bucket: a contexts, b counts, c keys in order, d counts of the second word."""
    held = taught.sparkSession.sparkContext.broadcast(own)

    def count(batches):
        for block in blocks(batches, BLOCK_TOKENS):
            context, word, _ = pairs(block)
            key, first, times = np.unique(pair_key(context, word), return_index=True, return_counts=True)
            context, word = context[first], word[first]
            yield _rows(
                [
                    (k, _PAIRS, "", context[at].tobytes(), times[at].astype(np.int64).tobytes(), word[at].tobytes(), None)
                    for k, at in _dealt(_dealer(held.value, key, word), buckets)
                ]
            )

    def merged(bucket, parts, table):
        u = held.value
        context, word = (np.concatenate([np.frombuffer(p[c], np.uint64) for p in parts]) for c in "ac")
        key, first, back = np.unique(pair_key(context, word), return_index=True, return_inverse=True)
        counts = np.zeros(len(key), np.int64)
        np.add.at(counts, back, np.concatenate([np.frombuffer(p["b"], np.int64) for p in parts]))
        context, word = context[first], word[first]
        at, near = _place(u.hashes, word)
        own = _looked_up(table, word)
        if near.any():
            own = np.where(near, u.counts[at], own)
        own = np.where(word == END, u.texts, own)
        return _rows([(bucket, _PAIRS, "", context.tobytes(), counts.tobytes(), key.tobytes(), own.astype(np.int64).tobytes())])

    def add(batches):
        bucket, table, parts = None, None, []
        for batch in batches:
            for r in _each(batch):
                if r["bucket"] != bucket:
                    if parts:
                        yield merged(bucket, parts, table)
                    bucket, table, parts = r["bucket"], None, []
                if r["kind"] == _WORDS:
                    table = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64)
                else:
                    parts.append(r)
        if parts:
            yield merged(bucket, parts, table)

    met = taught.mapInArrow(count, _PACKED).unionByName(word_table.withColumn("kind", F.lit(_WORDS)))
    return pin(met.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(add, _PACKED), "pairs")


def _frequent_contexts(table: DataFrame, model: Scorer) -> tuple[np.ndarray, np.ndarray]:
    """Discounted counts and unigram mass after the frequent contexts and the begin."""
    chunk = 4096
    held = table.sparkSession.sparkContext.broadcast(model)

    def gather(batches):
        m = held.value
        width = len(m.unigrams.hashes) + 1
        sums = np.zeros((2, width))
        for batch in batches:
            for r in _each(batch, "abd"):
                at, near = m.context(np.frombuffer(r["a"], np.uint64))
                at, counts = at[near], np.frombuffer(r["b"], np.int64)[near]
                p = m.unigrams.probability(np.frombuffer(r["d"], np.int64)[near])
                for k, v in enumerate((m.discount[np.minimum(counts, TOP + 1)] * counts, p)):
                    sums[k] += np.bincount(at, weights=v, minlength=width)
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
    left, mass = np.zeros((2, len(model.unigrams.hashes) + 1))
    # two numbers for each of at most 1 / share + 1 contexts
    for r in table.mapInArrow(gather, kind).repartition("lo").mapInArrow(add, kind).collect():
        part = np.frombuffer(r["sums"], np.float64).reshape(2, -1)
        at = slice(r["lo"], r["lo"] + part.shape[1])
        left[at], mass[at] = part
    return left, mass


def _rare_contexts(table: DataFrame, word_table: DataFrame, model: Scorer, buckets: int) -> DataFrame:
    """Stored: words (a, counts b, log back-off c), and for each bucket of pairs scale less back-off (b) of its rare contexts (a)."""
    held = table.sparkSession.sparkContext.broadcast(model)

    def ask(batches):
        m = held.value
        for batch in batches:
            for r in _each(batch):
                context, counts = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64)
                rare = ~m.context(context)[1]
                if not rare.any():
                    continue
                found, back = np.unique(context[rare], return_inverse=True)
                p = m.unigrams.probability(np.frombuffer(r["d"], np.int64)[rare])
                left = np.bincount(back, weights=(m.discount[np.minimum(counts, TOP + 1)] * counts)[rare])
                mass = np.bincount(back, weights=p)
                yield _rows(
                    [
                        (k, _VALUES, str(r["bucket"]), found[at].tobytes(), left[at].tobytes(), mass[at].tobytes(), None)
                        for k, at in _dealt(found, buckets)
                    ]
                )

    def answered(bucket, keys, counts, asks):
        left, mass = np.zeros((2, len(keys)))
        places = [np.searchsorted(keys, np.frombuffer(r["a"], np.uint64)) for r in asks]
        for r, at in zip(asks, places, strict=True):  # an ask has each context once
            left[at] += np.frombuffer(r["b"], np.float64)
            mass[at] += np.frombuffer(r["c"], np.float64)
        scale, back = settled(counts, left, mass)
        value = scale - back
        out = [(bucket, _WORDS, "", keys.tobytes(), counts.tobytes(), back.tobytes(), None)]
        return _rows(out + [(int(r["block"]), _VALUES, "", r["a"], value[at].tobytes(), None, None) for r, at in zip(asks, places, strict=True)])

    def settle(batches):
        bucket, words, asks = None, None, []
        for batch in batches:
            for r in _each(batch):
                if r["bucket"] != bucket:
                    if words:
                        yield answered(bucket, *words, asks)
                    bucket, words, asks = r["bucket"], None, []
                if r["kind"] == _WORDS:
                    words = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64)
                else:
                    asks.append(r)
        if words:
            yield answered(bucket, *words, asks)

    met = table.mapInArrow(ask, _PACKED).unionByName(word_table.withColumn("kind", F.lit(_WORDS)))
    return pin(met.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(settle, _PACKED), "contexts")


def _frequent_pairs(table: DataFrame, limit: float) -> tuple[np.ndarray, ...]:
    """Context, count, key and count of the word, by key, of pairs with a count of ``limit`` or more."""

    def task(batches):
        for batch in batches:
            for r in _each(batch, "abcd"):
                big = np.frombuffer(r["b"], np.int64) >= limit
                values = [np.frombuffer(r[c], np.uint64)[big].tobytes() for c in "abcd"]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=list("abcd"))

    found = table.mapInArrow(task, "a binary, b binary, c binary, d binary").collect()
    context, counts, key, own = (np.concatenate([np.frombuffer(r[c], np.uint64) for r in found] or [np.empty(0, np.uint64)]) for c in "abcd")
    order = np.argsort(key)
    return context[order], counts[order].astype(np.int64), key[order], own[order].astype(np.int64)


def fit(docs: DataFrame, teach: Column, share: float = 1e-5) -> Model:
    """Count the texts where ``teach`` holds and work out discounts and back-off weights."""
    taught = _taught(docs, teach).filter("teach")
    buckets = _buckets(docs)

    def count_words(batches):
        for block in blocks(batches, BLOCK_TOKENS):
            if len(block.word):
                yield _count_rows(block.word, buckets)

    word_table = _summed(taught.mapInArrow(count_words, _PACKED), "words")
    own = _unigrams(word_table, taught.count(), share)
    table = _pair_table(taught, word_table, own, buckets)
    none = np.zeros(0)
    model = Scorer(own, discounts(count_stats(table)[2]), none, none, np.zeros(0, np.uint64), none)
    left, mass = _frequent_contexts(table, model)
    model.log_scale, model.log_back = settled(np.append(own.counts, own.texts), left, mass)
    stored = _rare_contexts(table, word_table, model, buckets)
    context, counts, model.frequent, word = _frequent_pairs(table, max(1.0, share * own.total))
    # such a pair's words are frequent too
    at = model.context(context)[0]
    model.frequent_gain = model.gain(counts, word, (model.log_scale - model.log_back)[at])
    return Model(stored.filter(F.col("kind") == _WORDS), table, stored.filter(F.col("kind") == _VALUES), model)


def _asked(keys, by, row, kind: int, name: str, buckets: int) -> list[tuple]:
    """Rows that ask for keys in the buckets of ``by``: distinct keys, how often each is there, and the texts."""
    if len(keys) == 0:
        return []
    order = np.argsort(keys, kind="stable")
    keys, by, row = keys[order], by[order], row[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.diff(np.append(first, len(keys)))
    out = []
    for k, at in _dealt(by[first], buckets):
        n = times[at]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)
        out.append((k, kind, name, keys[first[at]].tobytes(), n.astype(np.uint32).tobytes(), row[place].astype(np.uint32).tobytes(), None))
    return out


class _Held:
    """The tables of one bucket."""

    def __init__(self, model: Scorer):
        self.model, self.words, self.pairs, self.values, self.gains = model, None, None, [], None

    def take(self, r: dict) -> None:
        if r["kind"] == _WORDS:
            self.words = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int64), np.frombuffer(r["c"], np.float64)
        elif r["kind"] == _PAIRS:
            self.pairs = r
        else:
            self.values.append((np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.float64)))

    def of_words(self, keys: np.ndarray) -> list[np.ndarray]:
        """known, base and score of words, as words and as contexts."""
        m = self.model
        counts, back = np.zeros(len(keys), np.int64), np.zeros(len(keys))
        if self.words:
            at, there = _place(self.words[0], keys)
            counts, back = np.where(there, self.words[1][at], 0), np.where(there, self.words[2][at], 0.0)
        return [(counts > 0).astype(float), m.base_log(counts), np.log10(m.unigrams.probability(counts)) + back]

    def of_pairs(self, keys: np.ndarray) -> list[np.ndarray]:
        none = np.zeros(len(keys))
        if self.pairs is None:
            return [none, none, none]
        if self.gains is None:
            self.gains = self._gains()
        at, there = _place(self.gains[0], keys)
        return [none, none, np.where(there, self.gains[1][at], 0.0)]

    def _gains(self) -> tuple[np.ndarray, np.ndarray]:
        m, r = self.model, self.pairs
        context, key = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["c"], np.uint64)
        counts, own = np.frombuffer(r["b"], np.int64), np.frombuffer(r["d"], np.int64)
        at, near = m.context(context)
        value = np.zeros(len(key))
        value[near] = (m.log_scale - m.log_back)[at[near]]
        if self.values:
            rare = np.concatenate([v[0] for v in self.values])
            order = np.argsort(rare)
            values = np.concatenate([v[1] for v in self.values])[order]
            value[~near] = values[_place(rare[order], context[~near])[0]]
        return key, m.gain(counts, own, value)


def score(docs: DataFrame, teach: Column, model: Model) -> DataFrame:
    """doc_id, teach, n_tokens, n_known, base_score and score of every row."""
    buckets = _buckets(docs)
    held = docs.sparkSession.sparkContext.broadcast(model.scorer)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = f"{_PACKED}, ids array<{kind}>"

    def ask(batches):
        m = held.value
        u = m.unigrams
        own_logs = np.log10(u.probability(u.counts)) + m.log_back[:-1]
        own_base = m.base_log(u.counts)
        for number, block in enumerate(blocks(batches, BLOCK_TOKENS)):
            name = f"{TaskContext.get().partitionId()}-{number}"
            n = len(block.teach)
            context, word, row = pairs(block)
            key = pair_key(context, word)
            local = np.zeros((4, n))
            local[0] = np.bincount(block.row, minlength=n) + 1
            ends = np.array([u.texts])
            local[1] = float(u.texts > 0)
            local[2] = m.base_log(ends)[0]
            local[3] = np.log10(u.probability(ends))[0] + m.log_back[-1]
            at, known = _place(u.hashes, block.word)
            for k, v in ((1, np.ones(len(u.hashes))), (2, own_base), (3, own_logs)):
                if known.any():
                    local[k] += np.bincount(block.row[known], weights=v[at[known]], minlength=n)
            place, near = _place(m.frequent, key)
            if near.any():
                local[3] += np.bincount(row[near], weights=m.frequent_gain[place[near]], minlength=n)
            rows = [(crc32(name.encode()) % buckets, _HEAD, name, local.tobytes(), block.teach.tobytes(), None, None)]
            rare = block.word[~known]
            rows += _asked(rare, rare, block.row[~known], _WORDS, name, buckets)
            key, word, row = key[~near], word[~near], row[~near]
            rows += _asked(key, _dealer(u, key, word), row, _PAIRS, name, buckets)
            out = _rows(rows)
            ids = pa.array([block.ids.to_pylist()] + [None] * (len(rows) - 1), pa.list_(block.ids.type))
            yield pa.RecordBatch.from_arrays([*out.columns, ids], names=[*out.schema.names, "ids"])

    def answer(batches):
        """Tables come first in their bucket, then what asks."""
        bucket, tables = None, None
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for k, r in enumerate(_each(batch.drop_columns(["ids"]))):
                if r["bucket"] != bucket:
                    bucket, tables = r["bucket"], _Held(held.value)
                if r["block"] == "":
                    tables.take(r)
                    continue
                if r["kind"] == _HEAD:
                    yield _with_ids([(0, _HEAD, r["block"], r["a"], r["b"], None, None)], ids.slice(k, 1))
                    continue
                keys, times = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.uint32)
                texts = np.frombuffer(r["c"], np.uint32).astype(np.int64)
                values = tables.of_pairs(keys) if r["kind"] == _PAIRS else tables.of_words(keys)
                each = np.repeat(np.arange(len(keys)), times)
                where, back = np.unique(texts, return_inverse=True)
                sums = np.stack([np.bincount(back, weights=v[each], minlength=len(where)) for v in values])
                out = [(0, r["kind"], r["block"], where.astype(np.uint32).tobytes(), sums.tobytes(), None, None)]
                yield _with_ids(out, pa.nulls(1, ids.type))

    def gather(batches):
        """Heads come first in their block, then the sums of its buckets."""
        block, ids, teach, local = None, None, None, None
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            for k, r in enumerate(_each(batch.drop_columns(["ids"]))):
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
    met = asked
    for t, k in ((model.words, _WORDS), (model.pairs, _PAIRS), (model.values, _VALUES)):
        met = met.unionByName(t.withColumn("kind", F.lit(k)).withColumn("ids", F.lit(None).cast(f"array<{kind}>")))
    answered = met.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(answer, packed)
    by_block = answered.repartition("block").sortWithinPartitions("block", "kind")
    result = f"doc_id {kind}, teach boolean, n_tokens long, n_known long, base_score double, score double"
    return by_block.mapInArrow(gather, result)
