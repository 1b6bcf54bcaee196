"""Katz back-off over all words for the texts it is learnt among: each pair of words moves once, counted and asked for.

The model is that of ``katz_words``, every word by itself. There the model is stored and any texts
can be scored, so pairs are dealt out once to be counted and once more, with the model, to be
scored. Here the texts to score are given with those that teach:

* The texts are stored once as blocks: the words of a block (hashes in order) and the number of each token's word.
* The distinct pairs of each block go to buckets with their training counts, 0 too. A bucket answers with the counts of
  the whole corpus, in the order of the question, and keeps sums for each context.
* A word that is not frequent has a bucket, and so have the pairs that end in it, or begin with it before a frequent
  word. Where both are such words the pair's share in the sums of its context goes on to the context's bucket. Pairs of
  two frequent words are dealt by themselves. So all that is known of a context meets, and no bucket holds a frequent word.
* The answers go to their block, which stayed where it was stored, finds its pairs again and adds up its texts.

Contexts keep how many words came after them once, twice, up to ``TOP`` times, and the unigram mass of all of them;
what discounts take and the back-off weight follow from these. Numbers travel in order, as differences where they are
in order, in columns of bytes of their own (``packed``). ``share`` changes no result: it only decides which words are
frequent, at most 1 / ``share`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, pin_bucketed, release, shuffle_width
from .katz import TOP, Unigrams, _scored, _taught, _unigrams, blocks, discounts
from .katz_words import _each, _place, settled
from .textscan import mixed

#: Tokens of a block, which one task holds, and of those whose pairs meet in a bucket, about, where there are many.
BLOCK_TOKENS, BUCKET_TOKENS = 1_000_000, 3_000_000
_CHUNK = 4096
_MESSAGE = "bucket int, kind int, block string, a binary"
_WORDS, _PAIRS = 0, 1
_COUNTS, _BACK, _ASKED, _OWN, _RARE, _FREQUENT, _STATS = range(2, 9)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, byte by byte and each byte of all numbers by itself, compressed where that helps."""
    codec = pa.Codec("zstd", compression_level=1)
    head, body = [len(columns)], []
    for x in columns:
        x = np.ascontiguousarray(x, np.uint64)
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        planes = x.view(np.uint8).reshape(-1, 8).T
        head += [len(x), width]
        for k in range(width):
            plane = planes[k].tobytes()
            small = codec.compress(plane, asbytes=True) if len(plane) > 64 else plane
            body.append(small if len(small) < len(plane) else plane)
            head.append(len(body[-1]))
    kind = np.uint16 if max(head) < 1 << 16 else np.uint32
    return b"".join([bytes([kind().itemsize]), np.array([len(head), *head], kind).tobytes(), *body])


def unpacked(data: bytes) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    kind = np.uint16 if data[0] == 2 else np.uint32
    size = 1 + int(np.frombuffer(data, kind, 1, 1)[0])
    head, at = np.frombuffer(data, kind, size, 1).tolist()[1:], 1 + size * data[0]
    out, k = [], 1
    for _ in range(head[0]):
        n, width = head[k : k + 2]
        planes = np.zeros((8, n), np.uint8)
        for j, length in enumerate(head[k + 2 : k + 2 + width]):
            part = data[at : at + length]
            planes[j] = np.frombuffer(part if length == n else codec.decompress(part, decompressed_size=n, asbytes=True), np.uint8)
            at += length
        out.append(np.ascontiguousarray(planes.T).view(np.uint64).ravel())
        k += 2 + width
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of numbers in order; ``np.cumsum`` gives the numbers again, also beyond 63 bits."""
    return np.diff(x.astype(np.uint64), prepend=np.uint64(0))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes, so what is in order stays so by bucket."""
    return _signed((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))


def _cuts(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["bucket", "kind", "block", "a"]
    )


@dataclass
class Held:
    """What every task has; of bounded size. Codes are the frequent words in order, the end, the begin, then other words."""

    unigrams: Unigrams
    buckets: int
    discount: np.ndarray | None = None
    log_scale: np.ndarray | None = None
    log_back: np.ndarray | None = None

    @property
    def end(self) -> int:
        return len(self.unigrams.hashes)

    @property
    def begin(self) -> int:
        return self.end + 1

    @property
    def codes(self) -> int:
        return self.end + 2

    def frequent_counts(self) -> np.ndarray:
        """Of the frequent words, the end and, as a context, the begin."""
        u = self.unigrams
        return np.concatenate([u.counts, [u.texts, u.texts]]).astype(np.int64)

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        u = self.unigrams
        return np.log10((counts + 0.1) / (u.total + 0.1 * (u.types + 1)))


class Stored:
    """A block as it is stored, and its distinct pairs in the order of their messages."""

    def __init__(self, data: bytes):
        words, word, length, teach = unpacked(data)
        self.words, self.word, self.length, self.teach = np.cumsum(words), _signed(word), _signed(length), teach.astype(bool)

    @staticmethod
    def of(block) -> bytes:
        words, word = np.unique(block.word, return_inverse=True)
        length = np.bincount(block.row, minlength=len(block.teach))
        return packed(steps(words), word, length, block.teach)

    def counts(self) -> np.ndarray:
        """How often each word is in the texts that teach."""
        return np.bincount(self.word, weights=np.repeat(self.teach, self.length), minlength=len(self.words)).astype(np.int64)

    def place(self, held: Held) -> None:
        n, codes = len(self.length), held.codes
        at, near = _place(held.unigrams.hashes, self.words)
        self.rare = self.words[~near]
        code = np.where(near, at, 0)
        code[~near] = codes + np.arange(len(self.rare))
        token = code[self.word]
        row = np.repeat(np.arange(n), self.length)
        first = np.append(True, row[1:] != row[:-1])[: len(row)]
        before = np.where(first, held.begin, np.append(held.begin, token[:-1])[: len(row)])
        last = np.full(n, held.begin)
        some = self.length > 0
        last[some] = token[np.cumsum(self.length)[some] - 1]
        self.row = np.concatenate([row, np.arange(n)])
        self.token = np.concatenate([token, np.full(n, held.end)])
        width = codes + len(self.rare)
        pair, self.pair = np.unique(np.concatenate([before, last]) * width + self.token, return_inverse=True)
        self.context, self.after = np.divmod(pair, width)
        self.own_bucket = _bucket(self.rare, held.buckets)
        self.cuts = _cuts(self.own_bucket, held.buckets)
        self._deal(held)

    def _deal(self, held: Held) -> None:
        """Places of pairs by kind, each in order of its buckets: both frequent, one word rare, both rare, context rare."""
        codes, buckets = held.codes, held.buckets
        context, after = self.context >= codes, self.after >= codes
        self.kinds = []
        for first, second in ((False, False), (False, True), (True, True), (True, False)):
            at = np.flatnonzero((context == first) & (after == second))
            if second:
                at = at[np.argsort(self.after[at], kind="stable")]
                bucket = self.own_bucket[self.after[at] - codes]
            elif first:
                bucket = self.own_bucket[self.context[at] - codes]
            else:
                bucket = _bucket(mixed((self.context[at] * codes + self.after[at] + 1).astype(np.uint64)), buckets)
                order = np.argsort(bucket, kind="stable")
                at, bucket = at[order], bucket[order]
            self.kinds.append((at, _cuts(bucket, buckets)))

    def of_bucket(self, k: int) -> list[np.ndarray]:
        return [at[cut[k] : cut[k + 1]] for at, cut in self.kinds]

    def asked(self, held: Held) -> Iterator[tuple[int, bytes]]:
        times = np.bincount(self.pair, weights=self.teach[self.row], minlength=len(self.context)).astype(np.int64)
        for k in range(held.buckets):
            lo, hi = self.cuts[k : k + 2]
            both, word, rare, first = places = self.of_bucket(k)
            if lo == hi and len(both) == 0:
                continue
            base = held.codes + lo
            each = [np.bincount(x - base, minlength=hi - lo) for x in (self.after[word], self.after[rare], self.context[first])]
            yield k, packed(
                steps(self.rare[lo:hi]), *each, steps(self.context[both]), self.after[both], self.context[word],
                self.rare[self.context[rare] - held.codes], self.after[first], np.concatenate([times[p] for p in places]),
            )


def _sums(place: np.ndarray, counts: np.ndarray, p: np.ndarray, width: int) -> np.ndarray:
    """For each place how many pairs have a count of 1, 2, up to TOP, and the probabilities of the words of all of them."""
    small = counts <= TOP
    out = np.zeros((TOP + 1, width))
    out[:TOP] = np.bincount((counts[small] - 1) * width + place[small], minlength=TOP * width).reshape(TOP, width)
    out[TOP] = np.bincount(place, weights=p, minlength=width)
    return out


def _packed_sums(sums: np.ndarray) -> list[np.ndarray]:
    return [*sums[:TOP], np.ascontiguousarray(sums[TOP]).view(np.uint64)]


def _unpacked_sums(columns: list[np.ndarray]) -> np.ndarray:
    return np.stack([*[c.astype(float) for c in columns[:TOP]], columns[TOP].view(np.float64)])


def _settled(counts: np.ndarray, sums: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    taken = ((1 - discount[1 : TOP + 1]) * np.arange(1, TOP + 1)) @ sums[:TOP]
    return settled(counts, counts - taken, sums[TOP])


def _plain_scale(counts: np.ndarray) -> np.ndarray:
    """What ``settled`` gives but in its two special cases."""
    return np.log10(1 / np.maximum(counts, 1))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Messages together up to about a megabyte; many are small where there are many buckets."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[3]) + 100
        if size >= 1 << 20:
            yield _messages(held)
            held, size = [], 0
    if held:
        yield _messages(held)


def _by_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")


def _groups(batches, by: str) -> Iterator[tuple]:
    """Rows that follow each other with the same value."""
    key, rows = None, []
    for batch in batches:
        for r in _each(batch):
            if rows and r[by] != key:
                yield key, rows
                rows = []
            key = r[by]
            rows.append(r)
    if rows:
        yield key, rows


def _stored(docs: DataFrame, teach: Column) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def store(batches):
        for number, block in enumerate(blocks(batches, BLOCK_TOKENS)):
            values = {
                "block": pa.array([f"{TaskContext.get().partitionId()}-{number}"]),
                "a": pa.array([Stored.of(block)], pa.binary()),
                "tokens": pa.array([len(block.word) + len(block.teach)]),
                "taught": pa.array([int(block.teach.sum())]),
                "ids": pa.array([block.ids.to_pylist()], pa.list_(block.ids.type)),
            }
            yield pa.RecordBatch.from_pydict(values)

    found = _taught(docs, teach).mapInArrow(store, f"block string, a binary, tokens long, taught long, ids array<{kind}>")
    return pin_bucketed(found, "block", "blocks", shuffle_width(docs.sparkSession))


def _word_table(stored: DataFrame, buckets: int) -> DataFrame:
    """Stored by bucket: a keys in order, b counts."""

    def count(batches):
        for batch in batches:
            for r in _each(batch):
                block = Stored(r["a"])
                counts = block.counts()
                words, counts = block.words[counts > 0], counts[counts > 0]
                cut = _cuts(_bucket(words, buckets), buckets)
                parts = ((k, slice(cut[k], cut[k + 1])) for k in range(buckets) if cut[k] < cut[k + 1])
                yield _messages([(k, _WORDS, "", packed(steps(words[at]), counts[at])) for k, at in parts])

    def add(batches):
        for bucket, rows in _groups(batches, "bucket"):
            parts = [unpacked(r["a"]) for r in rows]
            keys, back = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
            total = np.bincount(back, weights=np.concatenate([p[1] for p in parts]).astype(float)).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([bucket], pa.int32()),
                    "a": pa.array([keys.tobytes()], pa.binary()),
                    "b": pa.array([total.tobytes()], pa.binary()),
                }
            )

    return pin(_by_bucket(stored.select("a").mapInArrow(count, _MESSAGE), buckets).mapInArrow(add, "bucket int, a binary, b binary"), "words")


class _Asked:
    """What one block asks of a bucket."""

    def __init__(self, r: dict):
        words, self.n_word, self.n_rare, self.n_first, both, *rest = unpacked(r["a"])
        self.block, self.words, self.both = r["block"], np.cumsum(words), np.cumsum(both)
        self.both_after, self.word_context, self.rare_context, self.first_after, self.times = rest
        ends = np.cumsum([len(self.both), len(self.word_context), len(self.rare_context), len(self.first_after)])
        self.parts = np.split(self.times, ends[:-1])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return _signed(np.concatenate(parts))


def _counted(key: np.ndarray, times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys that have a count, these counts, and those of all keys, block by block."""
    found, back = np.unique(key, return_inverse=True)
    counts = np.bincount(back, weights=np.concatenate(times).astype(float), minlength=len(found)).astype(np.int64)
    known = counts > 0
    return found[known], counts[known], np.split(counts[back], np.cumsum([len(t) for t in times])[:-1])


def _answers(bucket: int, table: tuple | None, asks: list[_Asked], held: Held) -> Iterator[tuple]:
    """Rows of one bucket: counts for each block, and what is known here of contexts."""
    u, codes = held.unigrams, held.codes
    frequent = u.probability(held.frequent_counts())
    words = np.unique(np.concatenate([a.words for a in asks]))
    own = np.zeros(len(words), np.int64)
    if table:
        at, there = _place(table[0], words)
        own[there] = table[1][at[there]]
    p = u.probability(own)
    places = [np.searchsorted(words, a.words) for a in asks]
    spread = lambda name: np.concatenate([np.repeat(x, _signed(getattr(a, name))) for a, x in zip(asks, places, strict=True)])
    times = [[a.parts[k] for a in asks] for k in range(4)]

    both, both_counts, back_both = _counted(_joined([a.both for a in asks]) * codes + _joined([a.both_after for a in asks]), times[0])
    word, word_counts, back_word = _counted(spread("n_word") * codes + _joined([a.word_context for a in asks]), times[1])
    others, back = np.unique(np.concatenate([a.rare_context for a in asks]), return_inverse=True)
    rare, rare_counts, back_rare = _counted(back * max(len(words), 1) + spread("n_rare"), times[2])
    first, first_counts, back_first = _counted(spread("n_first") * codes + _joined([a.first_after for a in asks]), times[3])

    for a, at, *counts in zip(asks, places, back_both, back_word, back_rare, back_first, strict=True):
        yield bucket, _COUNTS, a.block, packed(*counts, own[at])
        yield bucket, _ASKED, a.block, packed(steps(at))
    sums = _sums(first // codes, first_counts, frequent[first % codes], len(words))
    yield bucket, _OWN, "", packed(steps(words), own, *_packed_sums(sums))
    context, after = np.divmod(rare, max(len(words), 1))  # contexts are in order
    to = _cuts(_bucket(others[context], held.buckets), held.buckets)
    for k in np.flatnonzero(np.diff(to)).tolist():
        at = slice(to[k], to[k + 1])
        yield k, _RARE, "", packed(steps(others[context[at]]), rare_counts[at], own[after[at]])
    sums = _sums(both // codes, both_counts, frequent[both % codes], codes) + _sums(word % codes, word_counts, p[word // codes], codes)
    for lo in range(0, codes, _CHUNK):
        part = sums[:, lo : lo + _CHUNK]
        if part.any():
            yield lo, _FREQUENT, "", packed(*_packed_sums(part))
    stats = [np.bincount(np.minimum(c, TOP + 2), minlength=TOP + 3) for c in (both_counts, word_counts, rare_counts, first_counts)]
    yield bucket, _STATS, "", packed(sum(stats))


def _pair_counts(stored: DataFrame, word_table: DataFrame, first: Held) -> DataFrame:
    """Stored: what ``_answers`` gives for each bucket."""
    held = stored.sparkSession.sparkContext.broadcast(first)

    def ask(batches):
        for batch in batches:
            for r in _each(batch):
                block = Stored(r["a"])
                block.place(held.value)
                yield from _batches((k, _PAIRS, r["block"], data) for k, data in block.asked(held.value))

    def table(batches):
        for batch in batches:
            for r in _each(batch):
                yield _messages([(r["bucket"], _WORDS, "", packed(steps(np.frombuffer(r["a"], np.uint64)), np.frombuffer(r["b"], np.int64)))])

    def answer(batches):
        for bucket, rows in _groups(batches, "bucket"):
            words = [unpacked(r["a"]) for r in rows if r["kind"] == _WORDS]
            asks = [_Asked(r) for r in rows if r["kind"] == _PAIRS]
            if asks:
                found = (np.cumsum(words[0][0]), _signed(words[0][1])) if words else None
                yield from _batches(_answers(bucket, found, asks, held.value))

    met = stored.select("block", "a").mapInArrow(ask, _MESSAGE).unionByName(word_table.mapInArrow(table, _MESSAGE))
    return pin(_by_bucket(met, first.buckets).mapInArrow(answer, _MESSAGE), "counts")


def _of(table: DataFrame, *kinds: int) -> DataFrame:
    return table.filter(F.col("kind").isin(list(kinds)))


def _discounts(counted: DataFrame) -> np.ndarray:
    """From counts of counts of all pairs: a few numbers from each bucket."""

    def few(batches):
        total = np.zeros(TOP + 3, np.int64)
        for batch in batches:
            for r in _each(batch):
                total += _signed(unpacked(r["a"])[0])
        yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in total], names=[f"n{k}" for k in range(TOP + 3)])

    names = [f"n{k}" for k in range(TOP + 3)]
    row = _of(counted, _STATS).mapInArrow(few, ", ".join(f"{c} long" for c in names)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    return discounts(np.array([0, *row.first()[1 : TOP + 2]], float))


def _frequent_contexts(counted: DataFrame, codes: int) -> np.ndarray:
    """Sums of the frequent contexts and the begin: a few numbers for each of at most 1 / share + 2 contexts."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in _each(batch):
                total[r["bucket"]] = total.get(r["bucket"], 0) + _unpacked_sums(unpacked(r["a"]))
        for lo, sums in total.items():
            yield _messages([(lo, _FREQUENT, "", packed(*_packed_sums(sums)))])

    out = np.zeros((TOP + 1, codes))
    for r in _of(counted, _FREQUENT).mapInArrow(add, _MESSAGE).repartition("bucket").mapInArrow(add, _MESSAGE).collect():
        part = _unpacked_sums(unpacked(r["a"]))
        out[:, r["bucket"] : r["bucket"] + part.shape[1]] = part
    return out


def _rare_contexts(counted: DataFrame, held) -> DataFrame:
    """For each block and bucket what its other words have as contexts: log back-off, and the scale where it is a special one."""

    def settle(batches):
        m = held.value
        for bucket, rows in _groups(batches, "bucket"):
            mine = next((unpacked(r["a"]) for r in rows if r["kind"] == _OWN), None)
            if mine is None:
                continue
            words, own, sums = np.cumsum(mine[0]), _signed(mine[1]), _unpacked_sums(mine[2:])
            for r in rows:
                if r["kind"] == _RARE:
                    context, counts, after = unpacked(r["a"])
                    p = m.unigrams.probability(_signed(after))
                    sums += _sums(np.searchsorted(words, np.cumsum(context)), _signed(counts), p, len(words))
            scale, back = _settled(own, sums, m.discount)
            special = (scale != _plain_scale(own)).astype(np.uint64)
            bits = np.where(special > 0, scale, 0.0).view(np.uint64)
            back = back.view(np.uint64)
            asked = ((r["block"], _signed(np.cumsum(unpacked(r["a"])[0]))) for r in rows if r["kind"] == _ASKED)
            yield from _batches((bucket, _BACK, name, packed(back[at], special[at], bits[at])) for name, at in asked)

    return _by_bucket(_of(counted, _ASKED, _OWN, _RARE), held.value.buckets).mapInArrow(settle, _MESSAGE)


def _sums_of_texts(block: Stored, counts: dict, backs: dict, m: Held) -> np.ndarray:
    """Tokens, known tokens, base and score of the texts of a block."""
    block.place(m)
    u, codes = m.unigrams, m.codes
    pair, own = np.zeros(len(block.context), np.int64), np.zeros(len(block.rare), np.int64)
    scale, back = np.zeros(len(block.rare)), np.zeros(len(block.rare))
    for k, data in counts.items():
        *parts, mine = unpacked(data)
        for at, values in zip(block.of_bucket(k), parts, strict=True):
            pair[at] = values
        own[block.cuts[k] : block.cuts[k + 1]] = mine
    for k, data in backs.items():
        at = slice(block.cuts[k], block.cuts[k + 1])
        logs, special, bits = unpacked(data)
        back[at] = logs.view(np.float64)
        scale[at] = np.where(special > 0, bits.view(np.float64), _plain_scale(own[at]))
    word = np.concatenate([m.frequent_counts(), own])
    log_scale, log_back = np.concatenate([m.log_scale, scale]), np.concatenate([m.log_back, back])
    seen = np.log10(m.discount[np.minimum(pair, TOP + 1)] * np.maximum(pair, 1)) + log_scale[block.context]
    unseen = log_back[block.context] + np.log10(u.probability(word))[block.after]
    value = np.where(pair > 0, seen, unseen)
    n = len(block.length)
    weights = ((word > 0).astype(float)[block.token], m.base_log(word)[block.token], value[block.pair])
    return np.stack([block.length + 1.0, *[np.bincount(block.row, weights=w, minlength=n) for w in weights]])


def score_all(docs: DataFrame, teach: Column, share: float = 1e-5) -> DataFrame:
    """doc_id, teach, n_tokens, n_known, base_score, score and train_tokens of every row, learnt where ``teach`` holds."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = _stored(docs, teach)
    size = stored.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("taught"), F.lit(0))).first()
    buckets = max(-(-size[0] // BUCKET_TOKENS), min(2 * shuffle_width(spark), 64))
    word_table = _word_table(stored, buckets)
    model = Held(_unigrams(word_table, size[1], share), buckets)
    counted = _pair_counts(stored, word_table, model)
    release(word_table)
    model.discount = _discounts(counted)
    model.log_scale, model.log_back = _settled(model.frequent_counts(), _frequent_contexts(counted, model.codes), model.discount)
    held = spark.sparkContext.broadcast(model)

    def gather(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            for k, r in enumerate(_each(batch, ["a", "answers"])):
                block, answers = Stored(r["a"]), {_COUNTS: {}, _BACK: {}}
                for x in r["answers"]:
                    answers[x["kind"]][x["bucket"]] = x["a"]
                sums = _sums_of_texts(block, answers[_COUNTS], answers[_BACK], held.value)
                yield _scored(lists.slice(k, 1).flatten(), block.teach, sums)

    # blocks lie in buckets already, so only the answers move
    answered = _of(counted, _COUNTS).unionByName(_rare_contexts(counted, held))
    by_block = answered.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "a")).alias("answers"))
    met = stored.join(by_block.hint("merge"), "block").select("a", "ids", "answers")
    result = f"doc_id {kind}, teach boolean, n_tokens long, n_known long, base_score double, score double"
    return met.mapInArrow(gather, result).withColumn("train_tokens", F.lit(model.unigrams.total).cast("bigint"))
