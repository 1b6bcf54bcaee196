"""Spelling variants: words one letter apart, and the more frequent word each belongs to.

Two words are near if one inserted, deleted or replaced code point makes them
equal. A word's form is its near word of largest count, if that is at least
twice its own; its root is where the forms lead.

Near words are found in a bit-sliced position index: per place and letter one
set of bits, a bit for each word. Along the letters of a query three sets are
carried for all words at once: those without an error so far, those with one
letter replaced, and those with one letter more (or less), which are read one
place further on (or back). What is left at the end are the near words, and
because the bits are ordered by count, the first of them is the form.

Words meet in groups, so that no index holds the whole vocabulary. Two near
words of which the shorter has m letters differ first at one place c; so before
it, and counted from their ends after it, they agree. With the places i..j left
open, a group holds the words of m and m+1 letters that agree outside, and looks
for pairs with i <= c < j; halving i..j halves the places at which two words may
differ. Every pair has one c, so it is found in one group only. Groups start
with half of the word open, and those above GROUP words are halved until they
fit or one place is open, which leaves at most an alphabet squared. Small groups
share a task, which is one index with a set of bits for each group.

Defined cases: null and empty texts have no words; the id of rows without one
is the empty text; repeated rows count as often as they are there; long runs of
letters are words like others; an empty table gives an empty result. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin

#: After A-Z are lower-cased: letters of ASCII and Latin-1.
LETTERS = "[a-zÀ-ÿ]+"
SHORTEST = 5
RAREST = 3
#: One run in so many loses a letter.
SLIP = 97
#: Words of a group above which it is halved, and words that share an index.
GROUP = 4096
_QUERIES = 512

_KEY = ["m", "i", "j", "head", "tail"]
_FOUND = "word string, near bigint, best string, best_n bigint"


def counted_words(
    docs: DataFrame, slip: int = SLIP, shortest: int = SHORTEST, rarest: int = RAREST
) -> DataFrame:
    """word, n: the runs of letters of all texts.

    A run whose crc32 together with the id is divisible by ``slip`` loses the
    letter at place crc32 modulo its length.
    """
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), 0)).alias("run"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    length = F.char_length("run")
    hashed = runs.filter(length >= shortest).select("run", F.crc32(key.cast("binary")).alias("h"))
    at = F.pmod("h", length).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
    word = F.when(F.col("h") % slip == 0, less).otherwise(F.col("run"))
    long_ = hashed.select(word.alias("word")).filter(F.char_length("word") >= shortest)
    return long_.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rarest)


def _keyed(open_: DataFrame) -> DataFrame:
    """word, n, m, i, j with what the words of a group share, and the letters that are left open."""
    after = F.col("m") - F.col("j")
    length = F.char_length("word")
    return open_.withColumns(
        {
            "head": F.substring("word", F.lit(1), F.col("i")),
            "tail": F.substring("word", length - after + 1, after),
            "free": F.substring("word", F.col("i") + 1, length - after - F.col("i")),
        }
    )


def _halved(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
    halves = F.array(F.struct(mid.alias("i"), F.col("j")), F.struct(F.col("i"), mid.alias("j")))
    return _keyed(rows.select("word", "n", "m", F.explode(halves).alias("_s")).select("word", "n", "m", "_s.i", "_s.j"))


def _groups(words: DataFrame, largest: int) -> DataFrame:
    """Every word once per group it belongs to."""
    length = F.char_length("word")
    whole = words.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("m"), F.lit(0).alias("i")
    ).withColumn("j", F.col("m"))
    open_, done = _halved(whole), []
    while True:
        open_ = pin(open_, "groups")
        big = pin(
            open_.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_n") > largest) & (F.col("j") - F.col("i") > 1)).drop("_n"),
            "large-groups",
        )
        if big.isEmpty():
            return reduce(DataFrame.unionByName, [*done, open_])
        done.append(open_.join(big, _KEY, "left_anti"))
        open_ = _halved(open_.join(big, _KEY, "left_semi"))


class PositionIndex:
    """Bits of words by place and letter. The words come in the order of their bits."""

    def __init__(self, words: list[bytes]):
        self.width = -(-len(words) // 64)
        longest = max(map(len, words))
        letters = np.zeros((len(words), longest + 1), np.uint8)
        for k, w in enumerate(words):
            letters[k, : len(w)] = np.frombuffer(w, np.uint8)
        self.letters = letters
        self.slices, self.row_of = [], []
        for place in range(longest + 1):
            held = np.unique(letters[:, place])
            held = held[held > 0]
            rows = np.zeros(256, np.int64)
            rows[held] = np.arange(1, len(held) + 1)
            # row 0: no word has the letter here
            self.slices.append(np.concatenate([np.zeros((1, self.width), np.uint64), self.bits(letters[:, place] == held[:, None])]))
            self.row_of.append(rows)

    def bits(self, marks: np.ndarray) -> np.ndarray:
        """Rows of marks as rows of 64-bit words."""
        out = np.zeros((len(marks), self.width * 8), np.uint8)
        packed = np.packbits(marks, axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)

    def at(self, place: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the words that have it at the place."""
        return self.slices[place][self.row_of[place][letters]]

    def replaced_and_longer(self, queries: np.ndarray, length: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words in ``start``: those with one of ``length`` letters replaced, those with one
        more at any place, and those that begin with the whole query."""
        exact, replaced, longer = start, np.zeros_like(start), np.zeros_like(start)
        for place in range(length):
            here = self.at(place, queries[:, place])
            longer = (longer | exact) & self.at(place + 1, queries[:, place])
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
        return replaced, longer | exact, exact

    def shorter(self, queries: np.ndarray, length: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words in ``start``: those that lack one of the ``length`` letters, and those
        that have all but the last."""
        exact, lacking, nearly = start, np.zeros_like(start), start
        for place in range(length):
            nearly = exact
            if place:
                lacking = lacking & self.at(place - 1, queries[:, place])
            lacking = lacking | exact
            exact = exact & self.at(place, queries[:, place])
        return lacking, nearly


def _first(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of bits of each row, and the first one (of rows that have one)."""
    count = np.bitwise_count(found).sum(1).astype(np.int64)
    word = (found != 0).argmax(1)
    value = found[np.arange(len(found)), word]
    lowest = value & (~value + np.uint64(1))
    return count, word * 64 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)


def near_in_groups(
    free: list[bytes], longer: np.ndarray, last: np.ndarray, group: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Number of near words of each word within its group, and the first of them.

    ``free`` are the open letters, ``length`` of them or one more (``longer``);
    ``last``: nothing follows them. Words are in the order of preference.
    """
    index = PositionIndex(free)
    every = np.arange(int(group.max()) + 1)
    members = index.bits(group == every[:, None])
    short, long_ = index.bits(np.stack([~longer, longer]))
    counts, firsts = np.zeros(len(free), np.int64), np.zeros(len(free), np.int64)
    for of_long in (False, True):
        rows = np.flatnonzero(longer == of_long)
        for k in range(0, len(rows), _QUERIES):
            some = rows[k : k + _QUERIES]
            letters, own, end = index.letters[some], members[group[some]], last[some][:, None]
            if of_long:
                found, agree = index.shorter(letters, length + 1, own & short)
                found = found & short
            else:
                replaced, more, agree = index.replaced_and_longer(letters, length, own)
                found = (replaced & short) | (more & long_)
            # a pair that agrees on all open letters differs first behind them
            found = np.where(end, found, found & ~agree)
            counts[some], firsts[some] = _first(found)
    return counts, firsts


def _search(table: pa.Table) -> pa.Table:
    rows = table.to_pydict()
    order = sorted(range(len(rows["word"])), key=lambda k: (-rows["n"][k], rows["word"][k]))
    open_ = np.array([rows["j"][k] - rows["i"][k] for k in order])
    out: dict[str, list] = {"word": [], "near": [], "best": [], "best_n": []}
    for length in np.unique(open_).tolist():
        some = [order[k] for k in np.flatnonzero(open_ == length).tolist()]
        ids: dict[tuple, int] = {}
        group = np.array([ids.setdefault(tuple(rows[c][k] for c in _KEY), len(ids)) for k in some])
        longer = np.array([len(rows["word"][k]) > rows["m"][k] for k in some])
        last = np.array([rows["j"][k] == rows["m"][k] for k in some])
        # all letters are in Latin-1
        free = [rows["free"][k].encode("latin-1") for k in some]
        counts, firsts = near_in_groups(free, longer, last, group, length)
        for k in np.flatnonzero(counts).tolist():
            best = some[int(firsts[k])]
            out["word"].append(rows["word"][some[k]])
            out["near"].append(int(counts[k]))
            out["best"].append(rows["word"][best])
            out["best_n"].append(rows["n"][best])
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})


def near_words(words: DataFrame, largest: int = GROUP) -> DataFrame:
    """word, near (number of near words), best (the one of largest n, then the smallest), best_n.

    ``words`` (word, n) has each word once; words without a near word are left out.
    """
    entries = pin(_groups(words, largest), "entries")
    tasks = max(1, -(-entries.count() // largest))
    dealt = entries.withColumn("_task", F.pmod(F.xxhash64(*_KEY), F.lit(tasks)))
    found = dealt.groupBy("_task").applyInArrow(_without_key, _FOUND)
    better = F.struct(-F.col("best_n"), F.col("best"))
    picked = found.groupBy("word").agg(
        F.sum("near").alias("near"), F.min_by(F.struct("best", "best_n"), better).alias("_b")
    )
    return picked.select("word", "near", "_b.best", "_b.best_n")


def _without_key(table: pa.Table) -> pa.Table:
    return _search(table.drop_columns(["_task"]))


def _roots(words: DataFrame) -> DataFrame:
    """word, root of the words (word, form) that have a form.

    Each round doubles the steps taken. Counts at least double along the way,
    so there are few rounds.
    """
    up = pin(words.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = pin(up.join(beyond, "root", "left"), "jump")
        if jumped.filter("_next is not null").isEmpty():
            return up
        up = jumped.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame, least: int = 2, largest: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts."""
    words = pin(counted_words(docs), "words")
    joined = words.join(near_words(words, largest), "word", "left")
    enough = F.col("best_n") >= least * F.col("n")
    formed = pin(
        joined.select(
            "word", F.when(enough, F.col("best")).alias("form"), "n",
            F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"), F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    out = formed.join(_roots(formed), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
