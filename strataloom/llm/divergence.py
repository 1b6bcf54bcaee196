"""How far the sources of a language are from each other and from the language, over all of its terms.

The counts of the kept terms make a matrix for each language: a row for each
source, a column for each term, the terms of most documents first. It is cut
into squares of SIDE rows and columns, and a square becomes a K2-tree with K = 2:
its quadrants are halved both ways as long as they hold a count, a bit each, and
at the end are the prices of single cells.

All cells without a count have one price per source, so where the trees of two
sources are both empty, all terms of the quadrant are counted and priced at
once; where one has leaves, both are followed down together. Two blocks of rows
meet once per block of columns. Tasks take what adaptive execution deals them by
(language, blocks) and add up what they have before it is shuffled.

All arithmetic is in whole numbers: the price of a count is
1 + floor(10^9 (count + 2) / (N + 2 V)), the difference of two prices
floor((p - q)^2 / (p + q)).

Defined cases: a null text, language or source is the empty one; a language
without kept terms has pairs of value 0 and no terms; a language with one source
has no pairs; repeated rows count as often as they are there; very long texts
are texts like others; an empty table gives an empty result. Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import pin

#: Terms are what lies between: runs of ASCII letters and all that is beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
FEWEST_DOCUMENTS = 10
TOP_TERMS = 10
DEPTH = 9
SIDE = 1 << DEPTH
_NODES_AT_ONCE = 1 << 17


# counts and prices


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents)."""
    empty = F.lit("")
    texts = docs.select(
        F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"),
        F.translate(F.coalesce("text", empty), ascii_uppercase, ascii_lowercase).alias("text"),
    )
    # in order, a term is new to its document where the one before is another
    ordered = texts.select("lang", "source", F.sort_array(F.split("text", BETWEEN)).alias("terms"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("terms", F.lit(1), F.size("terms") - 1))
    each = ordered.select("lang", "source", F.inline(F.arrays_zip("terms", before))).toDF("lang", "source", "term", "before")
    new = F.when(F.col("term").eqNullSafe(F.col("before")), 0).otherwise(1)
    return each.filter("term <> ''").groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("n"), F.sum(new).alias("d"))


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)); null if there is no term at all."""
    up = (count + 2).cast("decimal(20,0)") * F.lit(1_000_000_000)
    down = F.nullif(total + 2 * terms, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return F.call_function("div", up, down) + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class Priced:
    """The counts of the kept terms with their places in the matrix of their language, and all sources."""

    def __init__(self, docs: DataFrame, fewest: int):
        empty = F.lit("")
        counts = pin(term_counts(docs), "term-counts")
        terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("docs")).filter(F.col("docs") >= fewest)
        placed = pin(number_rows(terms, ["lang", F.col("docs").desc(), "term"], "place"), "terms")
        langs = placed.groupBy("lang").agg(
            F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"), F.min("place").alias("from")
        )
        priced = pin(
            placed.join(langs, "lang").select(
                "lang", "term", (F.col("place") - F.col("from")).alias("col"),
                price(F.col("total"), F.col("lang_total"), F.col("terms")).alias("q"),
            ),
            "priced-terms",
        )
        kept = pin(counts.join(priced, ["lang", "term"]).select("lang", "source", "term", "col", "n", "q"), "kept")
        sources = docs.select(
            F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")
        ).distinct()
        numbered = pin(number_rows(sources, ["lang", "source"], "place"), "sources")
        first = numbered.groupBy("lang").agg(F.min("place").alias("from_row"), F.count(F.lit(1)).alias("sources"))
        totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        none = F.lit(0).cast("bigint")
        with_sums = (
            numbered.join(first, "lang").join(totals, ["lang", "source"], "left").join(langs.select("lang", "terms"), "lang", "left")
            .select(
                "lang", "source", "sources", (F.col("place") - F.col("from_row")).alias("row"),
                F.coalesce("n", none).alias("total"), F.coalesce("terms", none).alias("terms"),
            )
        )
        #: lang, source, sources (of the language), row, total, terms, rest (the price of a count of 0)
        self.sources = pin(with_sums.withColumn("rest", price(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))), "rows")
        #: lang, source, row, term, col, n, p, q
        self.cells = pin(
            kept.join(self.sources.select("lang", "source", "row", "total", "terms"), ["lang", "source"])
            .select("lang", "source", "row", "term", "col", "n", price(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "q"),
            "cells",
        )


# trees


def _spread(v: np.ndarray) -> np.ndarray:
    """The bits of small numbers at every second place."""
    out = np.zeros_like(v)
    for bit in range(DEPTH):
        out |= ((v >> bit) & 1) << (2 * bit)
    return out


def tree(row: np.ndarray, col: np.ndarray, prices: np.ndarray) -> bytes:
    """The K2-tree of the cells of one square: one bit per quadrant, level by level, then the prices of the cells."""
    code = _spread(row) << 1 | _spread(col)
    order = np.argsort(code)
    code = code[order]
    sizes, levels = [], []
    above = np.zeros(1, np.int64)
    for level in range(1, DEPTH + 1):
        own = np.unique(code >> (2 * (DEPTH - level)))
        bits = np.zeros(4 * len(above), bool)
        bits[4 * np.searchsorted(above, own >> 2) + (own & 3)] = True
        sizes.append(len(bits))
        levels.append(bits)
        above = own
    body = np.packbits(np.concatenate(levels)).tobytes()
    return struct.pack(f"<{DEPTH + 1}I", len(code), *sizes) + body + prices[order].astype("<i4").tobytes()


class Tree:
    """A tree read from its bytes; ``children[level]`` leads from a node and a quadrant to a node below, or -1."""

    def __init__(self, raw: bytes | None):
        self.root = -1 if raw is None else 0
        if raw is None:
            self.children, self.prices = [np.full(4, -1)] * DEPTH, np.zeros(1, np.int64)
            return
        n, *sizes = struct.unpack_from(f"<{DEPTH + 1}I", raw)
        at, total = 4 * (DEPTH + 1), sum(sizes)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, -(-total // 8), at), count=total).astype(bool)
        self.children = []
        for level in np.split(bits, np.cumsum(sizes)[:-1]):
            self.children.append(np.where(level, np.cumsum(level) - 1, -1))
        self.prices = np.frombuffer(raw, "<i4", n, at + -(-total // 8)).astype(np.int64)

    def down(self, level: int, node: np.ndarray, quadrant: int) -> np.ndarray:
        return np.where(node < 0, -1, self.children[level][4 * np.maximum(node, 0) + quadrant])


_CORNERS = [(dx, dy, dc) for dx in (0, 1) for dy in (0, 1) for dc in (0, 1)]


class Pairs:
    """Sums for the rows of two blocks of a language: what leaves add, and how many terms neither row has."""

    def __init__(self, rest_a: np.ndarray, rest_b: np.ndarray, same: bool):
        self.rest = rest_a, rest_b
        self.same = same
        self.sums = np.zeros((len(rest_a), len(rest_b)), np.int64)
        self.zeros = np.zeros_like(self.sums)

    def _price_zeros(self, level: int, a: np.ndarray, b: np.ndarray, terms: np.ndarray) -> None:
        """Quadrants of a level that neither tree has: their terms count for all pairs of their rows."""
        held = np.zeros((1 << level, 1 << level), np.int64)
        np.add.at(held, (a, b), terms)
        rows = [np.arange(len(r)) >> (DEPTH - level) for r in self.rest]
        self.zeros += held[rows[0][:, None], rows[1]]

    def add(self, one: Tree, two: Tree, width: int) -> None:
        """Follow both trees over a block of ``width`` columns."""
        if one.root < 0 and two.root < 0:
            self.zeros += width
            return
        zero = np.zeros(1, np.int64)
        open_ = [(0, np.array([one.root]), np.array([two.root]), zero, zero, zero)]
        while open_:
            level, x, y, a, b, c = open_.pop()
            if level == DEPTH:
                p = np.where(x < 0, self.rest[0][a], one.prices[x])
                q = np.where(y < 0, self.rest[1][b], two.prices[y])
                np.add.at(self.sums, (a, b), (p - q) * (p - q) // (p + q))
                continue
            side = SIDE >> (level + 1)
            found = []
            for dx, dy, dc in _CORNERS:
                to = [one.down(level, x, 2 * dx + dc), two.down(level, y, 2 * dy + dc), 2 * a + dx, 2 * b + dy, 2 * c + dc]
                inside = (to[2] * side < len(self.rest[0])) & (to[3] * side < len(self.rest[1])) & (to[4] * side < width)
                if self.same:
                    inside &= to[2] <= to[3]
                found.append([v[inside] for v in to])
            x, y, a, b, c = (np.concatenate(v) for v in zip(*found, strict=True))
            none = (x < 0) & (y < 0)
            if none.any():
                self._price_zeros(level + 1, a[none], b[none], np.minimum(width - c[none] * side, side))
            x, y, a, b, c = (v[~none] for v in (x, y, a, b, c))
            for k in range(0, len(x), _NODES_AT_ONCE):
                cut = slice(k, k + _NODES_AT_ONCE)
                open_.append((level + 1, x[cut], y[cut], a[cut], b[cut], c[cut]))

    def values(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the first block, row of the second and the sum, each pair once."""
        p, q = self.rest[0][:, None], self.rest[1][None, :]
        total = self.sums + self.zeros * ((p - q) * (p - q) // np.maximum(p + q, 1))
        a, b = np.triu_indices(len(total), 1) if self.same else np.indices(total.shape).reshape(2, -1)
        return a, b, total[a, b]


def _build(table: pa.Table) -> pa.Table:
    row, col, prices = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "col", "p"))
    raw = tree(row % SIDE, col % SIDE, prices)
    head = {"lang": [table.column("lang")[0].as_py()], "block": [int(row[0]) // SIDE], "strip": [int(col[0]) // SIDE]}
    return pa.table(
        {"lang": pa.array(head["lang"], pa.string()), "block": pa.array(head["block"], pa.int64()),
         "strip": pa.array(head["strip"], pa.int64()), "tree": pa.array([raw], pa.binary())}
    )


_SUMS = "lang string, row bigint, row_2 bigint, value bigint"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, pairs = None, None

    def result():
        a, b, value = pairs.values()
        lang, block, block_2 = key
        for k in range(0, len(a), 1 << 17):
            cut = slice(k, k + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a[cut]), pa.string()), pa.array(a[cut] + block * SIDE), pa.array(b[cut] + block_2 * SIDE), pa.array(value[cut])],
                names=["lang", "row", "row_2", "value"],
            )

    for batch in batches:
        for r in batch.to_pylist():
            own = (r["lang"], r["block"], r["block_2"])
            if own != key:
                if pairs is not None:
                    yield from result()
                rest, rest_2 = (np.array(r[c], np.int64) for c in ("rest", "rest_2"))
                key, pairs = own, Pairs(rest, rest_2, r["block"] == r["block_2"])
            one = Tree(r["tree"])
            pairs.add(one, one if pairs.same else Tree(r["tree_2"]), r["width"])
    if pairs is not None:
        yield from result()


def _pair_sums(priced: Priced) -> DataFrame:
    """lang, row, row_2, value: each pair of sources of a language once."""
    block = F.floor(F.col("row") / SIDE).cast("bigint")
    trees = (
        priced.cells.select("lang", "row", "col", "p").groupBy("lang", block.alias("_b"), F.floor(F.col("col") / SIDE).alias("_s"))
        .applyInArrow(_build, "lang string, block bigint, strip bigint, tree binary")
    )
    rest = F.coalesce("rest", F.lit(1).cast("bigint"))
    blocks = priced.sources.groupBy("lang", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("row", rest.alias("rest"))))["rest"].alias("rest"),
        F.first("terms").alias("terms"),
        F.ceil(F.first("sources") / SIDE).alias("blocks"),
    )
    strips = F.greatest(F.ceil(F.col("terms") / SIDE), F.lit(1).cast("bigint"))
    squares = blocks.withColumn("strip", F.explode(F.sequence(F.lit(0).cast("bigint"), strips - 1))).join(
        trees, ["lang", "block", "strip"], "left"
    )
    width = F.least(F.col("terms") - F.col("strip") * SIDE, F.lit(SIDE).cast("bigint"))
    sides = squares.select(
        "lang", "strip", "block", "rest", "tree", width.alias("width"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"),
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    is_low, is_high = F.col("block") == low, F.col("block") == high
    met = sides.groupBy("lang", low.alias("_a"), high.alias("_b"), "strip").agg(
        F.first("width").alias("width"),
        *[
            F.first(F.when(which, F.col(c)), ignorenulls=True).alias(name)
            for c, which, name in (("rest", is_low, "rest"), ("rest", is_high, "rest_2"), ("tree", is_low, "tree"), ("tree", is_high, "tree_2"))
        ],
    )
    rows = met.withColumnsRenamed({"_a": "block", "_b": "block_2"}).sortWithinPartitions("lang", "block", "block_2", "strip")
    return rows.mapInArrow(_walk, _SUMS).groupBy("lang", "row", "row_2").agg(F.sum("value").alias("value"))


# reports


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.filter(F.col("rank") <= most)


def audit(docs: DataFrame, fewest: int = FEWEST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: every other source of the language with the sum of differences
    over all kept terms. ``term``: the ``top`` terms that the source has more
    of than the language, by difference.
    """
    priced = Priced(docs, fewest)
    names = priced.sources.select("lang", "source", "row")
    sums = _pair_sums(priced)
    both = sums.unionByName(sums.select("lang", F.col("row").alias("row_2"), F.col("row_2").alias("row"), "value"))
    other = names.select("lang", F.col("source").alias("item"), F.col("row").alias("row_2"))
    pairs = both.join(names, ["lang", "row"]).join(other, ["lang", "row_2"]).select("lang", "source", "item", "value")
    own = priced.cells.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")
    )
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(_ranked(pairs), "pair").unionByName(columns(_ranked(own, top), "term"))
