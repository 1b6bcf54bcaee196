"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every hash of a five-word shingle that lies in the lowest
``1 / scale`` of the hash range, and where these are fewer than LEAST, the LEAST
lowest hashes. So a sketch holds all hashes of its text below a limit, which the
sketch itself tells: that of the range, or its own last hash, or none where it
holds everything. Sketches of unequal documents are compared below the lower of
both limits, and the share of one found in the other estimates containment
however unequal the sizes are. The sketch of two texts together follows from
both sketches exactly. Only DataFrame functions are used.

Defined cases: a null text counts as empty; a text without words has an empty
sketch; with fewer than five words the whole sequence is the only shingle; very
long texts are read whole. Two empty sketches are alike (1.0), an empty and a
full one are not (0.0). Rows with equal ids follow each other in the order of
their texts, repeated rows are each other's next; rows without an id come last;
an empty table gives an empty result. Columns of the input other than
doc_id and text are not looked at by ``compare_edited``; ``with_sketch``
replaces a column of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_width
from .frames import fresh

SHINGLE = 5
SCALE = 8
#: Bits of a hash that a sketch keeps.
KEPT_BITS = 48
#: Hashes that a sketch has at least, if the text has as many.
LEAST = 32


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _threshold(scale: int) -> Column:
    return F.lit((1 << KEPT_BITS) // scale)


def with_sketch(docs: DataFrame, text: str = "text", name: str = "sketch", scale: int = SCALE) -> DataFrame:
    """All rows with the sorted distinct hashes of the sketch (each ``KEPT_BITS`` bits)."""
    h, s = fresh("words"), fresh("shingles")
    word = F.col(h)
    whole = F.transform(
        F.sequence(F.lit(0), F.size(word) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(SHINGLE)]),
    )
    shingles = (
        F.when(F.size(word) >= SHINGLE, whole)
        .when(F.size(word) > 0, F.array(F.xxhash64(word)))
        .otherwise(F.array().cast("array<bigint>"))
    )
    # shifted so that the order of signed numbers is that of the hashes
    short = F.transform(F.col(s), lambda x: F.shiftrightunsigned(x, 64 - KEPT_BITS))
    below = F.array_distinct(F.filter(short, lambda x: x < _threshold(scale)))
    lowest = F.slice(F.sort_array(F.array_distinct(short)), 1, LEAST)
    sketch = F.when(F.size(below) >= LEAST, F.sort_array(below)).otherwise(lowest)
    return (
        docs.withColumn(h, F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)))
        .withColumn(s, shingles)
        .withColumn(name, sketch)
        .drop(h, s)
    )


def as_text(sketch: Column) -> Column:
    """The sketch as a string: each hash in hexadecimal digits of fixed width."""
    width = KEPT_BITS // 4
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), width, "0"))), "")


def limit(sketch: Column, scale: int = SCALE) -> Column:
    """Below this, a sketch holds all hashes of its text."""
    last = F.greatest(_threshold(scale), F.element_at(sketch, -1) + 1)
    return F.when(F.size(sketch) < LEAST, F.lit(1 << KEPT_BITS)).otherwise(last)


def _comparable(a: Column, b: Column, scale: int) -> tuple[Column, Column]:
    """Both sketches below the lower of their limits."""
    top = F.least(limit(a, scale), limit(b, scale))
    return F.filter(a, lambda x: x < top), F.filter(b, lambda x: x < top)


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated share of all shingles of both texts that both have."""
    x, y = _comparable(a, b, scale)
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).when(union == 0, F.lit(0.0)).otherwise(both / union)


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated share of a's shingles that b has too."""
    x, y = _comparable(a, b, scale)
    part = F.size(F.array_intersect(x, y)) / F.nullif(F.size(x), F.lit(0))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.coalesce(part, F.lit(0.0)))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of both texts together: that of the union of their shingles."""
    all_ = F.sort_array(F.array_union(a, b))
    below = F.filter(all_, lambda x: x < _threshold(scale))
    return F.when(F.size(below) >= LEAST, below).otherwise(F.slice(all_, 1, LEAST))


def _range_number(docs: DataFrame, ranges: int) -> Column:
    """Number of the range of ids a row lies in; ranges hold about as many rows each."""
    shares = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("b")).first()["b"]
    bounds = sorted(set(found or []))
    if not bounds:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    held, n = F.lit(bounds), len(bounds)
    steps = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    place = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.get(held, at + step - 1) < F.col("doc_id")), at + step
        ).otherwise(at),
    )
    return F.when(F.col("doc_id").isNull(), -1).otherwise(place)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text, sketch, next_text and next_sketch: of the next row by descending id, after the last the first.

    Rows are dealt to ranges of ids, one exchange of the texts. Every range also
    gets the first row of the range after it, so that its last row finds its
    successor; these are as many rows as there are ranges.
    """
    ranges = ranges or 4 * shuffle_width(docs.sparkSession)
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("_range", _range_number(own, ranges))
    heads = own.groupBy("_range").agg(F.max("doc_id").alias("_head"))
    # one row per range
    down = Window.orderBy(F.desc("_range"))
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        F.col("_range").alias("_to"), F.coalesce(F.lead("_range").over(down), F.first("_range").over(whole)).alias("_from")
    )
    firsts = (
        own.join(F.broadcast(heads.withColumnRenamed("_range", "_of")), F.expr("_range = _of and doc_id <=> _head"))
        .groupBy("_range")
        .agg(F.min("text").alias("text"))
        .join(F.broadcast(after), F.col("_range") == F.col("_from"))
        .select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", F.col("_to").alias("_range"))
    )
    rows = with_sketch(own).withColumn("_borrowed", F.lit(0)).unionByName(
        with_sketch(firsts).withColumn("_borrowed", F.lit(1))
    )
    w = Window.partitionBy("_range").orderBy("_borrowed", F.col("doc_id").desc_nulls_last(), "text")
    following = rows.withColumns({"next_text": F.lead("text").over(w), "next_sketch": F.lead("sketch").over(w)})
    return following.filter("_borrowed = 0").select("doc_id", "text", "sketch", "next_text", "next_sketch")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form.

    The edited text ends in the beginning of the next document's instead of its
    own last third.
    """
    pairs = with_next(docs)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    begin = lambda c, k: F.substring(F.col(c), F.lit(1), k)
    edited = pairs.withColumn("_edited", F.concat(begin("text", n - third), begin("next_text", third))).select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        "sketch",
        "next_sketch",
        "_edited",
    )
    both = with_sketch(edited, "_edited", "_edited_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("_edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("_edited_sketch"), F.col("sketch")).alias("edited_containment"),
    )
