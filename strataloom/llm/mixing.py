"""Mixing sources to target weights by repetition rates.

Tokens are summed per source; a source's rate is its target divided by what it
has. A document is emitted floor(rate) times, and once more with a probability
equal to the fraction, drawn from a hash of its id.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; sources of size 0 have target 0 and their documents are emitted
once; repeated rows draw alike; rows without an id draw by their text. An empty
table gives an empty result. Columns of the input with the names of the result
columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import pin
from .frames import WORD, add_columns, fresh

WEIGHTS = (5, 2, 1)
_HEX = 13


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id alone, or on the text where there is no id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit("none")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, _HEX), 16, 10).cast("bigint") / F.lit(16.0**_HEX)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """source, source_size, target.

    Sources in order take the weights in turn and share ``share`` of all
    tokens; none gets above ``most`` times what it has, and what it cannot take
    goes to the others by weight. Each round caps every source above the level
    that the remaining ones would share, so the level only rises and the rounds
    end. The table has one row per source and only totals reach the driver.
    """
    per = pin(sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")), "sources")
    placed = number_rows(per, [F.col("source").asc_nulls_last()], "_place")
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    weighed = pin(
        placed.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)).drop("_place"),
        "weights",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    top = F.lit(most) * F.col("source_size")
    while total:
        full = top <= F.lit(level) * F.col("_w")
        capped, open_weight = weighed.agg(
            F.sum(F.when(full, top).otherwise(F.lit(0.0))), F.sum(F.when(full, 0).otherwise(F.col("_w")))
        ).first()
        if not open_weight:
            break
        risen = (share * total - capped) / open_weight
        if risen <= level:
            break
        level = risen
    return weighed.select("source", "source_size", F.least(top, F.lit(level) * F.col("_w")).alias("target"))


def _rated(docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: str) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns, with new columns under names that are free, and these names."""
    names = {c: fresh(c) for c in ("size", "source_size", "target", "copies")}
    key, rate = fresh("key"), fresh("rate")
    sizes = docs.select("source", words_of(F.col("text")).alias("size"))
    targets = source_targets(sizes, weights, share, most).select(
        F.col("source").alias(key),
        F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]),
    )
    joined = docs.withColumn(names["size"], words_of(F.col("text"))).join(targets, F.col("source").eqNullSafe(F.col(key)))
    had = F.col(names["source_size"])
    joined = joined.withColumn(rate, F.when(had > 0, F.col(names["target"]) / had).otherwise(F.lit(1.0)))
    more = draw(F.col("doc_id"), F.col("text"), seed) < F.col(rate) - F.floor(rate)
    copies = F.floor(rate) + F.when(more, 1).otherwise(0)
    return joined.withColumn(names["copies"], copies).drop(key, rate), names


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """All rows with size, source_size, target and copies (how often the mix holds the document)."""
    rated, names = _rated(docs, weights, share, most, seed)
    return add_columns(rated, {c: F.col(name) for c, name in names.items()}).drop(*names.values())


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: the documents' own columns, each row as often as it is taken."""
    rated, names = _rated(docs, weights, share, most, seed)
    times, copies = fresh("time"), F.col(names["copies"])
    own = [F.col(f"`{c}`") for c in docs.columns]
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias(times)
    return rated.filter(copies > 0).select(*own, each).drop(times)
