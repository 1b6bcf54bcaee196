"""Ordered per-key windows that stay balanced when one key holds most rows.

A window over ``partitionBy(key)`` puts all rows of a key into one task. Here
the few keys that are too large are cut along their order column into pieces;
windows run per (key, piece), and what a piece needs from its neighbours is
handed over as a small extra table:

* frames of a fixed number of rows get those rows copied in from the
  neighbouring pieces (``near``),
* running sums add the totals of the earlier pieces (``running``),
* "last value so far" takes the last value of an earlier piece (``latest``).

Results do not depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..session import pin, shuffle_width

HOT_ROWS = 1_000_000

_PIECE = "_piece"


#: Rows of a hot key that are looked at for each of its pieces.
SAMPLED = 200


@dataclass(frozen=True)
class Cuts:
    """Cut points of the hot keys: columns of the key and ``_cuts``, structs of the leading order
    columns, whose types are ``types``; no table if no key is hot."""

    table: DataFrame | None
    types: tuple[DataType, ...] = ()

    def renamed(self, old: str, new: str) -> Cuts:
        """The same cuts for a table that names the key differently."""
        return Cuts(None if self.table is None else self.table.withColumnRenamed(old, new), self.types)

    def prefix(self, depth: int) -> Cuts:
        """Cuts by the first order columns only, for a table that has no others in common."""
        if self.table is None or depth >= len(self.types):
            return self
        shorter = F.transform("_cuts", lambda c: F.struct(*[c[f"_{k}"].alias(f"_{k}") for k in range(depth)]))
        return Cuts(self.table.withColumn("_cuts", shorter), self.types[:depth])


class Timeline:
    """Rows of ``df`` per ``keys`` in the order of ``order``.

    ``order`` must order the rows of a key uniquely. Keys are cut between any
    two rows, also where the first order columns agree. Key sizes are counted
    from ``profile``, a cheaper table with the same keys and order columns, such
    as the plain scan the rows come from; where it has the first ones only, rows
    that agree in these stay together. ``cuts`` takes the finished result of
    ``find_cuts`` so that several timelines over one key share the count. Keys
    with at most ``hot_rows`` rows are never cut.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        profile: DataFrame | None = None,
        hot_rows: int | None = None,
        cuts: Cuts | None = None,
    ):
        self.keys = list(keys)
        self.order = list(order)
        if cuts is None:
            cuts = find_cuts(df if profile is None else profile, self.keys, self.order, hot_rows)
        cuts = cuts.prefix(len(self.order))
        self.split = cuts.table is not None
        if cuts.table is None:
            self._rows = df.withColumn(_PIECE, F.lit(0))
        else:
            # at most one row per shuffle partition
            joined = df.join(F.broadcast(cuts.table), self.keys, "left")
            self._rows = joined.withColumn(_PIECE, _piece_of(self.order, cuts.types)).drop("_cuts")

    @classmethod
    def _with(cls, base: "Timeline", rows: DataFrame) -> "Timeline":
        out = cls.__new__(cls)
        out.keys, out.order, out.split, out._rows = base.keys, base.order, base.split, rows
        return out

    @property
    def rows(self) -> DataFrame:
        return self._rows.drop(_PIECE)

    def derive(self, change: Callable[[DataFrame], DataFrame]) -> "Timeline":
        """Add or drop columns; keys and order columns must stay."""
        return self._with(self, change(self._rows))

    def _stored(self) -> DataFrame:
        """The rows written once: with cut keys every step reads them twice."""
        self._rows = pin(self._rows, "timeline")
        return self._rows

    def _window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, _PIECE).orderBy(*self.order)

    def near(
        self,
        before: int = 0,
        after: int = 0,
        **columns: Callable[[WindowSpec], Column],
    ) -> "Timeline":
        """Columns over windows that look at most ``before``/``after`` rows away."""
        w = self._window()
        exprs = {name: fn(w) for name, fn in columns.items()}
        if not self.split:
            return self._with(self, self._rows.withColumns(exprs))
        stored = self._stored()
        rows = stored.withColumn("_copy", F.lit(False))
        hot = stored.filter(F.col(_PIECE) > 0)
        if before:
            rows = rows.unionByName(self._handed_over(hot, before, forward=True))
        if after:
            rows = rows.unionByName(self._handed_over(hot, after, forward=False))
        out = rows.withColumns(exprs).filter(~F.col("_copy")).drop("_copy")
        return self._with(self, out)

    def _handed_over(self, hot: DataFrame, count: int, forward: bool) -> DataFrame:
        """Last (first) ``count`` rows before (after) each piece, labelled with that piece."""
        columns = hot.columns
        outward = [F.col(c).desc() if forward else F.col(c).asc() for c in self.order]
        edge = hot.withColumn(
            "_depth", F.row_number().over(Window.partitionBy(*self.keys, _PIECE).orderBy(*outward))
        ).filter(F.col("_depth") <= count)
        # at most count rows per piece from here on
        along = Window.partitionBy(*self.keys).orderBy(*self.order)
        frame = along.rowsBetween(-(count - 1), 0) if forward else along.rowsBetween(0, count - 1)
        reach = edge.withColumn("_near", F.collect_list(F.struct(*columns)).over(frame))
        per_piece = Window.partitionBy(*self.keys).orderBy(_PIECE)
        neighbour = F.lead(_PIECE) if forward else F.lag(_PIECE)
        ends = (
            reach.filter(F.col("_depth") == 1)
            .withColumn("_to", neighbour.over(per_piece))
            .filter(F.col("_to").isNotNull())
        )
        copies = ends.select(F.explode("_near").alias("_r"), "_to")
        kept = [F.col(f"_r.{c}").alias(c) for c in columns if c != _PIECE]
        return copies.select(*kept, F.col("_to").alias(_PIECE), F.lit(True).alias("_copy"))

    def running(self, **columns: Column) -> "Timeline":
        """Sum of each column over all rows of the key up to the current one."""
        so_far = self._window().rowsBetween(Window.unboundedPreceding, 0)
        local = {name: F.sum(c).over(so_far) for name, c in columns.items()}
        if not self.split:
            return self._with(self, self._rows.withColumns(local))
        stored = self._stored()
        hot = stored.filter(F.col(_PIECE) > 0)
        totals = hot.groupBy(*self.keys, _PIECE).agg(
            *[F.sum(c).alias(f"_sum_{name}") for name, c in columns.items()]
        )
        earlier = Window.partitionBy(*self.keys).orderBy(_PIECE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = totals.select(
            *self.keys,
            _PIECE,
            *[F.sum(f"_sum_{name}").over(earlier).alias(f"_sum_{name}") for name in columns],
        )
        # one row per piece of a hot key: at most three times the shuffle width
        rows = stored.withColumns(local).join(
            F.broadcast(carried), [*self.keys, _PIECE], "left"
        )
        both = {
            name: F.when(F.col(f"_sum_{name}").isNull(), F.col(name)).otherwise(
                F.coalesce(F.col(name), F.lit(0)) + F.col(f"_sum_{name}")
            )
            for name in columns
        }
        out = rows.withColumns(both).drop(*[f"_sum_{name}" for name in columns])
        return self._with(self, out)

    def number(self, name: str = "row_num") -> "Timeline":
        """1, 2, 3 … within the key."""
        return self.running(**{name: F.lit(1).cast("bigint")})

    def latest(self, **columns: Column) -> "Timeline":
        """Last non-NULL value of each column up to and including the current row."""
        so_far = self._window().rowsBetween(Window.unboundedPreceding, 0)
        local = {name: F.last(c, ignorenulls=True).over(so_far) for name, c in columns.items()}
        if not self.split:
            return self._with(self, self._rows.withColumns(local))
        stored = self._stored()
        hot = stored.filter(F.col(_PIECE) > 0)
        at = F.struct(*self.order)
        ends = hot.groupBy(*self.keys, _PIECE).agg(
            *[
                F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_last_{name}")
                for name, c in columns.items()
            ]
        )
        earlier = Window.partitionBy(*self.keys).orderBy(_PIECE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = ends.select(
            *self.keys,
            _PIECE,
            *[
                F.last(f"_last_{name}", ignorenulls=True).over(earlier).alias(f"_last_{name}")
                for name in columns
            ],
        )
        rows = stored.withColumns(local).join(
            F.broadcast(carried), [*self.keys, _PIECE], "left"
        )
        both = {name: F.coalesce(F.col(name), F.col(f"_last_{name}")) for name in columns}
        out = rows.withColumns(both).drop(*[f"_last_{name}" for name in columns])
        return self._with(self, out)


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], hot_rows: int | None = None
) -> Cuts:
    """Cut points per hot key, by those leading columns of ``order`` that ``df`` has.

    Only the ``width`` largest keys can hold more than 1/width of the rows, so
    looking at these is enough, and the list collected here has at most
    ``width`` entries. The pieces of all keys together number at most
    ``2 * width``, and SAMPLED rows for each are sorted to find the cuts.
    Results do not depend on which rows these are.
    """
    hot_rows = hot_rows or HOT_ROWS
    order = [order] if isinstance(order, str) else list(takewhile(lambda c: c in df.columns, order))
    spark = df.sparkSession
    width = shuffle_width(spark)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.orderBy(F.col("_n").desc()).limit(width).filter(F.col("_n") > hot_rows)
    hot = largest.collect()
    if not hot:
        return Cuts(None)
    total = sum(r["_n"] for r in hot)
    pieces = [max(2, min(-(-r["_n"] // hot_rows), -(-width * r["_n"] // total))) for r in hot]
    found = [(*[r[k] for k in keys], p, min(1.0, SAMPLED * p / r["_n"])) for r, p in zip(hot, pieces, strict=True)]
    schema = df.select(*keys).schema.add("_pieces", "integer").add("_share", "double")
    at = F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(order)])
    sampled = (
        df.select(*keys, at.alias("_at"))
        .join(F.broadcast(spark.createDataFrame(found, schema)), list(keys))
        .filter(F.rand(17) < F.col("_share"))
        .groupBy(*keys, "_pieces")
        .agg(F.array_sort(F.collect_list("_at")).alias("_all"))
    )
    picked = F.transform(
        F.sequence(F.lit(1), F.col("_pieces") - 1),
        lambda i: F.element_at("_all", F.greatest(F.lit(1), F.ceil(i * F.size("_all") / F.col("_pieces"))).cast("int")),
    )
    cut_df = sampled.select(*keys, picked.alias("_cuts"))
    table = spark.createDataFrame(cut_df.collect(), cut_df.schema)
    return Cuts(table, tuple(df.schema[c].dataType for c in order))


def _piece_of(order: Sequence[str], types: Sequence[DataType]) -> Column:
    """1 + number of cuts not above the row, by bisection; 0 where the key has no cuts."""
    own = F.struct(*[F.col(c).cast(kind).alias(f"_{k}") for k, (c, kind) in enumerate(zip(order, types))])
    steps = F.array(*[F.lit(1 << b) for b in range(20, -1, -1)])
    size = F.size("_cuts")
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= size) & (F.element_at("_cuts", F.least(at + step, size)) <= own), at + step
        ).otherwise(at),
    )
    return F.when(F.col("_cuts").isNull(), 0).when(size == 0, 1).otherwise(1 + found)
