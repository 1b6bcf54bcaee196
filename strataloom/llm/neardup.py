"""Near-duplicates by a chosen-path similarity join over word shingles.

1. Texts with equal shingle sets form a class; the rest of the work sees one
   row per class: its smallest document id and a minwise signature.
2. Trees. In each of ``trees`` independent trees a class goes to the node named
   by one of its minwise values. Nodes with at most ``leaf`` classes are
   compared exhaustively by signature; larger ones branch, every class going on
   to the nodes named by its values at ``branches`` positions that the node
   chooses. A pair of similarity s meets in a tree's root level with probability
   s and survives a level with 1 - (1 - s) ** branches, so the trees miss a pair
   at 0.85 with a probability below 1e-5. Texts that share no more than a
   passage part after a level or two; nodes still large after ``depth`` levels
   agree at as many positions more and are joined whole.
3. The pairs found this way, with a margin of four standard errors below the
   threshold, are only a net: their connected components are clusters that no
   link leaves. Each cluster gets the full shingle sets of its classes, once,
   and links are decided on them. Pairs already in one component are skipped. A
   cluster too large for one task is cut into blocks and every two blocks meet
   in a task, so nothing is dropped.
4. The components of the confirmed links give each class its smallest id.

Defined cases: a text without words has the empty set and is linked with
nothing; rows without an id are not linked, have no component and are kept;
rows with equal ids are joined to the components of their own texts, and each
gets a row; an empty table gives an empty result. Columns of the input other
than doc_id and text pass through ``dedup`` and are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .frames import fresh
from .groups import components
from .keyfilter import key_filter
from .textscan import Run, hash_spans, lowered, mixed, runs, spread, window_hash, words

SHINGLE = 5
SIZE = 64
_SEEDS = np.array([int(spread(1000 + k)) | 1 for k in range(SIZE)], np.uint64)
#: Bounds of one exact comparison task: classes, and shingles of all of them.
BLOCK_CLASSES = 2048
BLOCK_SHINGLES = 4_000_000


def shingles(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a run, sorted within their rows, and the rows."""
    w = words(run)
    h = hash_spans(lowered(run.data), w.start, w.end)
    n = run.hi - run.lo
    full, where = window_hash(h, w.row, SHINGLE)
    row = w.row[where]
    count = np.bincount(w.row, minlength=n)
    for k in np.flatnonzero((count > 0) & (count < SHINGLE)):
        own = h[np.searchsorted(w.row, k) : np.searchsorted(w.row, k, side="right")]
        # the length is part of it, so that no sequence equals a longer one's shingle
        acc = np.array([len(own)], np.uint64)
        for x in own:
            acc = mixed(acc * np.uint64(31) + x)
        full, row = np.append(full, acc), np.append(row, k)
    order = np.lexsort((full, row))
    full, row = full[order], row[order]
    if len(full) == 0:
        return full, row
    first = np.append(True, (full[1:] != full[:-1]) | (row[1:] != row[:-1]))
    return full[first], row[first]


def signatures(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Minwise values (one row per set) of sets laid one after another."""
    out = np.empty((len(begin), SIZE), np.uint32)
    for k, a in enumerate(_SEEDS):
        out[:, k] = np.minimum.reduceat(((h ^ (a >> np.uint64(7))) * a) >> np.uint64(32), begin)
    return out


def _classes_of(h: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """16 bytes per set that depend on its members alone."""
    one = np.add.reduceat(mixed(h + np.uint64(1)), begin)
    two = np.add.reduceat(mixed(h ^ np.uint64(0x5DEECE66D)), begin)
    return [a.tobytes() + b.tobytes() for a, b in zip(one, two, strict=True)]


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, c (the class; null for the empty set), signature and text hash t of every row."""

    def task(batches):
        for batch in batches:
            for run in runs(batch, "text"):
                n = run.hi - run.lo
                h, row = shingles(run)
                count = np.bincount(row, minlength=n).astype(np.int64)
                filled = np.flatnonzero(count)
                c, sig = [None] * n, [None] * n
                if len(filled):
                    begin = np.searchsorted(row, filled)
                    for k, own, values in zip(filled, _classes_of(h, begin), signatures(h, begin), strict=True):
                        c[k], sig[k] = own, values.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(run.lo, n), pa.array(count), pa.array(c, pa.binary()), pa.array(sig, pa.binary()),
                     batch.column(2).slice(run.lo, n)],
                    names=["doc_id", "n_shingles", "c", "sig", "t"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", "text", _text_hash().alias("t"))
    return read.mapInArrow(task, f"doc_id {kind}, n_shingles long, c binary, sig binary, t long")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _nodes(batches, key: str) -> Iterator[tuple[object, pa.RecordBatch]]:
    """Whole groups of rows with equal keys, from rows sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if len(batch) == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        cuts = np.append(cuts, len(keys))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if held and held[0].column(held[0].schema.get_field_index(key))[0].as_py() != keys[lo]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _forest(sig: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges that span the rows whose signatures agree at ``least`` positions or more."""
    left, out = np.arange(len(sig)), []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = (sig[left] == sig[at]).sum(axis=1) >= least
            found, left = left[near], left[~near]
            out += [(int(at), int(x)) for x in found]
            todo += found.tolist()
    return out


def _leaf_pairs(leaves: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) between classes of one node; rows have node, c and sig."""

    def task(batches):
        for group in _nodes(batches, "node"):
            c = group.column(group.schema.get_field_index("c"))
            flat = b"".join(group.column(group.schema.get_field_index("sig")).to_pylist())
            sig = np.frombuffer(flat, np.uint32).reshape(len(group), SIZE)
            pairs = _forest(sig, least)
            if pairs:
                a, b = (c.take(pa.array([p[k] for p in pairs])) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    placed = leaves.select("node", "c", "sig").repartition("node").sortWithinPartitions("node")
    return placed.mapInArrow(task, "a binary, b binary")


def _value(place: Column) -> Column:
    return F.substring(F.col("sig"), place * 4 + 1, F.lit(4))


def net(reps: DataFrame, least: int, trees: int, branches: int, leaf: int, depth: int) -> DataFrame:
    """Edges between classes that may be similar; ``reps`` holds c and sig."""
    sig = reps.select(F.col("c").alias("_c"), "sig")
    step = SIZE // trees
    roots = [F.xxhash64(F.lit(t), _value(F.lit(t * step))) for t in range(trees)]
    rows = reps.select(F.explode(F.array(*roots)).alias("node"), "c")
    parts = []
    for level in range(depth + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        shared = pin(rows.join(sizes, "node"), "nodes")
        leaves = shared.filter(F.col("size") <= leaf).join(sig, F.col("c") == F.col("_c"))
        parts.append(pin(_leaf_pairs(leaves, least), "net"))
        large = shared.filter(F.col("size") > leaf)
        if large.isEmpty():
            break
        if level == depth:
            first = large.groupBy("node").agg(F.min("c").alias("a"))
            parts.append(pin(large.join(first, "node").select("a", F.col("c").alias("b")), "net"))
            break
        chosen = [F.pmod(F.xxhash64("node", F.lit(k)), F.lit(SIZE)).cast("int") for k in range(branches)]
        paths = F.array(*[F.xxhash64("node", F.lit(k), _value(p)) for k, p in enumerate(chosen)])
        rows = large.join(sig, F.col("c") == F.col("_c")).select(F.explode(paths).alias("node"), "c")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` in a hundred of their union."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(sets: list[np.ndarray], percent: int, least: int) -> list[tuple[int, int]]:
    """Links that span the components of all links between the sets.

    Likely pairs come first, by how far their signatures agree; a pair whose
    ends are already joined is skipped. Every other pair is decided on the sets.
    """
    n = len(sets)
    if n == 2:
        return [(0, 1)] if linked(sets[0], sets[1], percent) else []
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    sig = signatures(np.concatenate(sets), begin)
    root = np.arange(n)
    out = []
    top = SIZE + 1
    while top > 0:
        low = max(least, top - 6) if top > least else 0
        for i in range(n - 1):
            rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
            if len(rest) == 0:
                continue
            same = (sig[rest] == sig[i]).sum(axis=1)
            for j in rest[(same >= low) & (same < top)]:
                if root[i] != root[j] and linked(sets[i], sets[j], percent):
                    out.append((i, int(j)))
                    root[root == root[j]] = root[i]
        top = low
    return out


def _full_sets(docs: DataFrame, members: DataFrame, near: Callable[[Column], Column]) -> DataFrame:
    """task, c and the sorted set of each class, from the text of the class's document.

    Texts that ``near`` refuses are in no cluster and are not moved.
    """

    def task(batches):
        for batch in batches:
            want = batch.column(batch.schema.get_field_index("c"))
            at = batch.column(batch.schema.get_field_index("task"))
            for run in runs(batch, "text"):
                h, row = shingles(run)
                filled, begin = np.unique(row, return_index=True)
                keep, sets = [], []
                if len(filled):
                    ends = np.append(begin[1:], len(h))
                    for k, own, lo, hi in zip(filled, _classes_of(h, begin), begin, ends, strict=True):
                        if want[run.lo + int(k)].as_py() == own:
                            keep.append(run.lo + int(k))
                            sets.append(h[lo:hi].tobytes())
                picked = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [at.take(picked), want.take(picked), pa.array(sets, pa.binary())], names=["task", "c", "members"]
                )

    texts = docs.select("doc_id", "text").filter("doc_id is not null").filter(near(F.xxhash64("doc_id")))
    # the members grow with the corpus, so they are never broadcast
    wanted = members.select(F.col("rep").alias("_rep"), "c", "task").hint("merge")
    found = texts.join(wanted, F.col("doc_id") == F.col("_rep"))
    return found.select("text", "c", "task").mapInArrow(task, "task array<string>, c binary, members binary")


def _links(docs: DataFrame, members: DataFrame, percent: int, least: int) -> DataFrame:
    """Confirmed links (a, b) that span the components; ``members`` holds c, rep, cluster and n_shingles."""
    weight = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    block = F.pmod(F.xxhash64("c"), F.col("_blocks")).cast("int")
    # the pairs of blocks that a class's own block is in; one for a cluster of one block
    meets = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda k: F.concat_ws(":", F.hex("cluster"), F.least(k, F.col("_block")), F.greatest(k, F.col("_block"))),
    )
    dealt = (
        members.join(weight.select("cluster", blocks.alias("_blocks")), "cluster")
        .withColumn("_block", block)
        .select("c", "rep", meets.alias("task"))
    )

    def task(batches):
        for group in _nodes(batches, "task"):
            names = group.column(group.schema.get_field_index("c")).to_pylist()
            held = dict(zip(names, group.column(group.schema.get_field_index("members")).to_pylist(), strict=True))
            if len(held) < 2:
                continue
            c = sorted(held)
            pairs = confirmed([np.frombuffer(held[x], np.uint64) for x in c], percent, least)
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[i] for i, _ in pairs], pa.binary()), pa.array([c[j] for _, j in pairs], pa.binary())],
                    names=["a", "b"],
                )

    sets = _full_sets(docs, dealt, key_filter(members.select(F.xxhash64("rep")))).select(F.explode("task").alias("task"), "c", "members")
    placed = sets.repartition("task").sortWithinPartitions("task")
    return placed.mapInArrow(task, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    trees: int = 8,
    branches: int = 2,
    leaf: int = 2000,
    depth: int = 3,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    rows = _judged(docs, percent, trees, branches, leaf, depth)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _judged(docs: DataFrame, percent: int, trees: int, branches: int, leaf: int, depth: int) -> DataFrame:
    """doc_id, n_shingles, t, c, component_id and first (the class that stands for the component) of every row."""
    share = percent / 100
    least = int(SIZE * share - 4 * (SIZE * share * (1 - share)) ** 0.5)
    rows = pin(described(docs), "described")
    known = rows.filter("c is not null and doc_id is not null")
    reps = pin(
        known.groupBy("c").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")),
        "reps",
    )
    clusters = components(net(reps, least, trees, branches, leaf, depth)).select(
        F.col("v").alias("c"), F.col("label").alias("cluster")
    )
    members = pin(reps.select("c", "rep", "n_shingles").join(clusters, "c"), "members")
    labels = components(pin(_links(docs, members, percent, least), "confirmed")).withColumnRenamed("v", "c")
    joined = reps.select("c", "rep").join(labels, "c")
    smallest = joined.groupBy("label").agg(F.min(F.struct("rep", "c")).alias("_least"))
    linked_classes = joined.join(smallest, "label").select(
        "c", F.col("_least.rep").alias("component_id"), F.col("_least.c").alias("first")
    )
    found = reps.select("c", "rep").join(linked_classes, "c", "left").select(
        F.col("c").alias("_c"), F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("first", "c").alias("first")
    )
    own = F.when(F.col("c").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return rows.join(found, F.col("c") == F.col("_c"), "left").select(
        "doc_id",
        "n_shingles",
        "t",
        "c",
        own.alias("component_id"),
        "first",
    )


def dedup(
    docs: DataFrame,
    percent: int = 85,
    trees: int = 8,
    branches: int = 2,
    leaf: int = 2000,
    depth: int = 3,
) -> DataFrame:
    """One row of each component, of the smallest id, and the rows that are in none; all columns.

    Rows are told apart by id and text, so what is said of one text of an id
    does not touch its others. Of rows with equal sets the smallest text hash
    stays, of rows with equal id and text any one.
    """
    judged = _judged(docs, percent, trees, branches, leaf, depth).filter("doc_id is not null and c is not null")
    texts = pin(judged.groupBy("doc_id", "t", "c", "component_id", "first").agg(F.count(F.lit(1)).alias("n")), "texts")
    least = (
        texts.filter("doc_id = component_id and c = first").groupBy("doc_id", "c").agg(F.min("t").alias("_t"))
        .select(F.col("doc_id").alias("_id"), F.col("c").alias("_c"), "_t")
    )
    stays = (F.col("doc_id") == F.col("_id")) & (F.col("c") == F.col("_c")) & (F.col("t") == F.col("_t"))
    key, text_hash = fresh("id"), fresh("hash")
    named = lambda df: df.select(F.col("doc_id").alias(key), F.col("t").alias(text_hash))
    same = (F.col("doc_id") == F.col(key)) & (_text_hash() == F.col(text_hash))
    gone = pin(named(texts.join(least, stays, "left_anti")), "gone")
    again = pin(named(texts.filter("n > 1").join(least, stays, "left_semi")), "again")
    # most rows are in neither table and stay where they are; what the filter lets through the joins decide
    asked = key_filter(gone.unionByName(again).select(F.xxhash64(key, text_hash)))(F.xxhash64("doc_id", _text_hash()))
    clear, left = docs.filter(~asked), docs.filter(asked).join(gone, same, "left_anti")
    if again.isEmpty():
        return clear.unionByName(left)
    once = left.join(again, same).dropDuplicates([key, text_hash]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return clear.unionByName(left.join(again, same, "left_anti")).unionByName(once)
