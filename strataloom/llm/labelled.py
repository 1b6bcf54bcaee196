"""A bounded sample of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, teach: Column, per_class: int) -> DataFrame:
    """text and y of about ``per_class`` documents with label 0 and as many with label 1.

    Chosen by a hash of the id among the rows where ``teach`` holds. Labels
    other than 0 and 1, and rows without an id or a text, are not used. An id
    labelled both ways counts as 1; all rows of a chosen id are in the sample.
    Where ids repeat so often that these are more than 4 * per_class, those
    with the smallest hashes of id and text are taken, so the sample of a table
    is always the same.
    """
    known = labels.filter(teach & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("y")
    ).filter("y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, per_class / max(1, sizes.get(1, 0))).otherwise(per_class / max(1, sizes.get(0, 0)))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # about 2 * per_class rows
    chosen = known.filter(drawn < share).limit(3 * per_class)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    found = texts.join(F.broadcast(chosen), "doc_id")
    order = [F.xxhash64("doc_id"), F.xxhash64("text"), F.col("y")]
    return found.orderBy(*order).limit(4 * per_class).select("y", "text")
