"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

#: A word: code points other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch. Rows are whole texts here, so Spark's own 10,000 would make large batches.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_session(spark: SparkSession) -> SparkSession:
    """The session with the options of this library, and small batches unless it names its own size."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return prepare(spark)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether a document is kept from training. Without an id it always is."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(True))


def fresh(stem: str) -> str:
    """A column name that no table of a caller has."""
    return f"_{stem}_{uuid.uuid4().hex[:12]}"


def add_columns(docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Columns are added; those of the same name are replaced."""
    return docs.drop(*[c for c in docs.columns if c in new]).withColumns(new)


def sized(texts: Column) -> Column:
    return F.octet_length(F.coalesce(texts, F.lit("")))
