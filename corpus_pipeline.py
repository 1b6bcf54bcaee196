"""From raw documents to token ids: the stages of a training-data pipeline.

Each stage takes what the one before kept, written and read again. All but the
last return the columns of documents: doc_id, text, lang, source, n_chars and
any others, whatever their names, unchanged but for text and n_chars where
personal data is replaced. Other columns are no input of any decision.

Defined cases, for every stage: a null text counts as empty and stays null; an
empty table gives an empty one; texts of any length are read whole. Rows are
told apart by id and text where a decision is about rows. What is said of a row
without an id, of a repeated one and of ties is with each stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import bpe, mixing, neardup, pii, toxicity
from strataloom.llm.frames import fresh, held_out, text_session
from strataloom.session import pin, scratch_path, scratch_run

#: Documents this alike (shingles in a hundred of the union) are copies.
ALIKE = 80
#: Probability from which a document is toxic.
TOXIC = 0.5

#: SQL can express neither the classifier nor the byte-pair merges.
ORACLE_SQL = None


def beside(docs: DataFrame, inputs: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after a stage that sees ``inputs`` and one column that holds all others.

    So no column of the stage's own can be taken for one of the documents.
    """
    held = fresh("held")
    others = [c for c in docs.columns if c not in inputs]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(others)]) if others else F.lit(None)
    done = stage(docs.select(*inputs, packed.alias(held)))
    return done.select(
        *[F.col(c) if c in inputs else F.col(held)[f"_{others.index(c)}"].alias(c) for c in docs.columns]
    )


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.

    The decision hangs on the text alone, so repeated rows stay or go together;
    a probability of TOXIC itself is rejected. Rows without an id teach nothing
    and are judged like others.
    """
    labels = text_session(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(docs.select("doc_id", "text"), labels, ~held_out(F.col("doc_id"), 5, 0))
    return beside(docs, ["text"], lambda rows: toxicity.score(rows, model, threshold=TOXIC).filter("predicted = 0"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Of repeated rows one stays. Documents without words, or without an id, are
    copies of nothing and stay.
    """
    text_session(spark)
    return beside(docs, ["doc_id", "text"], lambda rows: neardup.dedup(rows, percent=ALIKE))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind; n_chars, where there is one, follows.

    What is replaced hangs on the text and on what all texts together teach;
    repeated rows come out alike, rows without an id are cleaned like others.
    """
    text_session(spark)
    cleaned = beside(docs, ["doc_id", "text"], pii.redact)
    length = F.char_length("text").cast("bigint").alias("n_chars")
    return cleaned.select(*[length if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for.

    A null source is a source like others. Repeated rows are drawn alike, rows
    without an id by their text.
    """
    text_session(spark)
    return beside(docs, ["doc_id", "text", "source"], mixing.mixed)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every text, and the text that they decode to.

    A null or empty text has no ids and decodes to the empty one; every row is
    encoded, also repeated ones and those without an id.
    """
    text_session(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    # written between the two, so that a task has one Python worker with its tables and not two
    coded = pin(bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, keep_text=False), "coded")
    return bpe.decode(coded, path).select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").alias("text")
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written once; what a stage wrote beside its result goes with it."""
    docs = text_session(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_run(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
