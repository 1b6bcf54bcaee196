"""Toxicity: averaged subword-bag embeddings and a linear softmax, learnt together in numpy.

The n-grams of 3 to 6 bytes inside words share hashed embeddings, so unseen
spellings of a word are scored by the pieces they share with known ones. The
model is fitted on a bounded sample, about ``per_class`` labelled documents of
each label; a fifth of it is kept to calibrate the probabilities.

Defined cases: a null or empty text, or any text where nothing could be learnt,
gets the score that the bias alone gives; very long texts are scored whole;
repeated rows get equal scores; rows without an id teach nothing; an empty table
gives an empty one. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .labelled import labelled_texts
from .subwords import RUN_BYTES, Grams, softmax, temperature, train
from .textscan import runs

GRAMS = Grams((3, 4, 5, 6), 17, blanks=200)


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    heat: float


def learnt(features: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Model:
    """The model of a sample whose rows are in a fixed order."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros((1 << GRAMS.bits, 1), np.float32), -2.0 if not y.sum() else 2.0, 1.0)
    test = np.arange(len(y)) % 5 == 4
    learn = np.flatnonzero(~test)
    # small samples need more rounds to take as many steps
    epochs = min(100, max(7, -(-30_000 // len(learn))))
    table, bias = train(
        [features[i] for i in learn], y[learn], 2, GRAMS.bits, dim=8, epochs=epochs, rate=0.1, scale=50.0, decay=1e-4
    )
    weight, shift = table[:, 1] - table[:, 0], float(bias[1] - bias[0])
    logit = np.array([weight[features[i][0]] @ features[i][1] + shift for i in np.flatnonzero(test)])
    heat = temperature(np.stack([np.zeros_like(logit), logit], axis=1), y[test])
    return Model(weight[:, None], shift, heat)


def fit(docs: DataFrame, labels: DataFrame, teach: Column, label: str = "toxic", per_class: int = 3000) -> Model:
    """Learn from a sample in one task: its texts stay in the executors, and only the weights reach the driver."""

    def task(batches):
        features, y = [], []
        for batch in batches:
            features += GRAMS.histograms(batch.column(1))
            y += batch.column(0).to_pylist()
        model = learnt(features, np.array(y, np.int64))
        columns = [pa.array([model.weight.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias]), pa.array([model.heat])]
        yield pa.RecordBatch.from_arrays(columns, names=["weight", "bias", "heat"])

    rows = labelled_texts(docs, labels, label, teach, per_class).repartition(1).sortWithinPartitions("y", "text")
    found = rows.mapInArrow(task, "weight binary, bias double, heat double").collect()
    if not found:
        return learnt([], np.empty(0, np.int64))
    return Model(np.frombuffer(found[0]["weight"], np.float32)[:, None], found[0]["bias"], found[0]["heat"])


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """All rows with score (probability of the label 1) and predicted (1 from ``threshold`` on)."""
    names = ["score", "predicted"]
    kept = [f for f in docs.schema.fields if f.name not in names]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = held.value
        for batch in batches:
            for run in runs(batch, size=RUN_BYTES):
                part = batch.slice(run.lo, run.hi - run.lo)
                logit = (GRAMS.means(run, m.weight)[:, 0] + m.bias) / m.heat
                p = softmax(np.stack([np.zeros_like(logit), logit], axis=1))[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    + [pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=[f.name for f in kept] + names,
                )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(task, T.StructType(kept + added))
