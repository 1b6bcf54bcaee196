"""Language identification: averaged hashed subword embeddings and a linear softmax.

Trained in numpy by stochastic gradient descent on a bounded sample: about
``per_language`` documents of each language, chosen by a hash of id and text.
With more than ``languages`` languages each gets fewer documents and none is left out. A fifth of the sample
is kept from training and sets the temperature of the probabilities and the
confidence below which an answer is rejected.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text where nothing could be learnt. Rows without a language or an
id teach nothing. Very long texts are read whole. Repeated rows get equal
answers; an empty table gives an empty one. Input columns other than text, lang
and doc_id are not looked at; result columns replace those of the same name.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .subwords import Grams, softmax, temperature, train
from .textscan import runs

UNKNOWN = "und"
GRAMS = Grams((2, 3, 4), 15)
_SCORES = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float
    floor: float


def sample(docs: DataFrame, teach: Column, per_language: int, languages: int) -> DataFrame:
    """text and lang of about ``per_language`` rows of each language."""
    known = docs.filter(teach & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = known.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_size"))
    n = sizes.count()
    if not n:
        return known.select("text", "lang").limit(0)
    rows = max(min(per_language, per_language * languages // n), 20)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    each = known.join(sizes, F.col("lang") == F.col("_lang"))
    return each.filter(drawn < F.lit(float(rows)) / F.col("_size")).select("text", "lang").limit(2 * rows * n)


def learnt(
    features: list[tuple[np.ndarray, np.ndarray]], said: list[str], dim: int, precision: float
) -> Model:
    """The model of a sample whose rows are in a fixed order."""
    names, classes = np.unique(np.array(said), return_inverse=True)
    test = np.arange(len(classes)) % 5 == 4
    learn = np.flatnonzero(~test)
    share = np.bincount(classes[learn], minlength=len(names))
    weight = (len(learn) / len(names)) / np.maximum(share[classes[learn]], 1)
    table, bias = train(
        [features[i] for i in learn], classes[learn], len(names), GRAMS.bits, dim, epochs=6, rate=0.1, scale=20.0,
        weights=weight,
    )
    logits = np.array([table[features[i][0]].T @ features[i][1] + bias for i in np.flatnonzero(test)])
    if not len(logits):
        return Model(names.tolist(), table, bias, 1.0, 0.0)
    heat = temperature(logits, classes[test])
    p = softmax(logits / heat)
    sure, right = p.max(axis=1), p.argmax(axis=1) == classes[test]
    down = np.argsort(-sure)
    good = np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= precision
    floor = float(sure[down][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(names.tolist(), table, bias, heat, floor)


def fit(
    docs: DataFrame, teach: Column, per_language: int = 1500, languages: int = 400, dim: int = 16,
    precision: float = 0.99,
) -> Model | None:
    """Learn from the rows where ``teach`` holds; None where there is nothing to learn from.

    A sample is learnt in one task: its texts stay in the executors, and only
    the weights reach the driver.
    """

    def task(batches):
        features, said = [], []
        for batch in batches:
            features += GRAMS.histograms(batch.column(0))
            said += batch.column(1).to_pylist()
        if said:
            model = learnt(features, said, dim, precision)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = sample(docs, teach, per_language, languages).repartition(1).sortWithinPartitions("lang", "text")
    found = rows.mapInArrow(task, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def _letters(data: np.ndarray) -> bool:
    low = data | 32
    if ((low >= 97) & (low <= 122) & (data < 128)).any():
        return True
    return any(c.isalpha() for c in data[data >= 128].tobytes().decode("utf-8", "replace"))


def predict(docs: DataFrame, model: Model | None, reject: bool = True) -> DataFrame:
    """All rows with lang_pred, score and rejected. ``reject`` turns rejected answers into ``und``."""
    names = [f.name for f in _SCORES]
    kept = [f for f in docs.schema.fields if f.name not in names]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = held.value
        for batch in batches:
            for run in runs(batch):
                part = batch.slice(run.lo, run.hi - run.lo)
                n = len(part)
                said, score, out = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                if m is not None:
                    p = softmax((GRAMS.means(run, m.table) + m.bias) / m.heat)
                    for k in range(n):
                        if _letters(run.data[run.offsets[k] : run.offsets[k + 1]]):
                            score[k] = p[k].max()
                            out[k] = score[k] < m.floor
                            if not (reject and out[k]):
                                said[k] = m.languages[int(p[k].argmax())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    + [pa.array(said, pa.string()), pa.array(score), pa.array(out)],
                    names=[f.name for f in kept] + names,
                )

    return docs.mapInArrow(task, T.StructType(kept + list(_SCORES)))
