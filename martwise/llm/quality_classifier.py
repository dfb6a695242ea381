"""Quality classifier: hashed word n-gram logistic regression.

The model is trained with follow-the-regularised-leader updates on at most
``TRAIN_ROWS`` labelled documents (drawn by a hash of the id, one for each id) and scores
every document as a sparse dot product.  Features come from the text alone.

Defined cases: labels that are null, other than 0 and 1, contradictory for
an id, or of held-out ids are not learnt from.  Without labels of both kinds
the score is the smoothed share of label 1.  Null, empty and wordless texts
get the score of the bias.  Documents that share an id are each scored; the one
whose text has the lowest hash is learnt from.  An empty table gives an empty result.  Columns named
like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.llm.common import held_out
from martwise.llm.features import Ftrl, ngram_features

TRAIN_ROWS = 8192
BITS = 20
EPOCHS = 4
CUT = 0.7


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` ids outside the held-out part, one row an id."""
    known = (labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("__high"))
             .filter(F.col("label") == F.col("__high")).select("doc_id", "label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded: `rows` pairs of numbers
    held = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.col("text").isNull(), F.xxhash64("text"), F.col("text").alias("text")))  # combined before the shuffle
    return held.groupBy("doc_id", "label").agg(first.alias("__first")).select("doc_id", "label", "__first.text")


def _feature_rows(bits: int):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            got = [ngram_features(t, bits) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()), pa.array([i.tolist() for i, _ in got], pa.list_(pa.int32())),
                 pa.array([v.tolist() for _, v in got], pa.list_(pa.float32()))],
                names=["doc_id", "label", "ids", "vals"])
    return rows


def fit(label: np.ndarray, ids: list[np.ndarray], values: list[np.ndarray], bits: int = BITS, epochs: int = EPOCHS,
        alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> tuple[float, np.ndarray]:
    """Bias and weights after ``epochs`` passes in a fixed order."""
    rule = Ftrl(alpha, beta, l1, l2)
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    share = (label.sum() + 1) / (len(label) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(set(label.tolist())) < 2:
        return bias, np.zeros(1 << bits, np.float32)
    rng = np.random.default_rng(7)
    squares = 1.0
    for _ in range(epochs):
        for k in rng.permutation(len(label)):
            at, x = ids[k], values[k]
            w = rule.weights(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(bias + w @ x, -35, 35)))
            g = p - label[k]
            rule.update(z, n, at, w, g * x)
            squares += g * g
            bias -= 0.1 * g / np.sqrt(squares)
    return bias, rule.weights(z, n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, bits: int = BITS,
          epochs: int = EPOCHS) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, feature numbers, weights) of the model; one task fits the bounded sample."""
    features = labelled_texts(docs, labels, "quality", rows).mapInArrow(
        _feature_rows(bits), "doc_id long, label int, ids array<int>, vals array<float>")

    def fit_rows(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", kind="stable")
        bias, w = fit(part["label"].to_numpy(float), [np.asarray(x, np.int64) for x in part["ids"]],
                      [np.asarray(x, float) for x in part["vals"]], bits, epochs)
        at = np.flatnonzero(w)
        return pd.DataFrame({"bias": [bias], "at": [at.astype(np.int32).tobytes()], "w": [w[at].tobytes()]})
    got = features.groupBy(F.lit("one")).applyInPandas(fit_rows, "bias double, at binary, w binary").collect()
    if not got:
        return 0.0, np.empty(0, np.int32), np.empty(0, np.float32)
    return got[0]["bias"], np.frombuffer(got[0]["at"], np.int32), np.frombuffer(got[0]["w"], np.float32)


def score(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], cut: float = CUT, bits: int = BITS) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1: score >= ``cut``)."""
    bias, at, w = model
    shared = docs.sparkSession.sparkContext.broadcast((at, w))  # at most 2^bits weights
    state: dict[str, np.ndarray] = {}

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if "w" not in state:
            full = np.zeros(1 << bits, np.float32)
            full[shared.value[0]] = shared.value[1]
            state["w"] = full
        full = state["w"]
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                ids, values = ngram_features(text, bits)
                out[k] = bias + float(full[ids] @ values)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))
    base = docs.drop("score", "predicted")
    return (base.withColumn("score", scored(F.col("text")))
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))
