"""Toxicity severity by cumulative-link ordinal regression.

Features are the distinct words of a text and their first 4 and 5 letters
(63-bit hashes, so unlike words do not share a weight; the beginnings carry
over to inflected forms).  One weight per feature, at least 0 (a word can
add severity, none takes it back), is shared by all thresholds:
P(grade <= k) = sigmoid(threshold_k - w.x).  The expected severity is the sum
of P(grade > k) over the thresholds.

``labels.toxic`` is 0 or 1; the grades of the training rows are 0 for label
0, and 1 to 3 for label 1 by the share of features that the labels of another
fold's rows tie to label 1 (terciles over the training rows with label 1).  The
labels themselves say nothing of degrees: only the cut between 0 and 1 is
validated on held-out labels, and the severity is relative to the data.  Only
features that the labels tie to label 1 enter the model; the others' weights
would end at 0.

Training takes at most ``TRAIN_ROWS`` labelled documents (by a hash of the
id) outside the held-out part.  Defined cases: labels that are null, other
than 0 and 1 or contradictory are not learnt from; without labels of both
kinds every document gets the severity of the empty text.  Null, empty and
wordless texts have no features.  An empty table gives an empty result.
Columns named like a result column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwise.llm.features import Ftrl, word_features
from martwise.llm.quality_classifier import labelled_texts

TRAIN_ROWS = 8192
GRADES = 4
EPOCHS = 20
MIN_DOCS = 3
SETTLED = 0.01  # texts with a smaller gradient are passed over
CUT = 0.5  # without a model


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _array(text: str | None) -> np.ndarray:
    return np.array(sorted(word_features(text)), np.int64)


def telling(toxic: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Features in ``MIN_DOCS`` texts or more that mostly have label 1."""
    seen, bad = Counter(), Counter()
    for t, w in zip(toxic, words):
        own = w.tolist()
        seen.update(own)
        if t:
            bad.update(own)
    share = toxic.mean()
    return np.array(sorted(k for k, b in bad.items()
                           if seen[k] >= MIN_DOCS and (b + share) / (seen[k] + 1) > 0.5 + share / 2), np.int64)


def grades(toxic: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Grade 0 for label 0; 1 to 3 for label 1 by the share of features that the rows of the other fold tie to label 1.

    Rows alternate between two folds, so a row's grade comes from labels and
    texts that are not its own; equal shares have equal grades.
    """
    density = np.zeros(len(words))
    for fold in (0, 1):
        other = np.arange(1 - fold, len(words), 2)
        vocab = telling(toxic[other], [words[k] for k in other]) if len(other) else np.empty(0, np.int64)
        for k in range(fold, len(words), 2):
            density[k] = np.isin(words[k], vocab).mean() if len(words[k]) else 0.0
    at = toxic == 1
    low, high = np.quantile(density[at], [1 / 3, 2 / 3])
    return np.where(at, 1 + (density > low) + (density > high), 0).astype(int)


def fit(grade: np.ndarray, words: list[np.ndarray], vocab: np.ndarray, epochs: int = EPOCHS, alpha: float = 1.0,
        beta: float = 1.0, l1: float = 1.0, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(thresholds, feature ids, weights, cut) over the features in ``vocab``."""
    at = [np.searchsorted(vocab, w[np.isin(w, vocab)]) for w in words]
    rule = Ftrl(alpha, beta, l1, l2)
    z, n = np.zeros(len(vocab)), np.zeros(len(vocab))
    share = np.array([(np.sum(grade <= k) + 1) / (len(grade) + 2) for k in range(GRADES - 1)])
    theta = np.log(share / (1 - share))
    squares = np.ones(GRADES - 1)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(grade)):
            x, y = at[k], grade[k]
            w = np.maximum(rule.weights(z[x], n[x]), 0.0)
            p = _sigmoid(theta - w.sum())  # P(grade <= 0), P(grade <= 1), ...
            below, here = (p[y - 1] if y else 0.0), (p[y] if y < GRADES - 1 else 1.0)
            g = 1.0 - here - below  # minus d log P / d score
            if abs(g) < SETTLED:
                continue
            rule.update(z, n, x, w, np.full(len(x), g))
            prob = max(here - below, 1e-9)
            for j, g in ((y, -here * (1 - here) / prob), (y - 1, below * (1 - below) / prob)):
                if 0 <= j < GRADES - 1:
                    squares[j] += g * g
                    theta[j] -= 0.1 * g / np.sqrt(squares[j])
            for j in range(1, GRADES - 1):  # the thresholds stay ordered
                theta[j] = max(theta[j], theta[j - 1] + 0.01)
    w = np.maximum(rule.weights(z, n), 0.0)
    used = np.flatnonzero(w)
    return theta, vocab[used].astype(np.int64), w[used], best_cut(grade > 0, _sigmoid(np.array([w[x].sum() for x in at]) - theta[0]))


def best_cut(truth: np.ndarray, score: np.ndarray) -> float:
    """The score at which the training rows are told apart best."""
    order = np.argsort(-score, kind="stable")
    gain = np.cumsum(np.where(truth[order], 1, -1))
    gain[:-1][score[order][:-1] == score[order][1:]] = -1  # not between equal scores
    k = int(gain.argmax())
    above = score[order][k]
    below = score[order][k + 1] if k + 1 < len(order) else 0.0
    return float((above + below) / 2)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The model; one task fits the bounded sample."""
    sample = labelled_texts(docs, labels, "toxic", rows)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"doc_id": part["doc_id"], "label": part["label"],
                                "words": [_array(t).tobytes() for t in part["text"]]})

    def fit_rows(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", kind="stable")
        toxic = part["label"].to_numpy(int)
        words = [np.frombuffer(x, np.int64) for x in part["words"]]
        if len(set(toxic.tolist())) < 2:
            level = np.log((np.sum(toxic == 0) + 1) / (np.sum(toxic) + 1))
            theta, ids, w, cut = level + np.arange(GRADES - 1.0), np.empty(0, np.int64), np.empty(0), CUT
        else:
            vocab = telling(toxic, words)
            theta, ids, w, cut = fit(grades(toxic, words), words, vocab)
        return pd.DataFrame({"theta": [theta.tobytes()], "ids": [ids.tobytes()], "w": [w.tobytes()], "cut": [cut]})
    got = (sample.mapInPandas(hashed, "doc_id long, label int, words binary").groupBy(F.lit("one"))
           .applyInPandas(fit_rows, "theta binary, ids binary, w binary, cut double").collect())
    if not got:
        return np.arange(GRADES - 1.0), np.empty(0, np.int64), np.empty(0), CUT
    return (np.frombuffer(got[0]["theta"]), np.frombuffer(got[0]["ids"], np.int64), np.frombuffer(got[0]["w"]),
            got[0]["cut"])


def severity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray, float]) -> DataFrame:
    """``docs`` plus severity (0 to 3), score (P(grade >= 1)), grade (likeliest) and toxic (0/1: score at the cut or above)."""
    theta, ids, w, cut = model
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(ids.tolist(), w.tolist())))
    names = ("severity", "score", "grade", "toxic")

    @F.pandas_udf("severity double, score double, grade int")
    def graded(texts: pd.Series) -> pd.DataFrame:
        weight = shared.value
        total = np.array([sum(weight[x] for x in sorted(word_features(t) & weight.keys())) for t in texts], float)
        over = _sigmoid(total[:, None] - theta[None, :])  # P(grade > k)
        edge = np.hstack([np.ones((len(over), 1)), over, np.zeros((len(over), 1))])
        return pd.DataFrame({"severity": over.sum(axis=1), "score": over[:, 0],
                             "grade": (edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype(np.int32)})
    keep = [c for c in docs.columns if c not in names]
    return (docs.select(*keep, graded(F.col("text")).alias("__g")).select(*keep, "__g.*")
            .withColumn("toxic", (F.col("score") >= cut).cast("int")))
