"""Quality classifier: naive Bayes support vectors.

Indicators of words and word pairs are scaled by the class log-count ratio
``r = log((p + 1) / |p + 1|) - log((q + 1) / |q + 1|)`` (p, q: documents of class 1 and 0 that
hold the n-gram), rows are scaled to length one, and a linear hinge-loss model is fitted by dual
coordinate descent. A Platt sigmoid, fitted on a fifth of the sample that the first fit doesn't
see, turns margins into scores.

The fit sees a bounded sample of labelled rows: at most ``PER_LABEL`` documents per class,
chosen by a hash of the id, none above ``MAX_FIT_CHARS`` characters. Only their n-gram ids reach
the driver, at most ``text_features.FIT_BYTES`` of each class. Every text is scored whole, map-side, with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import bounded_ids, free_names
from affinity.llm.text_features import Rows, labelled_grams, platt, score_column, spread_out

BITS = 20
PER_LABEL = 3_000
MAX_FIT_CHARS = 200_000
SEED = 8
COST = 1.0
#: Added to a row's squares before it is scaled to length one: texts of a few n-grams stay near the bias.
FLOOR = 4.0
EPOCHS = 12
THRESHOLD = 0.3


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    a: float
    b: float


def log_count_ratio(grams: list[np.ndarray], label: np.ndarray, dim: int) -> np.ndarray:
    """0 for n-grams in fewer than two documents of the sample."""
    count = [np.zeros(dim), np.zeros(dim)]
    for g, y in zip(grams, label):
        count[int(y)][g] += 1
    q, p = count
    ratio = np.log((p + 1) / (p + 1).sum()) - np.log((q + 1) / (q + 1).sum())
    ratio[p + q < 2] = 0
    return ratio


def dual_coordinate_descent(rows: Rows, label: np.ndarray, cost=COST, epochs=EPOCHS, seed=SEED):
    """(w, b) of min |w|^2/2 + b^2/2 + C * hinge; classes weigh the same in total."""
    y = np.where(label == 1, 1.0, -1.0)
    n1 = max(1, int((label == 1).sum()))
    n0 = max(1, len(label) - n1)
    top = cost * np.where(label == 1, len(label) / (2 * n1), len(label) / (2 * n0))
    w, b, alpha = np.zeros(rows.dim), 0.0, np.zeros(rows.n)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(rows.n):
            s = slice(rows.at[i], rows.at[i + 1])
            col, val = rows.col[s], rows.val[s]
            gradient = y[i] * (w[col] @ val + b) - 1
            new = min(max(alpha[i] - gradient / (val @ val + 1.0), 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[col] += step * val
                b += step
                alpha[i] = new
    return w, b


def fit(docs: DataFrame, labelled: DataFrame, per_label: int = PER_LABEL) -> Model:
    """``labelled(doc_id, label)``, one row per id. Without rows of both classes the model is neutral
    (margin 0, score 0.5)."""
    dim = 1 << BITS
    _, grams, label = labelled_grams(docs, bounded_ids(labelled, per_label, SEED), BITS, True, MAX_FIT_CHARS)
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(dim), np.zeros(dim), 0.0, 1.0, 0.0)
    kept = np.arange(len(label)) % 5 == 4  # the fifth for the sigmoid
    ratio = log_count_ratio([g for g, k in zip(grams, kept) if not k], label[~kept], dim)
    w, b = dual_coordinate_descent(
        Rows([g for g, k in zip(grams, kept) if not k], ratio, FLOOR), label[~kept]
    )
    margin = Rows([g for g, k in zip(grams, kept) if k], ratio, FLOOR).dot(w) + b
    sigmoid_a, sigmoid_b = platt(margin, label[kept])
    return Model(ratio, spread_out(w, ratio), float(b), sigmoid_a, sigmoid_b)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double ``name`` in 0..1 from the whole text. Null, empty and blank texts have
    no n-grams: they take the score of the bias. A column ``name`` that exists is replaced."""
    scored = score_column(BITS, True, model.ratio, model.weight, FLOOR, model.bias, model.a, model.b)
    return docs.withColumn(name, scored(F.col(text)))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns unchanged."""
    name, = free_names(docs, "quality_score")
    return score(docs, model, name=name).where(F.col(name) >= threshold).drop(name)
