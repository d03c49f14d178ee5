"""Toxicity: non-negative positive-unlabelled learning.

The learner sees documents confirmed as toxic and unlabelled text; nothing is known to be clean.
With the class prior pi, loss l and linear score g, the risk

    pi * mean_P l(g) + max(0, mean_U l(-g) - pi * mean_P l(-g))

estimates the ordinary risk. When the second term falls below zero (the model has begun to fit
unlabelled toxic texts as clean) the step goes up that term instead of down, which is the
non-negative correction. Features are word indicators, scaled by their log-count ratio
between the confirmed and the unlabelled texts and normalised by row.

The fit sees bounded samples, chosen by hash: at most ``POSITIVE`` confirmed and ``UNLABELLED``
other documents, none above ``MAX_FIT_CHARS`` characters; only their word ids reach the
driver, at most ``text_features.FIT_BYTES`` of each role. The class prior is estimated from these two samples
alone: a first fit ranks texts that it didn't see, and the prior is the share of unlabelled texts above a cut over the
share of confirmed ones, at the cut where this ratio has the lowest upper bound (best-bin estimation). Every
text is scored whole, map-side, with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.text_features import Rows, labelled_grams, platt, score_column, sigmoid, spread_out

BITS = 20
POSITIVE = 3_000
UNLABELLED = 9_000
MAX_FIT_CHARS = 200_000
MIN_DOCS = 5
MIN_RATIO = 1.0
#: Added to a row's squares before it is scaled to length one.
FLOOR = 4.0
SEED = 1
STEPS = 300
RATE = 0.3
DECAY = 1e-4
THRESHOLD = 0.7
#: The sigmoid is fitted to margins of rows that their fit didn't see.
FOLDS = 3
#: The prior of the fits that only rank texts, before it is estimated.
FIRST_PRIOR = 0.1
#: Confidence and slack of the bound that picks the cut of the estimate.
PRIOR_DELTA = 0.1
PRIOR_SLACK = 0.01


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0


def word_ratio(positive: list[np.ndarray], unlabelled: list[np.ndarray], dim: int) -> np.ndarray:
    """log ratio of document shares; 0 for rare words and for words about as common in both."""
    p, u = np.zeros(dim), np.zeros(dim)
    for count, grams in ((p, positive), (u, unlabelled)):
        for g in grams:
            count[g] += 1
    ratio = np.log((p + 1) / (len(positive) + 2)) - np.log((u + 1) / (len(unlabelled) + 2))
    ratio[(p + u < min(MIN_DOCS, max(2, len(positive) // 10))) | (np.abs(ratio) < MIN_RATIO)] = 0
    return ratio


def nn_pu(positive: Rows, unlabelled: Rows, prior: float, steps=STEPS, rate=RATE, decay=DECAY):
    """(w, b) by full-batch Adam on the non-negative risk with the logistic loss."""
    dim = positive.dim
    w, b = np.zeros(dim), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(dim), np.zeros(dim), 0.0, 0.0
    for t in range(1, steps + 1):
        gp, gu = positive.dot(w) + b, unlabelled.dot(w) + b
        sp, su = sigmoid(gp), sigmoid(gu)
        as_clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        # derivatives of the two parts by the scores
        toxic_p = prior * (sp - 1) / positive.n
        clean_p, clean_u = -prior * sp / positive.n, su / unlabelled.n
        if as_clean >= 0:
            dp, du = toxic_p + clean_p, clean_u
        else:
            dp, du = -clean_p, -clean_u
        grad = positive.back(dp) + unlabelled.back(du) + decay * w
        gb = dp.sum() + du.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, b


def calibrated(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Sigmoid (a, b) over margins: confirmed texts against the lowest unlabelled ones, leaving out twice
    the class prior, so that the toxic texts among the unlabelled don't count as clean."""
    low = np.sort(unlabelled)[: max(1, int(len(unlabelled) * max(0.1, 1 - 2 * prior)))]
    label = np.concatenate([np.ones(len(positive), dtype=int), np.zeros(len(low), dtype=int)])
    return platt(np.concatenate([positive, low]), label)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of toxic texts among the unlabelled, from margins of confirmed and unlabelled texts that their fits
    didn't see. Above a cut that only toxic texts reach, the two shares differ by just this factor."""
    cuts = np.unique(positive)
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    deviation = sum(np.sqrt(np.log(4 / PRIOR_DELTA) / (2 * n)) for n in (len(positive), len(unlabelled)))
    best = np.argmin((u + (1 + PRIOR_SLACK) * deviation) / p)
    return float(min(0.9, max(1e-3, u[best] / p[best])))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, dim: int):
    ratio = word_ratio(positive, unlabelled, dim)
    return ratio, *nn_pu(Rows(positive, ratio, FLOOR), Rows(unlabelled, ratio, FLOOR), prior)


def fold_numbers(positive_ids: list, unlabelled_ids: list) -> tuple[np.ndarray, np.ndarray]:
    """Fold of each text. One that is drawn in both roles has the same in both, so no fit sees it in either."""
    place = {d: i for i, d in enumerate(dict.fromkeys([*positive_ids, *unlabelled_ids]))}
    return tuple(np.array([place[d] % FOLDS for d in ids], dtype=int) for ids in (positive_ids, unlabelled_ids))


def unseen_margins(positive: list[np.ndarray], unlabelled: list[np.ndarray], folds, prior: float, dim: int):
    """(margins of confirmed, margins of unlabelled texts), each by a fit on the other folds."""
    out = ([], [])
    for k in range(FOLDS):
        seen = [[g for g, f in zip(rows, fold) if f != k] for rows, fold in zip((positive, unlabelled), folds)]
        if not all(seen):
            continue
        ratio, w, b = train(*seen, prior, dim)
        for rows, fold, margins in zip((positive, unlabelled), folds, out):
            margins.append(Rows([g for g, f in zip(rows, fold) if f == k], ratio, FLOOR).dot(w) + b)
    return tuple(np.concatenate([[], *m]) for m in out)


def fit(docs: DataFrame, labelled: DataFrame, unlabelled_ids: DataFrame) -> Model:
    """``labelled(doc_id, label)``: rows that may be learnt from; only label 1 is used.
    ``unlabelled_ids(doc_id)``: documents that serve as unlabelled text. Without confirmed or unlabelled documents
    every text scores 0; where there are too few for a fit on folds the prior is ``FIRST_PRIOR``."""
    dim = 1 << BITS
    order = F.xxhash64(F.lit(SEED), "doc_id")
    confirmed = labelled.where("label = 1").orderBy(order, "doc_id").limit(POSITIVE).select("doc_id", F.lit(1).alias("label"))
    rest = unlabelled_ids.select("doc_id").dropna().distinct().orderBy(order, "doc_id").limit(UNLABELLED)
    ids = confirmed.unionByName(rest.withColumn("label", F.lit(0)))  # a confirmed text may be drawn in both roles
    drawn, grams, role = labelled_grams(docs, ids, BITS, False, MAX_FIT_CHARS)
    positive = [g for g, r in zip(grams, role) if r == 1]
    unlabelled = [g for g, r in zip(grams, role) if r == 0]
    if not positive or not unlabelled:
        return Model(np.zeros(dim), np.zeros(dim), -50.0)
    folds = fold_numbers([d for d, r in zip(drawn, role) if r == 1], [d for d, r in zip(drawn, role) if r == 0])
    ranked = unseen_margins(positive, unlabelled, folds, FIRST_PRIOR, dim)
    prior, a, shift = FIRST_PRIOR, 1.0, 0.0
    if all(len(m) for m in ranked):
        prior = class_prior(*ranked)
        a, shift = calibrated(*unseen_margins(positive, unlabelled, folds, prior, dim), prior)
    ratio, w, b = train(positive, unlabelled, prior, dim)
    return Model(ratio, spread_out(w, ratio), float(b), a, shift)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double ``name`` in 0..1 from the whole text. Null, empty and blank texts have
    no words: they take the score of the bias. A column ``name`` that exists is replaced."""
    scored = score_column(BITS, False, model.ratio, model.weight, FLOOR, model.bias, model.a, model.b)
    return docs.withColumn(name, scored(F.col(text)))
