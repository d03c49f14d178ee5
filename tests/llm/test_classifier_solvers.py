"""The classifiers' solvers against dense reference solvers, the class prior and the bounds of a fit."""

import numpy as np
import pytest

from affinity.llm import quality_classifier, text_features, toxicity
from affinity.llm.text_features import Rows


def random_grams(rng, n, dim, shift=0):
    """Rows of a few ids; the first is empty."""
    return [np.empty(0, np.uint32)] + [
        np.unique((rng.integers(0, dim, rng.integers(1, 8)) + shift) % dim).astype(np.uint32) for _ in range(n - 1)
    ]


def dense(grams, value, floor):
    out = np.zeros((len(grams), len(value)))
    for i, g in enumerate(grams):
        out[i, g] = value[g]
    out /= np.sqrt(floor + (out * out).sum(axis=1))[:, None]
    return out[:, value != 0]


def logistic(z):
    return np.log1p(np.exp(-np.abs(z))) + np.maximum(-z, 0)  # loss of margin z


def risk_parts(x, p, u, prior):
    """The two terms of the risk, by their definition."""
    gp, gu = p @ x[:-1] + x[-1], u @ x[:-1] + x[-1]
    return prior * logistic(gp).mean(), logistic(-gu).mean() - prior * logistic(-gp).mean()


def numeric(f, x, h=1e-5):
    return np.array([(f(x + h * e) - f(x - h * e)) / (2 * h) for e in np.eye(len(x))])


@pytest.mark.parametrize("prior, steps", [(0.2, 40), (0.85, 60)])
def test_nn_pu_equals_a_dense_solver(prior, steps):
    """Adam on numerical derivatives of the risk's definition, dense rows; with the large prior the second term is
    below zero at some steps, so both directions are taken."""
    rng = np.random.default_rng(4)
    value = rng.normal(size=12) * (rng.random(12) < 0.8)
    positive, unlabelled = random_grams(rng, 9, 12), random_grams(rng, 20, 12, 3)
    w, b = toxicity.nn_pu(Rows(positive, value, 4.0), Rows(unlabelled, value, 4.0), prior, steps)
    p, u = dense(positive, value, 4.0), dense(unlabelled, value, 4.0)
    x = np.append(np.zeros(p.shape[1]), np.log(prior / (1 - prior)))
    m, v, signs = np.zeros(len(x)), np.zeros(len(x)), set()
    for t in range(1, steps + 1):
        toxic, clean = risk_parts(x, p, u, prior)
        signs.add(clean >= 0)
        g = numeric((lambda y: sum(risk_parts(y, p, u, prior))) if clean >= 0 else (lambda y: -risk_parts(y, p, u, prior)[1]), x)
        g[:-1] += toxicity.DECAY * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - toxicity.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(np.append(w, b), x, atol=1e-6)
    assert prior < 0.5 or signs == {True, False}


def test_dual_coordinate_descent_equals_a_dense_solver():
    """Projected gradient on the dense dual, until it stands still: the same weights."""
    rng = np.random.default_rng(5)
    value = rng.normal(size=10)
    grams = random_grams(rng, 25, 10)
    label = (rng.random(25) < 0.3).astype(int)
    w, b = quality_classifier.dual_coordinate_descent(Rows(grams, value, 4.0), label, epochs=3000)
    x = np.column_stack([dense(grams, value, 4.0), np.ones(25)])
    y = 2.0 * label - 1
    top = np.where(label == 1, 25 / (2 * label.sum()), 25 / (2 * (25 - label.sum())))
    q = (y[:, None] * x) @ (y[:, None] * x).T
    alpha = np.zeros(25)
    for _ in range(60_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / np.linalg.norm(q, 2), 0, top)
    assert np.allclose(np.append(w, b), (alpha * y) @ x, atol=1e-5)

    def objective(z):
        return z @ z / 2 + (top * np.maximum(0, 1 - y * (x @ z))).sum()

    best = objective(np.append(w, b))
    assert all(best <= objective(np.append(w, b) + 0.01 * rng.normal(size=11)) + 1e-9 for _ in range(200))


@pytest.mark.parametrize("share", [0.02, 0.1, 0.4])
def test_class_prior_from_positive_and_unlabelled_margins(share):
    rng = np.random.default_rng(6)
    positive = rng.normal(4, 1, 3_000)
    n = int(9_000 * share)
    unlabelled = np.concatenate([rng.normal(4, 1, n), rng.normal(-1, 1, 9_000 - n)])
    assert abs(toxicity.class_prior(positive, unlabelled) - share) < 0.02 + 0.1 * share


def test_class_prior_of_ties_and_few_margins():
    assert toxicity.class_prior(np.ones(5), np.ones(7)) == 0.9  # nothing tells the two apart
    assert toxicity.class_prior(np.ones(1), np.zeros(1)) == 1e-3


def test_a_text_drawn_in_both_roles_has_one_fold():
    p, u = toxicity.fold_numbers([5, 1, 9, 4], [9, 2, 5, 7, 8])
    assert p.tolist() == [0, 1, 2, 0]
    assert (u[0], u[2]) == (2, 0)


def test_negative_labels_do_not_matter(spark):
    """The fit is the same whatever is labelled clean."""
    docs = spark.createDataFrame(
        [(k, ("vile nasty " if k % 4 == 0 else "calm kind ") + f"w{k % 7} x{k % 11}") for k in range(120)], "doc_id long, text string"
    )
    toxic = [(k, 1) for k in range(0, 60, 4)]
    fits = [
        toxicity.fit(docs, spark.createDataFrame(toxic + clean, "doc_id long, label int"), docs.select("doc_id"))
        for clean in ([], [(k, 0) for k in range(1, 120, 2)])
    ]
    assert np.array_equal(fits[0].weight, fits[1].weight) and fits[0].bias == fits[1].bias
    score = {r.doc_id: r.score for r in toxicity.score(docs, fits[0]).collect()}
    assert min(score[k] for k in range(60, 120, 4)) > max(score[k] for k in range(120) if k % 4)


def test_bytes_of_a_fit_are_bounded(spark):
    """Texts are taken, by the hash of their id, while their ids fit; the order of rows and partitions doesn't matter."""
    docs = spark.createDataFrame(
        [(k, None if k == 3 else " ".join(f"t{k}x{i}" for i in range(k))) for k in range(40)], "doc_id long, text string"
    )
    ids = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS label")
    everything = text_features.labelled_grams(docs, ids, 20, True, 10_000)
    size = {(d, y): g.nbytes for d, g, y in zip(*everything)}
    assert len(size) == 40
    runs = [text_features.labelled_grams(d, ids, 20, True, 10_000, max_bytes=1_500) for d in (docs, docs.repartition(7, "text"))]
    assert runs[0][0] == runs[1][0] and 0 < len(runs[0][0]) < 40
    for label in (0, 1):
        total = sum(size[d, y] for d, y in zip(runs[0][0], runs[0][2]) if y == label)
        assert 0 < total <= 1_500
    assert text_features.labelled_grams(docs, ids, 20, True, 10_000, max_bytes=-1)[0] == []
