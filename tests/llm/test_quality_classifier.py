"""The ordinal model against its definition, written out as loops."""

import math

import numpy as np
import pytest

from demandflow.llm import quality_classifier


def upto(cut, score):
    return 1 / (1 + math.exp(-(cut - score)))


def objective(docs, grades, weights, cuts, low, l2):
    """Mean negative log-likelihood of P(grade <= low + k) = sigmoid(cut_k - score), with a ridge."""
    total = 0.0
    for slots, grade in zip(docs, grades, strict=True):
        score = sum(weights.get(s, 0.0) for s in slots)
        k = grade - low
        above = upto(cuts[k], score) if k < len(cuts) else 1.0
        below = upto(cuts[k - 1], score) if k > 0 else 0.0
        total -= math.log(above - below)
    return total / len(docs) + l2 / 2 * sum(w * w for w in weights.values())


def examples(levels, n=160, slots=6, seed=3):
    rng = np.random.default_rng(seed)
    truth = rng.normal(0, 1.5, slots)
    docs = [np.flatnonzero(rng.random(slots) < 0.5) for _ in range(n)]
    noisy = np.array([truth[d].sum() for d in docs]) + rng.logistic(0, 1, n)
    return docs, 2 + np.searchsorted(np.quantile(noisy, np.arange(1, levels) / levels), noisy)


@pytest.mark.parametrize("levels", [2, 3, 5])
def test_fit_is_the_optimum_of_the_likelihood(levels):
    docs, grades = examples(levels)
    l2 = 1e-2
    model = quality_classifier.fit(docs, grades, min_docs=1, l2=l2, steps=4000, rate=0.005)
    assert model.low == 2 and len(model.thresholds) == levels - 1
    assert (np.diff(model.thresholds) > 0).all()
    used = sorted({int(s) for d in docs for s in d})
    at = [*model.weights[used], *model.thresholds]

    def value(x):
        return objective(docs, grades.tolist(), dict(zip(used, x, strict=False)), x[len(used):], 2, l2)

    for i in range(len(at)):  # slopes by central differences
        up, down = list(at), list(at)
        up[i], down[i] = up[i] + 1e-4, down[i] - 1e-4
        assert abs(value(up) - value(down)) / 2e-4 < 1e-4


def test_grade_and_tail_are_sums_of_the_class_probabilities():
    docs, grades = examples(4)
    model = quality_classifier.fit(docs, grades, min_docs=1)
    flat, offsets = np.concatenate(docs), np.r_[0, np.cumsum([len(d) for d in docs])]
    above = model.above(model.score(flat, offsets))
    for slots, row in zip(docs, above, strict=True):
        score = sum(model.weights[s] for s in slots)
        steps = [0.0, *[upto(c, score) for c in model.thresholds], 1.0]
        share = np.diff(steps)
        assert row.sum() == pytest.approx(sum(k * p for k, p in enumerate(share)), abs=1e-9)
        assert row[-1] == pytest.approx(share[-1], abs=1e-9)


def test_rare_slots_and_single_grades():
    docs, grades = examples(3)
    docs[0] = np.r_[docs[0], 77]
    model = quality_classifier.fit(docs, grades, min_docs=2)
    assert model.weights[77] == 0
    one = quality_classifier.fit(docs, np.full(len(docs), 4))
    assert len(one.thresholds) == 0 and one.low == 4 and not one.weights.any()
    assert quality_classifier.fit([], np.zeros(0, np.int64)).low == 0
