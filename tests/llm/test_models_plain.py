"""The learned operators against plain versions of their formulas on a few hundred rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerflow.llm import quality, toxicity
from ledgerflow.llm.mixing import exponent, Target, tempered


@pytest.mark.parametrize("levels", [(8,), (5, 2), (512, 64, 8)])
def test_normal_equations_are_sums_over_all_rows(spark, monkeypatch, levels):
    monkeypatch.setattr(quality, "LEVELS", levels)
    rng = np.random.default_rng(2)
    x, label = rng.standard_normal((300, len(quality.STATISTICS))), rng.integers(0, 2, 300)
    fields = ", ".join(f"{s} double" for s in quality.STATISTICS)
    rows = spark.createDataFrame([(*map(float, r), int(y)) for r, y in zip(x, label, strict=True)], f"{fields}, label int")
    features = quality.Features(x.mean(axis=0), x.std(axis=0))
    gram, moment = quality.normal_equations(rows.repartition(11), features)
    plain_gram, plain_moment = np.zeros_like(gram), np.zeros_like(moment)
    for row, y in zip(x, label, strict=True):
        phi = features.of(row[None])[0]
        plain_gram += np.outer(phi, phi)
        plain_moment += phi * y
    assert np.allclose(gram, plain_gram) and np.allclose(moment, plain_moment)


def test_features_approach_a_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(quality, "FEATURES", 20_000)
    rng = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    x = rng.standard_normal((12, d))
    phi = quality.Features(np.zeros(d), np.ones(d)).of(x)[:, :-1]
    distance = ((x[:, None] - x) ** 2).sum(axis=2)
    assert np.abs(phi @ phi.T - np.exp(-distance / (2 * quality.WIDTH**2))).max() < 0.05


def test_no_non_decreasing_sequence_is_closer(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(20):
        value, weight = rng.standard_normal(12), rng.uniform(0.1, 2, 12)
        fitted = quality.monotone(value, weight)
        assert (np.diff(fitted) >= -1e-12).all()
        least = (weight * (fitted - value) ** 2).sum()
        for _ in range(200):
            other = np.sort(fitted + rng.standard_normal(12) * rng.choice([0.01, 0.1, 1]))
            assert (weight * (other - value) ** 2).sum() >= least - 1e-9


def risk(weights, bias, positive, rest, prior):
    """The class-prior-corrected risk with its second part kept from falling below zero, one document at a time."""
    def score(features):
        return bias + sum(weights[f] for f in features)

    as_toxic = sum(math.log1p(math.exp(-score(f))) for f in positive) / len(positive)
    as_clean = sum(math.log1p(math.exp(score(f))) for f in positive) / len(positive)
    unlabelled = sum(math.log1p(math.exp(score(f))) for f in rest) / len(rest)
    return prior * as_toxic + max(0.0, unlabelled - prior * as_clean)


def test_training_lowers_the_non_negative_risk():
    rng = np.random.default_rng(5)
    positive = [np.unique([1, 2, *rng.integers(10, 60, 4)]) for _ in range(80)]
    rest = [np.unique(np.append(rng.integers(10, 60, 6), [1] if i % 6 == 0 else [])).astype(int) for i in range(300)]
    prior = 1 / 6
    model = toxicity.train(positive, rest, prior)
    start = risk(np.zeros(toxicity.FEATURES), math.log(prior / (1 - prior)), positive, rest, prior)
    end = risk(model.weights, model.bias, positive, rest, prior)
    assert end < 0.6 * start
    # No small step in any learned direction, or of the bias, gains much.
    for feature in np.flatnonzero(model.weights).tolist():
        for step in (-0.3, 0.3):
            moved = model.weights.copy()
            moved[feature] += step
            assert risk(moved, model.bias, positive, rest, prior) > end - 0.02
    for step in (-0.3, 0.3):
        assert risk(model.weights, model.bias + step, positive, rest, prior) > end - 0.02
