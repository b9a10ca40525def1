"""Baum-Welch sums against a plain forward-backward pass, segments, and scores that do not depend on files."""

import random

import numpy as np
import pyarrow as pa
import pytest

from meterwatch.llm import lm


def random_model(rng, states=3, classes=7):
    simplex = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1] or None)
    return lm.Model(simplex(states), simplex(states, states), simplex(states, classes).T.copy())


def plain(model, sequence):
    """Sums of one sequence by unscaled products over all steps."""
    n, k = len(sequence), len(model.start)
    alpha, beta = np.zeros((n, k)), np.ones((n, k))
    alpha[0] = model.start * model.emit[sequence[0]]
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ model.move) * model.emit[sequence[t]]
    for t in range(n - 2, -1, -1):
        beta[t] = model.move @ (model.emit[sequence[t + 1]] * beta[t + 1])
    whole = alpha[-1].sum()
    gamma = alpha * beta / whole
    move = sum((np.outer(alpha[t], model.emit[sequence[t + 1]] * beta[t + 1]) * model.move / whole for t in range(n - 1)), np.zeros((k, k)))
    emit = np.zeros_like(model.emit)
    np.add.at(emit, sequence, gamma)
    return gamma[0], move, emit, np.log10(whole)


@pytest.mark.parametrize("segment", [1, 2, 7, 50_000])
def test_expected_counts_as_a_plain_pass(segment):
    rng = np.random.default_rng(4)
    model = random_model(rng)
    sequences = [rng.integers(0, 7, n) for n in (1, 1, 2, 9, 30, 30, 31, 5, 14)]
    want = [sum(parts) for parts in zip(*(plain(model, s) for s in sequences), strict=True)]
    got = lm.expected_counts(model, pa.array([s.tolist() for s in sequences], pa.list_(pa.int16())), segment)
    for a, b in zip(got, want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-10, atol=1e-12)


def test_a_very_long_text_is_held_in_segments():
    rng = np.random.default_rng(1)
    model = random_model(rng)
    model = lm.Model(*[x.astype(np.float32) for x in (model.start, model.move, model.emit)])
    start, move, emit, total = lm.expected_counts(model, pa.array([rng.integers(0, 7, 120_001)], pa.list_(pa.int16())))
    assert start.sum() == pytest.approx(1, abs=1e-4) and move.sum() == pytest.approx(120_000, rel=1e-4) and emit.sum() == pytest.approx(120_001, rel=1e-4)


def test_scores_do_not_depend_on_files(spark):
    rng = random.Random(5)
    pools = [[f"{c}{i}" for i in range(40)] for c in "abcd"]
    data = [(i, " ".join(rng.choice(pools[(i // 3) % 4]) for _ in range(rng.randint(0, 60)))) for i in range(400)] + [(7, None), (None, "a1 a2")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    scores = lambda df: {(r.doc_id, r.n_tokens): (r.score, r.base_score) for r in lm.digest(df).collect()}
    one, many = scores(docs.coalesce(1)), scores(docs.repartition(8, "text"))
    assert one.keys() == many.keys()
    for key, (score, base) in one.items():
        assert many[key] == pytest.approx((score, base), abs=0.02)
    # the model tells the pools apart, which single words cannot
    assert sum(s - b for s, b in one.values()) > 100
    assert lm.digest(docs.limit(0)).collect() == []
