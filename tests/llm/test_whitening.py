"""Whitening against numpy's dense eigenvectors and Python's integers."""

import math

import numpy as np
import pytest

from tributary.llm import whitening as W


def brute(vectors, components=8):
    """Integers, exact deviations, and dense whitening by numpy."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    return deviations, values, centred @ turn / np.sqrt(values), values / (centred**2).sum() * n


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12)) * np.linspace(1, 0.2, 12)
    return (rng.normal(size=(500, 12)) @ mix).astype(np.float32)


def test_whitening_equals_dense(spark, vectors):
    rows = [(i, [float(c) for c in v], 1, "clash") for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [1.0] * 11), (903, [None] + [1.0] * 11), (904, [float("nan")] * 12), (905, [float("inf")] + [0.0] * 11), (906, [1e30] + [0.0] * 11)]
    ids = [(1 << 60) + 1, None, 7, (1 << 60) + 3]
    rows = [(ids[i] if i < 4 else i, *r[1:]) for i, r in enumerate(rows)] + [(i, v, 1, "x") for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, x string").repartition(5)
    got = W.whitened(df).collect()
    deviations, values, whitened, explained = brute(vectors.astype(float))
    assert len(got) == 500 * 8 and {r.n for r in got} == {500}
    assert all(r.identity_error < 1e-10 for r in got) and len({r.identity_error for r in got}) == 1
    key = lambda i, d: (i is None, i or 0, d)
    by_row = {}
    for r in got:
        by_row.setdefault(key(r.vec_id, r.deviation), {})[r.component] = r
    want = {key(ids[i] if i < 4 else i, deviations[i]): i for i in range(500)}
    assert set(by_row) == set(want)
    for c in range(8):
        ours = np.array([by_row[k][c + 1].whitened for k in want])
        theirs = whitened[list(want.values()), c]
        theirs = theirs * np.sign(ours @ theirs)
        assert np.abs(ours - theirs).max() < 1e-8
        assert abs(got[0].n - 500) == 0 and abs(next(r.explained for r in got if r.component == c + 1) - explained[c]) < 1e-12


def test_few_dimensions_equal_vectors_and_no_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert W.whitened(make([])).count() == 0
    assert W.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whitened(make([(1, [1.0, 2.0])])).count() == 0
    got = W.whitened(make([(i, [float(i % 7), float(i % 3)]) for i in range(40)])).collect()
    assert len(got) == 80 and all(r.identity_error < 1e-10 for r in got)
    line = W.whitened(make([(i, [float(i), 2.0 * i]) for i in range(40)])).collect()  # rank one
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    wide = W.whitened(make([(1, [3e9, 0.0]), (2, [-3e9, 1.0]), (3, [3e9, 1.0])])).collect()
    assert {r.deviation for r in wide} == {None}  # no long holds it


@pytest.mark.parametrize("size,wanted", [(64, 8), (20, 3), (300, 8), (5, 8)])
def test_largest_on_close_and_repeated_values(size, wanted):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = np.sort(rng.uniform(0.5, 1, size))[::-1]
    values[:2] = values[0]  # a double one
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    calls = []

    def times(block):
        calls.append(block.shape[1])
        return a @ block

    got, vectors = W.largest(times, size, wanted)
    wanted = min(wanted, size)
    assert np.abs(got - values[:wanted]).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert len(calls) < 200
    print(size, len(calls))


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(9, 9)))[0]
    a = (q * np.arange(1.0, 10)) @ q.T
    u = q[:, [8]] + 0.01 * q[:, [3]]
    u /= np.linalg.norm(u)
    theta = (u.T @ a @ u)[0]
    r = a @ u - u * theta
    t = W.corrections(lambda b: a @ b, theta, r, u)
    p = np.eye(9) - u @ u.T
    assert np.linalg.norm(p @ (a - theta[0] * np.eye(9)) @ p @ t + r) <= 0.03 * np.linalg.norm(r) and abs(u.T @ t) < 1e-12
