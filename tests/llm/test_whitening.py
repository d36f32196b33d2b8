import math
from fractions import Fraction

import numpy as np
import pytest

from ratingloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, v string, n string, dims string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "x", "x") for r in rows], SCHEMA)


def _symmetric(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 41.0),
        np.geomspace(1e-6, 1e6, 50),
        np.repeat([1.0, 2.0, 7.0], 20),
        np.concatenate((np.full(30, 3.0), 3.0 + 1e-9 * np.arange(20), [0.0] * 5)),
        np.ones(10),
        np.array([5.0]),
    ],
    ids=["even", "wide", "equal", "cluster", "identity", "one"],
)
def test_leading_components(values):
    matrix = _symmetric(np.random.default_rng(len(values)), values)
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading(matrix, 32)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    want = want[want > 1e-12 * want.sum()][:32]
    assert len(found) == len(want)
    assert np.allclose(found, want, rtol=1e-9, atol=1e-11 * want.max())
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-8
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-9 * want.max()


def test_inertia_counts():
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((30, 30))
    matrix = matrix + matrix.T
    values = np.linalg.eigvalsh(matrix)
    tri = whitening.tridiagonal(matrix)
    assert np.allclose(np.linalg.eigvalsh(np.diag(tri[0]) + np.diag(tri[1], 1) + np.diag(tri[1], -1)), values)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 50):
        assert whitening.count_above(*tri, shift) == (values > shift).sum()


def test_a_start_without_wanted_vectors_is_noticed(monkeypatch):
    """A subspace that misses eigenvectors fails the count and is made larger."""
    matrix = np.diag(np.arange(1.0, 21.0))
    assert len(whitening.feast(matrix, 4.5, 20.5, 16)[0]) == 16
    with pytest.raises(ArithmeticError):
        monkeypatch.setattr(whitening, "ROUNDS", 3)
        whitening.feast(matrix, 4.5, 20.5, 15)


def test_exact_products():
    rng = np.random.default_rng(1)
    for most in (100, 1 << 25, 1 << 33, 1 << 40):
        z = rng.integers(-most, most, (3000 if most == 100 else 60, 4))
        o = z.astype(object)
        assert (whitening._gram(z) == o.T @ o).all()


def _brute(rows, components=32):
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows]
    n, dims = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x)]
    centred = [[Fraction(n * a - s, n) for a, s in zip(row, sums)] for row in x]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(dims)] for i in range(dims)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    keep = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.sum()][:components]
    white = np.array([[float(c) for c in row] for row in centred]) @ vectors[:, keep]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, white / np.sqrt(values[keep]), values[keep] / values.sum(), deviation


def _held_against_brute(spark, rows, usable, least=1e-9):
    n, white, explained, deviation = _brute(usable)
    got = whitening.whiten(_frame(spark, rows).repartition(5)).collect()
    assert len(got) == white.size
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    sign = None
    for (vec_id, _), w, d in zip(usable, white, deviation):
        own = by_row[vec_id]
        assert sorted(own) == list(range(1, white.shape[1] + 1))
        assert {r.n for r in own.values()} == {n} and {r.deviation for r in own.values()} == {d}
        mine = np.array([own[k + 1].whitened for k in range(white.shape[1])])
        if sign is None:
            sign = np.sign(mine * w)
        assert np.allclose(mine, sign * w, atol=1e-7)
        assert np.allclose([own[k + 1].explained for k in range(len(explained))], explained, rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error}
    assert got[0].identity_error < least


def test_against_exact_fractions(spark):
    rng = np.random.default_rng(0)
    mixing = rng.standard_normal((40, 40))
    rows = [(i, [float(c) for c in rng.standard_normal(40) @ mixing]) for i in range(120)]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, []), (902, [nan] * 40), (903, [inf] + [0.0] * 39), (904, [None] * 40), (905, [1.0])]
    _held_against_brute(spark, rows + odd, rows)


def test_few_rows_flat_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [0.5, float(a), 2 * float(a), float(b)]) for i, (a, b) in enumerate(rng.standard_normal((9, 2)) * 300)]
    # The last component is the rounding of the third dimension, some 1e-9 of the variance.
    _held_against_brute(spark, rows, rows, 1e-6)


def test_repeated_rows_equal_vectors_and_empty(spark):
    same = _frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(_frame(spark, [])).count() == 0
    assert whitening.whiten(_frame(spark, [(1, None), (2, [])])).count() == 0
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -2.0])]
    got = whitening.whiten(_frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 3), (1, 1, 3), (1, 1, 3)]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 0.0]), (3, [0.0, 0.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(_frame(spark, rows)).collect()}
    assert got == {1: None, 2: None, 3: 0}
