from collections import defaultdict

import numpy as np
import pytest

from ebbtide.llm.queries import QUERIES
from ebbtide.llm.whitening import Centre, eigenvalues_above, fit_whitening, leading_eigenpairs
from tests.conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int, x string, deviation int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors, components=16):
    """Distinct x vectors, exact deviations, and whitened rows by a dense solver."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    values, found = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    own = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    white = own @ found[:, order] / np.sqrt(values[order])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, deviations, white, values[order] / values.sum()


def test_query_equals_a_dense_solver(spark):
    source = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    n, deviations, white, explained = brute([r.embedding for r in source])
    rows = defaultdict(dict)
    for r in QUERIES["op13_whitening"](spark, DATA).collect():
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        rows[r.vec_id][r.component] = r
    assert set(rows) == {r.vec_id for r in source}
    assert all(set(by) == set(range(1, 17)) for by in rows.values())
    got = np.array([[rows[r.vec_id][c].whitened for c in range(1, 17)] for r in source])
    assert [rows[r.vec_id][1].deviation for r in source] == deviations
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8


def test_awkward_rows(spark):
    random = np.random.default_rng(3)
    good = random.standard_normal((40, 5)).astype(np.float32).tolist()
    nan, infinite = float("nan"), float("inf")
    odd = [None, [], [None] * 5, [nan] * 5, [1.0] * 4 + [infinite], [1.0] * 4, [1.0] * 4 + [None]]
    vectors = good + odd + good[:7] * 3  # repeated rows
    whitening = fit_whitening(table(spark, vectors))
    assert whitening.centre.rows == 40 and len(whitening.eigenvalues) == 5
    rows = whitening.transform(table(spark, vectors)).collect()
    assert rows[0].asDict().keys() == {"vec_id", "embedding", "label", "x", "deviation", "whitened"}
    assert len(rows) == 40 + 21
    n, deviations, white, _ = brute(good, 5)
    by_id = {r.vec_id: r for r in rows}
    assert [by_id[i].deviation for i in range(40)] == deviations
    got = np.array([by_id[i].whitened for i in range(40)])
    assert np.allclose(got.T @ got / n, np.eye(5), atol=1e-9)
    assert np.allclose(np.abs(got), np.abs(white), atol=1e-8)


def test_nothing_to_whiten(spark):
    for vectors in ([], [None], [[]], [[1.0, 2.0]] * 3):
        whitening = fit_whitening(table(spark, vectors))
        assert len(whitening.eigenvalues) == 0 and whitening.identity_error == 0
        rows = whitening.transform(table(spark, vectors)).collect()
        assert [r.whitened for r in rows] == [[] for v in vectors if v is not None]


def test_rank_below_the_dimension(spark):
    random = np.random.default_rng(4)
    # Two dimensions repeat others, one is constant.
    vectors = [[a, b, a, b, 3.0] for a, b in random.integers(-9, 9, (60, 2)).astype(float).tolist()]
    whitening = fit_whitening(table(spark, vectors))
    assert len(whitening.eigenvalues) == 2
    assert sum(whitening.explained) == pytest.approx(1)


def test_huge_entries_stay_exact():
    centre = Centre(3, (3 * 10**13 + 1, 0), 10**13)
    x = np.array([[2 * 10**13, 0], [10**13, 5]])
    assert centre.deviations(x).to_pylist() == [None, 1 + 225]


def test_inertia_counts_eigenvalues():
    random = np.random.default_rng(5)
    for size in (1, 2, 3, 8, 33):
        a = random.standard_normal((size, size))
        a += a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*(values[:-1] + values[1:]) / 2, values[0] - 1, values[-1] + 1]:
            assert eigenvalues_above(a, shift) == (values > shift).sum()
    swapped = np.array([[0.0, 1.0], [1.0, 0.0]])  # needs a pivot of two rows
    assert eigenvalues_above(swapped, 0.0) == 1


@pytest.mark.parametrize(
    "values",
    [
        [3.0] * 10 + [1.0] * 10,  # the 16th equals the 17th
        [10.0**-i for i in range(30)],
        np.linspace(1, 2, 40)[::-1].tolist(),
        [2.0, 2 - 1e-13, 1.0, 0.0, 0.0],
    ],
)
def test_no_eigenpair_is_missed(spark, values):
    random = np.random.default_rng(6)
    turn, _ = np.linalg.qr(random.standard_normal((len(values), len(values))))
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    found, vectors = leading_eigenpairs(spark, a, 16)
    expected = [v for v in values if v > 1e-10 * values[0]][:16]
    assert np.allclose(found, expected, rtol=0, atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() < 1e-13
