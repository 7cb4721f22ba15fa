import math

import numpy as np
import pytest

from shelfcast.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, n long, whitened double, x array<long>, length int"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 1, None, None, 0) for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


def dense(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:32]
    order = order[values[order] > 1e-12 * values.max()]
    return centred @ vecs[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov), ((n * x - sums) ** 2).sum(axis=1)


def check(spark, vectors, tolerance=1e-8):
    white, explained, deviation = dense(vectors)
    k = len(explained)
    rows = sorted(W.whiten(frame(spark, vectors)).collect())
    assert len(rows) == len(vectors) * k
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < tolerance
    assert [r["component"] for r in rows] == list(range(1, k + 1)) * len(vectors)
    assert [r["deviation"] for r in rows[::k]] == deviation.tolist() and {r["n"] for r in rows} == {len(vectors)}
    assert np.allclose([r["explained"] for r in rows[:k]], explained, rtol=1e-10)
    (error,) = {r["identity_error"] for r in rows}
    assert error < 1e-9


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(0)
    check(spark, (rng.standard_normal((80, 12)) * np.linspace(0.2, 3, 12)).tolist())


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(1)
    check(spark, (rng.standard_normal((150, 40)) * np.geomspace(0.2, 4, 40)).tolist())


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(2)
    check(spark, rng.standard_normal((6, 10)).tolist())


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-100, 100, (2, 60)) / 64
    check(spark, np.stack([a, 2 * a, b, np.full(60, 0.5), a + b], axis=1).tolist())


def test_few_distinct_vectors_many_times(spark):
    check(spark, ([[1.0, 0.0, 0.0]] * 70 + [[0.0, 1.0, 0.0]] * 20 + [[0.0, 0.0, 3.0]] * 9))


def test_given_table(spark, tables):
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").orderBy("vec_id").collect()
    white, explained, deviation = dense([r["embedding"] for r in rows])
    got = sorted(W.whiten(spark.read.parquet(f"{tables}/embeddings.parquet")).collect())
    values = np.array([r["whitened"] for r in got]).reshape(white.shape)
    assert np.abs(values * np.sign((values * white).sum(axis=0)) - white).max() < 1e-6
    assert [r["deviation"] for r in got[::32]] == deviation.tolist()


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.0, 5.0], [3.0, 3.0]]
    bad = [None, [None, 1.0], [math.nan, 1.0], [math.inf, 0.0], [0.0, -math.inf]]
    got = W.whiten(frame(spark, good + bad, [7, 7, None, 8, 1, 2, 3, 4, 5])).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 7)] * 4 + [(False, 8)] * 2 + [(True, 0)] * 2
    assert {r["n"] for r in got} == {4}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None], [[]]])
def test_no_variance_no_rows(spark, vectors):
    got = W.whiten(frame(spark, vectors))
    assert got.count() == 0 and got.columns == [c.split()[0] for c in W.SCHEMA.split(", ")]


def test_lengths_are_fitted_apart(spark):
    got = W.whiten(frame(spark, [[1.0, 2.0], [2.0, 1.0], [0.0, 5.0], [1.0], [3.0]])).collect()
    assert sorted({(r["vec_id"], r["n"]) for r in got}) == [(0, 3), (1, 3), (2, 3), (3, 2), (4, 2)]


def test_very_large_entries(spark):
    got = W.whiten(frame(spark, [[1e300, 1.0], [-1e300, 2.0], [0.0, 3.0]])).collect()
    assert all(r["deviation"] is None for r in got if r["vec_id"] != 2) and all(np.isfinite(r["whitened"]) for r in got)


def test_steps_end_when_the_wanted_values_have_settled():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 200)) * np.append(np.geomspace(100, 1, 10), np.full(190, 1e-3))
    calls = []

    def product(q):
        calls.append(q)
        along = x @ q
        return x.T @ along, float(along @ along)

    right, small = W.bidiagonalise(product, 200, 4)
    assert len(calls) < 60 and np.abs(right @ right.T - np.eye(len(right))).max() < 1e-12
    assert np.allclose(np.linalg.svd(small)[1][:4], np.linalg.svd(x)[1][:4], rtol=1e-10)
