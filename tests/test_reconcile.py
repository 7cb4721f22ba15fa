import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import hierarchy as H
from shelfcast.operators import panel as P
from shelfcast.operators import reconcile as REC
from tests.conftest import days

LEVELS = ["store", "state", "cat", "total"]


@pytest.fixture(scope="module")
def tree(retail_df):
    return P.build_hierarchy_map(retail_df)


@pytest.fixture(scope="module")
def edges(tree):
    return H.membership_edges(tree, LEVELS).cache()


def summing_matrix(edges):
    frame = edges.toPandas()
    bottoms = sorted(frame["bottom_id"].unique())
    nodes = bottoms + sorted(set(frame["node_id"]) - set(bottoms))
    S = np.zeros((len(nodes), len(bottoms)))
    for r in frame.itertuples():
        S[nodes.index(r.node_id), bottoms.index(r.bottom_id)] = 1
    return nodes, S


def noisy(spark, nodes, n=3, seed=1):
    rng = np.random.default_rng(seed)
    values = rng.uniform(1, 20, (len(nodes), n))
    dates = days("2016-01-01", n)
    rows = [(name, d, float(values[i, k])) for i, name in enumerate(nodes) for k, d in enumerate(dates)]
    return spark.createDataFrame(rows, "node_id string, date date, forecast double"), values, dates


def residual_rows(spark, nodes, T=12, seed=2):
    rng = np.random.default_rng(seed)
    common = rng.normal(size=T)
    R = rng.normal(size=(len(nodes), T)) * rng.uniform(0.5, 3, (len(nodes), 1)) + common
    rows = [(name, t, float(R[i, t])) for i, name in enumerate(nodes) for t in range(T)]
    return spark.createDataFrame(rows, "node_id string, t int, residual double"), R


def as_matrix(df, nodes, dates):
    out = np.zeros((len(nodes), len(dates)))
    for r in df.collect():
        out[nodes.index(r["node_id"]), dates.index(r["date"])] = r["forecast"]
    return out


def ledoit_wolf(R):
    X = (R - R.mean(axis=1, keepdims=True)).T
    T, n = X.shape
    S = X.T @ X / T
    mu = np.trace(S) / n
    d2 = ((S - mu * np.eye(n)) ** 2).sum()
    b2 = sum(((np.outer(x, x) - S) ** 2).sum() for x in X) / T**2
    weight = min(b2, d2) / d2
    return (1 - weight) * S + weight * mu * np.eye(n)


def dense(S, sigma, y):
    inv = np.linalg.pinv(sigma)
    return S @ np.linalg.pinv(S.T @ inv @ S) @ S.T @ inv @ y


def test_bottom_up_is_coherent(retail_df, retail):
    forecasts = retail_df.withColumnRenamed("sales", "forecast")
    rolled = H.bottom_up(forecasts)
    assert {r[0] for r in rolled.select("level").distinct().collect()} == set(H.LEVELS)
    total = {r["date"]: r["forecast"] for r in rolled.filter("level = 'total'").collect()}
    for d, v in retail.groupby("date")["sales"].sum().items():
        assert total[d] == pytest.approx(v, abs=1e-6)
    stores = rolled.filter("level = 'dept_store'").toPandas().set_index(["dept_id", "store_id", "date"])["forecast"]
    want = retail.groupby(["dept_id", "store_id", "date"])["sales"].sum()
    pd.testing.assert_series_equal(stores.sort_index(), want.sort_index(), check_names=False)
    assert H.check_coherence(rolled, 1e-6)
    broken = rolled.withColumn("forecast", F.when(F.col("level") == "store", F.col("forecast") + 5).otherwise(F.col("forecast")))
    assert not H.check_coherence(broken, 1.0)
    assert H.check_coherence(rolled.filter("level <> 'total'"), 1e-6)


def test_edges_shape(edges, tree):
    nodes, S = summing_matrix(edges)
    assert S.shape == (6 + 2 + 2 + 1 + 1, 6) and (S[-1] == 1).all()


def test_proportions_and_top_down(retail_df, retail):
    props = H.compute_proportions(retail_df).toPandas().set_index("id")["proportion"]
    assert props.sum() == pytest.approx(1)
    shares = retail.assign(share=retail["sales"] / retail.groupby("date")["sales"].transform("sum").clip(lower=1e-6))
    means = shares.groupby("id")["share"].mean()
    pd.testing.assert_series_equal(props.sort_index(), (means / means.sum()).sort_index(), check_names=False)
    top = retail_df.groupBy("date").agg(F.sum("sales").alias("forecast")).filter("date >= '2015-04-01'")
    down = H.top_down(top, H.compute_proportions(retail_df))
    again = down.groupBy("date").agg(F.sum("forecast").alias("s")).join(top, "date").toPandas()
    np.testing.assert_allclose(again["s"], again["forecast"])
    assert down.count() == 6 * top.count()


@pytest.mark.parametrize("method", ["ols", "wls", "shrink", "sample", "other"])
def test_projection_equals_dense_form(spark, edges, method):
    nodes, S = summing_matrix(edges)
    base, y, dates = noisy(spark, nodes)
    T = 60 if method == "sample" else 12
    residuals, R = residual_rows(spark, nodes, T)
    sigma = {"wls": np.diag(R.var(axis=1)), "shrink": ledoit_wolf(R), "sample": np.cov(R)}.get(method, np.eye(len(nodes)))
    got = as_matrix(REC.mint_reconcile(base, edges, residuals, method, "direct"), nodes, dates)
    np.testing.assert_allclose(got, dense(S, sigma, y), atol=1e-7)
    np.testing.assert_allclose(S @ got[: S.shape[1]], got, atol=1e-7)


def test_covariance_table(spark, edges):
    nodes, _ = summing_matrix(edges)
    residuals, R = residual_rows(spark, nodes)
    got = {r["node_id"]: r["variance"] for r in REC.covariance_table(residuals, "shrink").collect()}
    np.testing.assert_allclose([got[n] for n in nodes], np.diag(ledoit_wolf(R)))


@pytest.mark.parametrize("method", ["ols", "shrink"])
def test_iterative_solution_equals_direct(spark, edges, method):
    nodes, _ = summing_matrix(edges)
    base, _, dates = noisy(spark, nodes, 2)
    residuals, _ = residual_rows(spark, nodes)
    cov = REC.estimate_covariance(residuals, method)
    direct = as_matrix(REC.project(base, edges, cov, solver="direct"), nodes, dates)
    iterative = as_matrix(REC.project(base, edges, cov, solver="iterative"), nodes, dates)
    np.testing.assert_allclose(iterative, direct, atol=1e-6)


def test_iterative_solution_of_a_singular_system(spark, edges):
    """A sample covariance of four periods has rank three; the pseudo-inverse of C S C' is the reference."""
    nodes, S = summing_matrix(edges)
    base, y, dates = noisy(spark, nodes, 2)
    residuals, R = residual_rows(spark, nodes, 4)
    n = S.shape[1]
    C, sigma = np.hstack([-S[n:], np.eye(len(nodes) - n)]), np.cov(R)
    want = y - sigma @ C.T @ np.linalg.pinv(C @ sigma @ C.T, rcond=1e-10) @ C @ y
    got = as_matrix(REC.mint_reconcile(base, edges, residuals, "sample", "iterative"), nodes, dates)
    np.testing.assert_allclose(got, want, atol=1e-6)


def test_solver_is_named_and_direct_is_bounded(spark, edges, monkeypatch):
    nodes, _ = summing_matrix(edges)
    base, _, _ = noisy(spark, nodes, 2)
    with pytest.raises(ValueError, match="solver"):
        REC.ols_reconcile(base, edges, "guess")
    monkeypatch.setattr(REC, "MAX_DIRECT", 3)
    with pytest.raises(ValueError, match="aggregates"):
        REC.ols_reconcile(base, edges, "direct")


@pytest.mark.parametrize("shape, block", [((9, 30), 4), ((9, 30), 100), ((30, 9), 4), ((12, 12), 5)])
def test_gram_squares_by_tiles(spark, shape, block):
    rng = np.random.default_rng(4)
    x = rng.normal(size=shape) * (rng.random(shape) < 0.8)
    rows = [(f"n{i}", t, float(x[i, t])) for i in range(shape[0]) for t in range(shape[1]) if x[i, t]]
    got = REC.gram_squares(spark.createDataFrame(rows, "node_id string, t int, residual double"), *shape, block)
    assert got == pytest.approx(((x @ x.T) ** 2).sum())


def test_shrinkage_equals_dense_form(spark, edges):
    nodes, _ = summing_matrix(edges)
    residuals, R = residual_rows(spark, nodes)
    weight, mean = REC.shrinkage(REC.centred(residuals), len(nodes), R.shape[1])
    want = ledoit_wolf(R)
    n = len(nodes)
    np.testing.assert_allclose((1 - weight) * np.cov(R, bias=True) + weight * mean * np.eye(n), want)


def test_ols_keeps_coherent_input(spark, edges):
    nodes, S = summing_matrix(edges)
    _, y, dates = noisy(spark, nodes)
    y = S @ y[: S.shape[1]]
    rows = [(n, d, float(y[i, k])) for i, n in enumerate(nodes) for k, d in enumerate(dates)]
    base = spark.createDataFrame(rows, "node_id string, date date, forecast double").orderBy(F.rand(3))
    np.testing.assert_allclose(as_matrix(REC.ols_reconcile(base, edges, "direct"), nodes, dates), y, atol=1e-9)


def test_strategies(spark, retail_df, tree, edges):
    nodes, S = summing_matrix(edges)
    base, y, dates = noisy(spark, nodes)
    residuals, _ = residual_rows(spark, nodes)
    for method in REC.METHODS:
        got = as_matrix(REC.reconcile(method, base, tree, LEVELS, retail_df, residuals, solver="direct"), nodes, dates)
        np.testing.assert_allclose(S @ got[: S.shape[1]], got, atol=1e-7)
        if method == "bottom_up":
            np.testing.assert_allclose(got[:6], y[:6])
        if method == "top_down":
            np.testing.assert_allclose(got[-1], y[-1])
    with pytest.raises(ValueError):
        REC.reconcile("middle_out", base, tree)
