
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.catalog import retail as R
from shelfcast.operators import boosting as G
from shelfcast.operators import metrics as M
from shelfcast.operators import panel as P
from shelfcast.operators import seasonal as N
from shelfcast.plans.forecast_run import ForecastRun, preprocess_panel
from shelfcast.sources import calendar as C
from tests.conftest import days


@pytest.fixture(scope="module")
def boosted(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 1, (1500, 3))
    y = rng.poisson(np.exp(0.5 + 2 * x[:, 0]))
    rows = [(float(a), float(b), None if i % 9 == 0 else float(c), float(s)) for i, ((a, b, c), s) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, sales double").repartition(4).cache()
    model = G.fit_tweedie(df, df, ["a", "b", "c"], rounds=4, max_depth=3, learning_rate=0.3, feature_fraction=1.0)
    return df, model


def test_deviance_falls_and_forecasts_are_positive(boosted):
    df, model = boosted
    loss = lambda n: model.score(df, n).agg(G.deviance(F.col("sales"), F.col("score"))).first()[0]
    losses = [loss(n) for n in range(len(model.trees) + 1)]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert [h["train_loss"] for h in model.history] == pytest.approx(losses[1:])
    assert model.predict(df).agg(F.min("forecast")).first()[0] >= 0
    errors = [h["val_rmse"] for h in model.history]
    assert errors == sorted(errors, reverse=True)


def dense_tree(x, g, h, depth, l2, least, rate):
    """Leaf value of each row by trying every cut of every feature."""
    worth = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + l2)

    def grow(rows, depth):
        best = (1e-12, None)
        for f in range(x.shape[1]) if depth else []:
            for cut in np.unique(x[rows, f])[:-1]:
                low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(low), len(high)) >= least:
                    best = max(best, (worth(low) + worth(high) - worth(rows), (-f, cut)), key=lambda b: b[0])
        if best[1] is None:
            out[rows] = -rate * g[rows].sum() / (h[rows].sum() + l2)
            return
        f, cut = -best[1][0], best[1][1]
        grow(rows[x[rows, f] <= cut], depth - 1)
        grow(rows[x[rows, f] > cut], depth - 1)

    out = np.zeros(len(x))
    grow(np.arange(len(x)), depth)
    return out


def test_tree_equals_an_exhaustive_search(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (300, 3)).astype(float)
    y = rng.poisson(np.exp(0.2 * x[:, 0] - 0.1 * x[:, 2])).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, sales double").repartition(3)
    whole = {"feature_fraction": 1.0, "bagging_fraction": 1.0, "learning_rate": 0.4, "min_rows_per_leaf": 7}
    model = G.fit_tweedie(df, None, ["a", "b", "c"], rounds=3, max_depth=3, **whole)
    score = np.full(300, np.log(y.mean()))
    for _ in range(3):
        g, h = G.derivatives(y, score)
        score += dense_tree(x, g, h, 3, 0.1, 7, 0.4)
    got = model.score(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double"))
    np.testing.assert_allclose([r["score"] for r in got.orderBy("i").collect()], score, rtol=1e-9)


def test_a_resumed_fit_equals_an_unbroken_one(spark, boosted, tmp_path, monkeypatch):
    df, _ = boosted
    monkeypatch.setattr(G, "CUT_EVERY", 2)
    fit = lambda log=None: G.fit_tweedie(df, df, ["a", "b", "c"], rounds=5, max_depth=2, learning_rate=0.3, log=log)
    want, grow, log = fit(), G.grow_tree, str(tmp_path / "log")

    def lost(rows, trees, *rest):
        if len(grown) == 3:
            raise RuntimeError("driver lost")
        grown.append(1)
        return grow(rows, trees, *rest)

    grown = []
    monkeypatch.setattr(G, "grow_tree", lost)
    with pytest.raises(RuntimeError):
        fit(log)
    grown = [0] * 10
    again = fit(log)
    assert len(grown) == 13 and len(again.history) == 5
    # Sums come together in any order, so the last digit may differ.
    for a, b in zip(again.history, want.history):
        assert a == pytest.approx(b)
    for a, b in zip(again.trees, want.trees):
        assert (a.feature, a.bin, a.left) == (b.feature, b.bin, b.left) and a.value == pytest.approx(b.value)


def test_a_pass_reads_blocks_and_joins_few_parts(spark, boosted):
    df, model = boosted
    edges = G.bin_edges(df, model, 256)
    rows = G.binned(df, model, edges)
    assert rows.count() == df.rdd.getNumPartitions() < df.count()
    found = list(G.unpacked(iter(rows.toArrow().to_batches()), model.trees[:2]))
    assert sum(len(r) for r, *_ in found) == len({i for r, *_ in found for i in r}) == df.count()
    for _, _, score, cells in found:
        # The sweep over the nodes ends where the walk down from the root does.
        whole = np.array([[edges[f][b] if b < len(edges[f]) else np.inf for b in row] for f, row in enumerate(cells)])
        want = model.start + sum(t.scores(whole, False) for t in model.trees[:2])
        np.testing.assert_allclose(score, want, rtol=1e-12)
    tasks = []
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    best, G.best_splits = G.best_splits, lambda parts, params, n: tasks.append(n) or best(parts, params, n)
    try:
        G.grow_tree(rows, [], edges, [0, 1, 2], model.params, 1)
    finally:
        G.best_splits = best
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert tasks == [1] * len(tasks) and tasks


def test_training_reads_the_line_items_once_for_sales_and_prices(spark, tables):
    sold = R.sold_days(spark, tables)
    for df in (R.dated_panel_of(spark, tables, sold), R.prices_of(sold)):
        assert not any("lineitem" in f for f in df.inputFiles())
    keys = ["store_id", "item_id", "wm_yr_wk"]
    whole = R.prices(spark, tables)
    both = whole.join(R.prices_of(sold).withColumnRenamed("sell_price", "again"), keys)
    assert both.filter(F.abs(F.col("sell_price") - F.col("again")) < 1e-9).count() == whole.count() > 0
    order = ["id", "date"]
    assert R.dated_panel_of(spark, tables, sold).orderBy(*order).collect() == R.dated_panel(spark, tables).orderBy(*order).collect()


def test_scoring_plans_do_not_grow_with_the_trees(spark, boosted):
    df, model = boosted
    many = G.TweedieModel(model.params, model.feature_cols, model.start, model.trees * 50)
    size = lambda m: len(m.predict(df)._jdf.queryExecution().toString())
    assert size(many) < 1.1 * size(model)


def test_all_rows_of_one_value_make_no_split(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 60, "a double, sales double")
    model = G.fit_tweedie(df, None, ["a", "missing"], rounds=2, max_depth=3)
    assert [t.left for t in model.trees] == [[-1], [-1]]
    assert model.predict(df).first()["forecast"] == pytest.approx(2.0)


def test_importance_finds_the_driver(spark, boosted):
    _, model = boosted
    top = G.top_features(model.importance_table(spark), 2).collect()
    assert top[0]["feature"] == "a" and len(top) == 2 and top[0]["importance"] > 10 * top[1]["importance"]


def test_model_round_trip(spark, boosted, tmp_path):
    df, model = boosted
    model.save(spark, str(tmp_path / "m"))
    again = G.TweedieModel.load(spark, str(tmp_path / "m"))
    total = lambda m: m.predict(df).agg(F.sum("forecast")).first()[0]
    assert total(again) == pytest.approx(total(model)) and again.feature_cols == model.feature_cols
    G.TweedieModel(model.params, model.feature_cols, model.start, model.trees[:1]).save(spark, str(tmp_path / "m"))
    assert len(G.TweedieModel.load(spark, str(tmp_path / "m")).trees) == 1


def test_early_stopping_keeps_the_best_round(spark):
    rows = [(float(i % 7), float(i % 3)) for i in range(400)]
    train = spark.createDataFrame(rows, "a double, sales double")
    val = train.withColumn("sales", 2 - F.col("sales"))
    model = G.fit_tweedie(train, val, ["a"], early_stopping_rounds=2, rounds=8, max_depth=2, learning_rate=0.5)
    errors = [h["val_rmse"] for h in model.history]
    assert len(model.trees) == int(np.argmin(errors)) + 1 and len(errors) <= 8


def test_gradient_matches_numeric_derivative(spark):
    df = spark.createDataFrame([(3.0, 0.4), (0.0, -0.2)], "sales double, score double")
    h = 1e-5
    loss = lambda s: G.deviance(F.col("sales"), F.col("score") + s)
    slope = df.groupBy("sales").agg(((loss(h) - loss(-h)) / (2 * h)).alias("d"))
    bend = df.groupBy("sales").agg(((loss(h) - 2 * loss(0) + loss(-h)) / h**2).alias("d2"))
    s, f = F.col("sales"), F.col("score")
    got = df.select("sales", G.gradient(s, f).alias("g"), G.hessian(s, f).alias("h")).join(slope, "sales").join(bend, "sales")
    for r in got.collect():
        assert r["g"] == pytest.approx(r["d"], abs=1e-6) and r["h"] == pytest.approx(r["d2"], rel=1e-3)


def harmonic(spark, n=800, short=30):
    rows = []
    for i, d in enumerate(days("2014-01-01", n)):
        t = d.toordinal() - 719163
        y = 4 + 0.5 * np.sin(2 * np.pi * t / 365.25) + 0.3 * np.cos(2 * np.pi * t / 7) + 0.0005 * i
        rows.append(("big", d, float(np.expm1(y))))
        if i < short:
            rows.append(("short", d, 5.0))
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


def test_seasonal_model_recovers_a_harmonic(spark, tmp_path):
    df = harmonic(spark)
    model = N.fit_groups(df, "store_id", C.holiday_table(spark))
    assert [r[0] for r in model.coefficients.select("store_id").collect()] == ["big"]
    ahead = model.predict(28).toPandas().sort_values("ds")
    assert len(ahead) == 28
    for i, r in enumerate(ahead.itertuples()):
        t = r.ds.toordinal() - 719163
        y = 4 + 0.5 * np.sin(2 * np.pi * t / 365.25) + 0.3 * np.cos(2 * np.pi * t / 7) + 0.0005 * (800 + i)
        assert np.log1p(r.yhat) == pytest.approx(y, abs=0.02)
        assert 0 <= r.yhat_lower <= r.yhat <= r.yhat_upper
    weekly = model.components(0).toPandas()
    assert len(weekly) == 800 and weekly["weekly"].max() == pytest.approx(0.3, abs=0.02)
    total = weekly[["trend", "yearly", "weekly", "holidays", "regressors"]].sum(axis=1)
    np.testing.assert_allclose(total, weekly["log_yhat"])
    model.save(str(tmp_path / "s"))
    again = N.SeasonalModel.load(spark, str(tmp_path / "s")).predict(28).toPandas().sort_values("ds")
    np.testing.assert_allclose(again["yhat"], ahead["yhat"])


def test_regressor_effect(spark):
    df = harmonic(spark, 400)
    flags = C.days_between(spark.createDataFrame([(days("2014-01-01", 1)[0], days("2014-01-01", 500)[-1])], "first date, last date"))
    flags = flags.select("date", (F.dayofmonth("date") <= 6).cast("int").alias("snap"))
    lifted = df.join(flags, "date").withColumn("sales", F.expm1(F.log1p("sales") + 0.4 * F.col("snap"))).drop("snap")
    parts = N.fit_groups(lifted, "store_id", regressors=flags).components(0)
    assert parts.agg(F.max("regressors")).first()[0] == pytest.approx(0.4, abs=0.03)


def test_prepared_series_clamps_and_logs(retail_df, retail):
    got = N.prepare_series(retail_df, "store_id").toPandas().set_index(["store_id", "ds"])["y"]
    want = np.log1p(retail.groupby(["store_id", "date"])["sales"].sum())
    np.testing.assert_allclose(got.sort_index(), want.sort_index())


@pytest.mark.parametrize("method", ["bottom_up", "mint"])
def test_forecast_run(spark, retail_df, method):
    bounds = C.date_bounds(retail_df)
    long = P.merge_calendar(retail_df, C.build_calendar(bounds), "date")
    prices = long.select("store_id", "item_id", "wm_yr_wk").distinct().withColumn("sell_price", F.lit(2.0) + F.pmod(F.hash("item_id", "wm_yr_wk"), F.lit(3)))
    done = preprocess_panel(long, prices)
    run = ForecastRun(done, method=method, context_lag=28, boosting={"rounds": 2, "max_depth": 3, "min_rows_per_leaf": 5})
    run.run()
    assert run.results["forecasts"].count() == 6 * 28
    assert run.results["store_forecasts"].count() == 2 * 28
    levels = {r["level"]: r["n"] for r in run.results["reconciled"].groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert len(levels) == 9 and levels["total"] == 28 and levels["item_store"] == 168
    assert {r["metric"] for r in run.results["improvement"].collect()} == {"MAE", "RMSE", "MAPE", "SMAPE"}
    assert run.results["wrmsse"].first()[0] > 0
    groups = {(r["level"], r["group"]) for r in run.results["by_level"].collect()}
    own = {(k, r[k]) for r in retail_df.select("store_id", "cat_id", "dept_id").distinct().collect() for k in r.asDict()}
    assert groups == own | {("total", "all")}
    val = retail_df.filter(F.col("date") >= P.validation_start(retail_df))
    train = retail_df.join(val, ["id", "date"], "left_anti")
    want = M.wrmsse(val, run.results["forecasts"], train, M.revenue_weights(train, prices)).first()[0]
    assert run.results["wrmsse"].first()[0] == pytest.approx(want)


def test_each_store_has_the_flag_of_its_own_state(spark):
    import pandas as pd

    from shelfcast.catalog import models as M

    dates, rng = days("2015-01-01", 200), np.random.default_rng(1)
    flags = pd.DataFrame({"date": dates} | {c: rng.integers(0, 2, 200) for c in ("snap_CA", "snap_TX", "snap_WI")})
    own = {"AFRICA_0": "snap_CA", "AMERICA_0": "snap_TX", "ASIA_1": "snap_WI", "EUROPE_0": None}
    rows = [
        {"store_id": s, "state_id": s[:-2], "date": d, "sales": 100.0 * (1 + (flags[c][i] if c else 0))}
        for s, c in own.items()
        for i, d in enumerate(dates)
    ]
    df = spark.createDataFrame(pd.DataFrame(rows))
    model = N.fit_groups(df, "store_id", None, M.store_flags(df, spark.createDataFrame(flags)))
    got = {(r["store_id"], r["ds"]): r["regressors"] for r in model.components(0).collect()}
    assert len(got) == 800
    for s, c in own.items():
        for i, d in enumerate(dates):
            assert abs(got[s, d] - (0.69 if c and flags[c][i] else 0.0)) < 0.05


def test_base_residuals_span_all_days(spark):
    from shelfcast.catalog.models import base_residuals

    rows = [("n", d, float(i % 5)) for i, d in enumerate(days("2015-01-01", 100))]
    assert base_residuals(spark.createDataFrame(rows, "node_id string, date date, sales double")).count() == 100
