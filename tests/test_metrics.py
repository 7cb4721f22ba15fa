from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.operators import explore as Q
from shelfcast.operators import metrics as M
from shelfcast.operators import panel as P
from tests.conftest import days


def frame(spark, name, values, first="2015-01-01", series="a"):
    rows = [(series, d, float(v)) for d, v in zip(days(first, len(values)), values)]
    return spark.createDataFrame(rows, f"id string, date date, {name} double")


def test_perfect_forecast_has_no_error(spark):
    row = M.evaluate_forecasts(frame(spark, "sales", [1, 2, 3]), frame(spark, "forecast", [1, 2, 3])).first()
    assert (row["n_rows"], row["MAE"], row["RMSE"], row["MAPE"], row["SMAPE"]) == (3, 0, 0, 0, 0)


def test_mape_value(spark):
    row = M.evaluate_forecasts(frame(spark, "sales", [100, 200]), frame(spark, "forecast", [110, 190])).first()
    assert row["MAPE"] == pytest.approx(7.5) and row["MAE"] == pytest.approx(10)


def test_zero_actuals(spark):
    row = M.evaluate_forecasts(frame(spark, "sales", [0, 0]), frame(spark, "forecast", [0, 2])).first()
    assert row["MAPE"] == pytest.approx(100) and row["SMAPE"] == pytest.approx(100)


def test_no_common_rows_gives_no_report(spark):
    assert M.evaluate_forecasts(frame(spark, "sales", [1]), frame(spark, "forecast", [1], "2016-01-01")).isEmpty()


def test_rmsse_of_flat_forecast(spark):
    train = frame(spark, "sales", range(100))
    actual, flat = frame(spark, "sales", range(100, 128), "2015-04-11"), frame(spark, "forecast", [99] * 28, "2015-04-11")
    assert M.rmsse(actual, flat, train).first()["rmsse"] == pytest.approx(np.sqrt(275.5))
    still = frame(spark, "sales", [5] * 30)
    assert M.rmsse(actual, flat, still).first()["rmsse"] == 0.0
    assert M.rmsse(actual, flat, frame(spark, "sales", [1])).isEmpty()


def brute_wrmsse(retail, prices, days_back=28):
    last = retail["date"].max()
    cut = last - pd.Timedelta(days=days_back - 1).to_pytimedelta()
    train, val = retail[retail["date"] < cut], retail[retail["date"] >= cut]
    total = weighted = 0.0
    start = train["date"].max() - pd.Timedelta(days=28).to_pytimedelta()
    for i, own in val.groupby("id"):
        past = train[train["id"] == i].sort_values("date")
        level = past["sales"].tail(7).mean()
        scale = np.mean(np.diff(past["sales"]) ** 2)
        score = np.sqrt(np.mean((own["sales"] - level) ** 2) / scale)
        weight = past[past["date"] > start]["sales"].sum() * prices.get(i, 1.0)
        total, weighted = total + weight, weighted + weight * score
    return weighted / total


def test_wrmsse_against_brute_force(spark, retail_df, retail):
    prices = spark.createDataFrame(
        [("S0_1", "item_0", 1, 2.0), ("S0_1", "item_0", 2, 4.0), ("S1_1", "item_1", 1, 5.0)],
        "store_id string, item_id string, wm_yr_wk int, sell_price double",
    )
    train, val = P.train_val_split(retail_df)
    naive = M.naive_baseline(val, train)
    weights = M.revenue_weights(train, prices)
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(1)
    got = M.wrmsse(val, naive, train, weights).first()["wrmsse"]
    assert got == pytest.approx(brute_wrmsse(retail, {"item_0_S0_1": 3.0, "item_1_S1_1": 5.0}))
    levels = M.wrmsse_levels(val, naive, train, weights, P.build_hierarchy_map(retail_df)).collect()
    assert {r["level"]: r["wrmsse"] for r in levels}["item_store"] == pytest.approx(got) and len(levels) == 6


def test_naive_baseline_fills_unknown_ids(spark):
    train = frame(spark, "sales", [1] * 3 + [8] * 7)
    val = frame(spark, "sales", [0, 0], "2015-02-01").unionByName(frame(spark, "sales", [0, 0], "2015-02-01", "new"))
    got = {(r["id"], r["date"].day): r["forecast"] for r in M.naive_baseline(val, train).collect()}
    assert got == {("a", 1): 8.0, ("a", 2): 8.0, ("new", 1): 0.0, ("new", 2): 0.0}


def test_levels_agree_with_single_level(retail_df):
    train, val = P.train_val_split(retail_df)
    naive = M.naive_baseline(val, train)
    many = {(r["level"], r["group"]): r["MAE"] for r in M.evaluate_levels(val, naive, ["store_id", "dept_id"]).collect()}
    for r in M.evaluate_forecasts(val, naive, "dept_id").collect():
        assert many[("dept_id", r["group"])] == pytest.approx(r["MAE"])
    assert many[("total", "all")] == pytest.approx(M.evaluate_forecasts(val, naive).first()["MAE"])
    table = M.evaluate_hierarchy(M.pair_forecasts(val, naive)).collect()
    assert len(table) == 9


def test_percent_change_guards(spark):
    df = spark.createDataFrame([(2.0, 4.0), (2.0, 0.0), (2.0, None), (1.0, -2.0)], "new double, old double")
    assert [r[0] for r in df.select(S.percent_change(F.col("new"), F.col("old"))).collect()] == [-50.0, 0.0, 0.0, 150.0]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    counts, edges = np.histogram(values, bins=60)
    got = {r["bin"]: r for r in M.histogram(df, "x", 60).collect()}
    assert [got[i]["n"] if i in got else 0 for i in range(60)] == counts.tolist()
    assert all(got[i]["bin_start"] == pytest.approx(edges[i]) for i in got)
    same = M.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", 4).collect()
    assert [(r["bin"], r["n"]) for r in same] == [(0, 2)]


def test_feature_families(spark):
    names = ["sales_lag_7", "rolling_std_7", "price_max", "sell_price", "is_weekend", "store_daily_mean", "has_event", "snap", "dept_id"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["f"] for r in df.select("n", S.feature_family(F.col("n")).alias("f")).collect()}
    assert got == dict(zip(names, ["lag", "rolling", "price", "price", "calendar", "id", "other", "other", "id"]))


def test_explore_profiles(retail_df, retail):
    summary = Q.dataset_summary(retail_df).first()
    assert tuple(summary) == (3, 2, 6, 120, 720)
    got = [r["weekday"] for r in Q.weekday_profile(retail_df).collect()]
    assert got == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    rate = Q.zero_rate(retail_df).first()["zero_rate"]
    assert rate == pytest.approx((retail["sales"] == 0).mean())
    marked = retail_df.withColumn("event_name_1", F.when(F.col("date") == date(2015, 2, 14), "V"))
    daily = retail.groupby("date")["sales"].sum()
    up = Q.event_uplift(marked).first()["uplift_pct"]
    assert up == pytest.approx((daily[date(2015, 2, 14)] / daily.mean() - 1) * 100)
