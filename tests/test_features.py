from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.fixed_values import FEATURES, LAGS, WINDOWS
from shelfcast.operators import features as X
from shelfcast.operators import panel as P
from shelfcast.operators import recursive as V


def in_order(df):
    return df.toPandas().sort_values(["id", "date"]).reset_index(drop=True)


def test_lags_match_pandas_and_do_not_leak(retail_df, retail):
    got = in_order(X.add_lag_features(retail_df))
    frame = retail.sort_values(["id", "date"]).reset_index(drop=True)
    for n in LAGS:
        want = frame.groupby("id")["sales"].shift(n)
        pd.testing.assert_series_equal(got[f"sales_lag_{n}"], want, check_names=False)
    assert got.groupby("id").head(7)["sales_lag_7"].isna().all()


def check_rolling(got, frame):
    shifted = frame.groupby("id")["sales"].shift(28)
    for k in WINDOWS:
        rolling = shifted.groupby(frame["id"]).rolling(k, min_periods=1)
        for name, want in (("mean", rolling.mean()), ("std", rolling.std())):
            want = want.reset_index(level=0, drop=True).sort_index()
            np.testing.assert_allclose(got[f"rolling_{name}_{k}"], want, rtol=1e-9, atol=1e-7, equal_nan=True)


def test_rolling_matches_pandas(retail_df, retail):
    check_rolling(in_order(X.add_rolling_features(retail_df)), retail.sort_values(["id", "date"]).reset_index(drop=True))


def test_rolling_of_fractions_and_gaps(spark, retail):
    frame = retail.sort_values(["id", "date"]).reset_index(drop=True).copy()
    frame["sales"] = frame["sales"] * 0.37 + 1000.1
    frame.loc[frame.index % 11 == 0, "sales"] = np.nan
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame[["id", "date", "sales"]].itertuples(index=False)]
    df = spark.createDataFrame(rows, "id string, date date, sales double")
    check_rolling(in_order(X.add_rolling_features(df)), frame)


def test_calendar_lag_differs_from_row_lag_on_gaps(spark):
    rows = [("a", date(2015, 1, 1), 1.0), ("a", date(2015, 1, 3), 2.0), ("a", date(2015, 1, 8), 3.0)]
    df = spark.createDataFrame(rows, "id string, date date, sales double")
    by_day = in_order(X.add_calendar_lags(df, [7]))["sales_lag_7"].tolist()
    by_row = in_order(X.add_lag_features(df, [1]))["sales_lag_1"].tolist()
    assert by_day == [0.0, 0.0, 1.0] and by_row[1:] == [1.0, 2.0]


def priced(df):
    return df.withColumn("sell_price", F.lit(2.0) + F.pmod(F.hash("id", "date"), F.lit(7)))


def test_price_features_match_pandas(spark, retail_df):
    df = priced(retail_df)
    frame = in_order(df)
    got = in_order(X.add_price_features(df))
    groups = frame.groupby("id")["sell_price"]
    np.testing.assert_allclose(
        got["price_roll_mean_28"], groups.rolling(28, min_periods=1).mean().reset_index(level=0, drop=True)
    )
    np.testing.assert_allclose(got["price_change"], groups.diff().fillna(0))
    np.testing.assert_allclose(got["price_relative"], frame["sell_price"] / groups.transform("mean"))
    top = groups.transform("max")
    np.testing.assert_allclose(got["price_discount"], (top - frame["sell_price"]) / top.clip(lower=0.01))


def test_price_statistics_as_of(retail_df):
    df = priced(retail_df)
    cut = date(2015, 4, 1)
    got = in_order(X.add_price_features(df, as_of=F.lit(cut)))
    early = in_order(X.add_price_features(df.filter(F.col("date") < cut)))
    full = in_order(X.add_price_features(df))
    np.testing.assert_allclose(got[got["date"] < cut]["price_relative"], early["price_relative"])
    np.testing.assert_allclose(got[got["date"] >= cut]["price_max"], full[full["date"] >= cut]["price_max"])


def test_context_means_and_lag(retail_df, retail):
    got = in_order(X.add_context_features(retail_df))
    frame = retail.sort_values(["id", "date"]).reset_index(drop=True)
    np.testing.assert_allclose(got["store_daily_mean"], frame.groupby(["store_id", "date"])["sales"].transform("mean"))
    np.testing.assert_allclose(got["dept_daily_mean"], frame.groupby(["dept_id", "date"])["sales"].transform("mean"))
    late = in_order(X.add_context_features(retail_df, 28))
    np.testing.assert_allclose(
        late["store_daily_mean"], got.groupby("id")["store_daily_mean"].shift(28), equal_nan=True
    )


def test_build_features_has_every_input(retail_df):
    df = priced(retail_df).withColumns({"event_name_1": F.lit(None).cast("string"), "snap": F.lit(0)})
    built = X.build_features(df)
    assert set(FEATURES) <= set(built.columns)
    assert built.filter("sales_lag_28 IS NULL OR rolling_mean_28 IS NULL").isEmpty()
    train, val = X.split_features(df, P.validation_start(df))
    whole = X.build_features(df, training=False)
    pick = lambda d: in_order(d.select("id", "date", "sales_lag_28", "rolling_std_56"))
    last = whole.agg(F.max("date")).first()[0]
    pd.testing.assert_frame_equal(pick(val), pick(whole.filter(F.col("date") > last - timedelta(days=28))))
    assert train.agg(F.max("date")).first()[0] < val.agg(F.min("date")).first()[0]


def test_inference_features_equal_panel_features(retail_df):
    last = retail_df.agg(F.max("date")).first()[0]
    history = retail_df.filter(F.col("date") < last)
    series = P.build_hierarchy_map(retail_df).withColumns({"sell_price": F.lit(3.0), "snap": F.lit(0)})
    got = in_order(V.inference_features(series, history, last))
    full = X.add_rolling_features(X.add_lag_features(retail_df)).filter(F.col("date") == last)
    want = in_order(full)
    for c in [f"sales_lag_{n}" for n in LAGS] + [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9)
    recent = in_order(history.filter(F.col("date") >= last - timedelta(days=8)))
    means = recent.groupby("store_id")["sales"].mean()
    np.testing.assert_allclose(got["store_daily_mean"], got["store_id"].map(means))


def test_recursive_forecast_uses_its_own_predictions(retail_df):
    last = retail_df.agg(F.max("date")).first()[0]
    series = P.build_hierarchy_map(retail_df).withColumns({"sell_price": F.lit(3.0), "snap": F.lit(0)})
    predict = lambda df: df.withColumn("forecast", F.col("sales_lag_7") + 1)
    got = V.recursive_forecast(predict, series, retail_df, horizon=8).toPandas()
    assert len(got) == 6 * 8 and not got.duplicated(["id", "date"]).any()
    old = {(r["id"], r["date"]): r["sales"] for r in retail_df.collect()}
    new = {(r.id, r.date): r.forecast for r in got.itertuples()}
    for (i, d), value in new.items():
        before = d - timedelta(days=7)
        assert value == (new[(i, before)] if before > last else old[(i, before)]) + 1


def test_state_features_equal_history_features(spark, retail_df):
    """Also with missing days, a series without recent rows and windows that are only partly there."""
    last = retail_df.agg(F.max("date")).first()[0]
    holes = retail_df.filter((F.hash("id", "date") % 3 != 0) & ~((F.col("id") == "item_0_S0_1") & (F.col("date") > last - timedelta(days=90))))
    series = P.build_hierarchy_map(retail_df).withColumns({"sell_price": F.lit(3.0), "snap": F.lit(0)})
    want = in_order(V.inference_features(series, holes, last + timedelta(days=1)))
    state = V.series_state(series, holes, last)
    got = in_order(V.with_day_inputs(V.join_state_context(state, {"store_id": 2, "dept_id": 2}).withColumns(V.state_features()), last + timedelta(days=1)))
    for c in want.columns:
        if c in ("id", "date") or want[c].dtype == object:
            assert (got[c] == want[c]).all()
        else:
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9)


def test_recursive_forecast_equals_one_day_after_the_other(retail_df):
    """The carried state gives what features from the whole history give, day by day."""
    last = retail_df.agg(F.max("date")).first()[0]
    series = P.build_hierarchy_map(retail_df).withColumns({"sell_price": F.lit(3.0), "snap": F.lit(0)})
    inputs = ["sales_lag_7", "sales_lag_28", "rolling_mean_7", "rolling_std_28", "store_daily_mean", "dept_daily_mean"]
    predict = lambda df: df.withColumn("forecast", sum((F.col(c) * (i + 1) for i, c in enumerate(inputs)), F.lit(0.0)) / 10)
    got = V.recursive_forecast(predict, series, retail_df, horizon=4).toPandas()
    history = retail_df.select("id", "date", "sales", "store_id", "dept_id")
    for step in range(1, 5):
        day = last + timedelta(days=step)
        want = predict(V.inference_features(series, history, day)).select("id", "date", "forecast", "store_id", "dept_id")
        own = got[got["date"] == day].sort_values("id")
        np.testing.assert_allclose(own["forecast"], want.orderBy("id").toPandas()["forecast"], rtol=1e-9)
        history = V.append_predictions(history, want)


def test_recursive_forecast_takes_flags_of_the_coming_days(spark, retail_df):
    last = retail_df.agg(F.max("date")).first()[0]
    series = P.build_hierarchy_map(retail_df).withColumns({"sell_price": F.lit(3.0), "snap": F.lit(0), "has_event": F.lit(0)})
    rows = [(last + timedelta(days=1), None, 1, 0), (last + timedelta(days=2), "Fair", 0, 1)]
    ahead = spark.createDataFrame(rows, "date date, event_name_1 string, flag_a int, flag_b int")
    states = sorted(r[0] for r in series.select("state_id").distinct().collect())
    flags = dict(zip(states, ["flag_a", "flag_b"]))
    predict = lambda df: df.withColumn("forecast", 10.0 * F.col("has_event") + F.col("snap"))
    got = V.recursive_forecast(predict, series, retail_df, 3, ahead, flags).toPandas()
    assert len(got) == 6 * 3
    for r in got.itertuples():
        n = (r.date - last).days
        snap = int({1: "flag_a", 2: "flag_b"}.get(n) == flags.get(r.state_id))
        assert r.forecast == (10 if n == 2 else 0) + snap


def test_rolling_windows_forget_a_spike(spark):
    """A spike outside the window leaves no trace in its mean and deviation."""
    sales = [1_000_000.3] + [0.1] * 120 + [0.1 * (i % 7) for i in range(120)]
    pdf = pd.DataFrame({"id": "A", "date": pd.date_range("2020-01-01", periods=len(sales)).date, "sales": sales})
    got = X.with_rolling(spark.createDataFrame(pdf), [7, 28], 28, ["id"]).orderBy("date").toPandas()
    for k in (7, 28):
        frames = [sales[max(0, i - 28 - k + 1) : max(0, i - 27)] for i in range(len(sales))]
        mean = [np.mean(f) if f else np.nan for f in frames]
        spread = [np.std(f, ddof=1) if len(f) > 1 else np.nan for f in frames]
        assert np.allclose(got[f"rolling_mean_{k}"].astype(float), mean, atol=1e-9, rtol=1e-12, equal_nan=True)
        assert np.allclose(got[f"rolling_std_{k}"].astype(float), spread, atol=1e-9, rtol=1e-9, equal_nan=True)
