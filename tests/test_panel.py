from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.operators import ordering as O
from shelfcast.operators import panel as P
from shelfcast.operators import reshape
from shelfcast.plans.forecast_run import preprocess
from shelfcast.sources import tables as T
from tests.conftest import days


def wide(spark):
    rows = [(f"i{i}_s{j}", f"i{i}", "dept", "cat", f"s{j}", "CA", i, j, i + j) for i in range(3) for j in range(2)]
    return spark.createDataFrame(
        rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 int, d_2 int, d_3 int"
    )


def test_melt_rows_and_values(spark):
    long = reshape.melt_sales(wide(spark))
    assert long.count() == 6 * 3
    got = {(r["id"], r["d"]): r["sales"] for r in long.collect()}
    assert got[("i2_s1", "d_1")] == 2 and got[("i2_s1", "d_2")] == 1 and got[("i2_s1", "d_3")] == 3
    assert "dept_id" in long.columns and dict(long.dtypes)["sales"] == "double"


def test_melt_undoes_widen(spark, retail_df):
    n = retail_df.select("date").distinct().count()
    back = reshape.melt_sales(reshape.widen_sales(retail_df, n))
    sums = {r["d"]: r["s"] for r in back.groupBy("d").agg(F.sum("sales").alias("s")).collect()}
    first = retail_df.agg(F.min("date")).first()[0]
    for r in retail_df.groupBy("date").agg(F.sum("sales").alias("s")).collect():
        assert sums[f"d_{(r['date'] - first).days + 1}"] == r["s"]


def test_densify_fills_every_day(spark):
    rows = [("a", date(2015, 1, 3), 2.0), ("a", date(2015, 1, 5), 1.0), ("b", date(2015, 1, 6), 4.0)]
    sparse = spark.createDataFrame(rows, "id string, date date, sales double")
    dense = P.densify(sparse, F.lit(date(2015, 1, 1)), F.lit(date(2015, 1, 7))).toPandas()
    assert len(dense) == 14 and not dense.duplicated(["id", "date"]).any()
    assert {(r.id, r.date.day): r.sales for r in dense.itertuples() if r.sales} == {
        ("a", 3): 2.0, ("a", 5): 1.0, ("b", 6): 4.0
    }


def price_rows(spark, rows):
    return spark.createDataFrame(rows, "item_id string, store_id string, sell_price double")


def test_price_fill_group_then_overall_then_one(spark):
    rows = [("a", "s", 1.0), ("a", "s", 4.0), ("a", "s", None), ("b", "s", 10.0), ("c", "s", None)]
    got = P.fill_prices(price_rows(spark, rows)).toPandas()
    frame = pd.DataFrame(rows, columns=["item_id", "store_id", "sell_price"])
    frame["sell_price"] = frame.groupby(["item_id", "store_id"])["sell_price"].transform(lambda x: x.fillna(x.median()))
    want = frame["sell_price"].fillna(frame["sell_price"].median())
    assert sorted(got["sell_price"]) == sorted(want)
    empty = P.fill_prices(price_rows(spark, [("a", "s", None)])).first()
    assert empty["sell_price"] == 1.0


def test_prices_without_shared_keys_are_one(spark):
    df = spark.createDataFrame([("x", 1)], "id string, n int")
    assert P.merge_prices(df, spark.createDataFrame([(1, 2.0)], "other int, sell_price double")).first()["sell_price"] == 1.0


def test_snap_flag_branches(spark):
    df = spark.createDataFrame([("CA", 1, 0), ("TX", 1, 0), ("NY", 1, 1)], "state_id string, snap_CA int, snap_TX int")
    assert {r["state_id"]: r["snap"] for r in P.add_snap_flag(df).collect()} == {"CA": 1, "TX": 0, "NY": 0}
    assert P.add_snap_flag(df.drop("state_id")).agg(F.max("snap")).first()[0] == 0


def test_label_codes_sorted_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "item_id string")
    encoders = O.fit_encoders(df, ["item_id"])
    assert {r["label"]: r["code"] for r in encoders.collect()} == {"a": 0, "b": 1, "c": 2}
    coded = O.encode_labels(df, encoders, ["item_id"])
    assert sorted(r[0] for r in coded.collect()) == [-1, 0, 0, 1, 2]
    back = O.decode_labels(coded, encoders, "item_id")
    assert sorted(r[0] for r in back.collect()) == ["-1", "a", "a", "b", "c"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_exact_median_and_running_total(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    assert O.exact_median(df, "v").first()[0] == np.median(values)
    numbered = df.distinct().withColumn("one", F.lit(1))
    placed = O.running_total(numbered, ["v"], "one", "place").orderBy("v").collect()
    assert [r["place"] for r in placed] == list(range(1, len(set(values)) + 1))


def test_split_and_ratio(spark, retail_df):
    train, val = P.train_val_split(retail_df)
    assert val.select("date").distinct().count() == 28
    assert train.agg(F.max("date")).first()[0] < val.agg(F.min("date")).first()[0]
    assert train.count() + val.count() == retail_df.count()
    early, late = P.ratio_split(retail_df, 0.85)
    assert early.count() + late.count() == retail_df.count()
    assert early.select("date").distinct().count() == int(119 * 0.85) + 1


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 2**40, 1.5, "x"), (-5, -7, 0, 2.5, "y")], "a bigint, b bigint, c bigint, d double, e string")
    assert dict(P.narrow_types(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float", "e": "string"}


def test_min_history(spark, retail_df):
    short = retail_df.filter((F.col("id") != "item_0_S0_1") | (F.col("date") < date(2015, 2, 1)))
    kept = {r[0] for r in P.with_min_history(short, "id", 60).select("id").distinct().collect()}
    assert len(kept) == 5 and "item_0_S0_1" not in kept


def test_csv_round_trip_and_preprocess(spark, tmp_path):
    cal = spark.createDataFrame(
        [(d, 201500 + d.isocalendar()[1], d.strftime("%A"), d.isoweekday(), d.month, d.year, f"d_{i + 1}", "New" if i == 0 else None, "National" if i == 0 else None, None, None, 1, 0, 0)
         for i, d in enumerate(days("2015-01-05", 3))], T.CALENDAR_SCHEMA)
    prices = spark.createDataFrame([("s0", "i0", 201502, 2.5), ("s1", "i1", 201502, 3.5)], T.PRICES_SCHEMA)
    T.write_dataset({"sales": wide(spark), "calendar": cal.select(*reversed(cal.columns)), "prices": prices}, str(tmp_path))
    read = T.read_dataset(spark, str(tmp_path))
    assert read["sales"].count() == 6 and read["calendar"].count() == 3
    done = preprocess(read["sales"], read["calendar"], read["prices"], val_days=1)
    assert done["full"].count() == 18 and done["val"].count() == 6 and done["hierarchy"].count() == 6
    got = done["full"].toPandas()
    assert got["sell_price"].notna().all() and set(got["event_name_1"]) == {-1, 0} and (got["snap"] == 1).all()
    with pytest.raises(ValueError):
        T.read_dataset(spark, str(tmp_path), "xml")


def test_write_by_store(spark, retail_df, tmp_path):
    path = str(tmp_path / "by_store")
    T.write_by_store(retail_df, path)
    one = T.read_by_store(spark, path, ["S0_1"])
    assert one.count() == retail_df.filter("store_id = 'S0_1'").count()
    assert T.read_by_store(spark, path).agg(F.sum("sales")).first() == retail_df.agg(F.sum("sales")).first()


def test_metric_matrix(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "store string, MAE double, RMSE double")
    got = {r["metric"]: (r["a"], r["b"]) for r in reshape.metric_matrix(df, "store", ["MAE", "RMSE"], ["a", "b"]).collect()}
    assert got == {"MAE": (1.0, 3.0), "RMSE": (2.0, 4.0)}
