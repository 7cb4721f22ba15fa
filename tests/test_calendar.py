from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from shelfcast.functions import dates as D
from shelfcast.operators import events as E
from shelfcast.operators import features as X
from shelfcast.sources import calendar as C


def full_span(spark):
    return spark.createDataFrame([(date(2011, 1, 29), date(2016, 6, 19))], "first date, last date")


def test_calendar_rows_and_events(spark):
    cal = C.build_calendar(full_span(spark)).toPandas().sort_values("date")
    assert len(cal) == 1969
    assert cal["event_name_1"].notna().sum() == 39
    assert cal["event_name_2"].isna().all() and cal["event_type_2"].isna().all()
    for c in ("snap_CA", "snap_TX", "snap_WI"):
        assert set(cal[c]) == {0, 1}
    assert cal["d"].tolist() == [f"d_{i}" for i in range(1, 1970)]
    stamps = pd.to_datetime(cal["date"])
    assert cal["wm_yr_wk"].tolist() == [int(s.strftime("%G%V")) for s in stamps]
    assert cal["weekday"].tolist() == stamps.dt.day_name().tolist()
    assert cal["wday"].tolist() == (stamps.dt.dayofweek + 1).tolist()


def test_later_event_of_a_day_wins(spark):
    table = C.event_table(spark, [("A", "x", "2015-01-01"), ("B", "y", "2015-01-01")]).collect()
    assert [(r.event_name_1, r.event_type_1) for r in table] == [("B", "y")]


def test_calendar_features_match_pandas(spark):
    cal = C.days_between(full_span(spark)).select("date")
    got = X.add_calendar_features(cal).toPandas().sort_values("date").reset_index(drop=True)
    stamps = pd.to_datetime(got["date"])
    want = {
        "day_of_week": stamps.dt.dayofweek,
        "day_of_year": stamps.dt.dayofyear,
        "week_of_year": stamps.dt.isocalendar().week,
        "quarter": stamps.dt.quarter,
        "is_month_end": stamps.dt.is_month_end,
        "is_quarter_start": stamps.dt.is_quarter_start,
        "is_quarter_end": stamps.dt.is_quarter_end,
    }
    for name, values in want.items():
        assert (got[name].astype(int) == values.astype(int)).all(), name
    for name in ("sin_day_year", "cos_day_year", "sin_day_week", "cos_day_week"):
        assert got[name].between(-1, 1).all()


def test_holiday_windows(spark):
    held = E.holiday_days(C.holiday_table(spark)).toPandas()
    assert held.groupby("holiday").size().to_dict() == {"Christmas": 40, "SuperBowl": 18, "Thanksgiving": 15}
    assert (held["day_offset"] == [(a - b).days for a, b in zip(held["date"], held["ds"])]).all()


def test_event_windows_weigh_by_distance(spark):
    events = spark.createDataFrame([(date(2015, 3, 10), "A"), (date(2015, 3, 12), "B")], "date date, event_name_1 string")
    days = C.days_between(spark.createDataFrame([(date(2015, 3, 7), date(2015, 3, 15))], "first date, last date"))
    near = {(r["date"].day, r["event_name_1"]): r["event_weight"] for r in E.join_event_windows(days, events).collect()}
    assert len(near) == 10 and abs(near[(8, "A")] - 0.6) < 1e-12 and near[(12, "B")] == 1.0
    best = {r["date"].day: r["event_name_1"] for r in E.strongest_event(days.select("date"), events).collect()}
    assert best[11] == "A" and best[12] == "B" and best[7] is None


def test_iso_week_key_at_year_edge(spark):
    row = spark.range(1).select(D.iso_week_key(F.lit(date(2012, 1, 1))).alias("k")).first()
    assert row["k"] == 201152
