"""Step-by-step forecast: features of the next day from the days so far."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shelfcast.fixed_values import HORIZON, ID_COLUMNS, LAGS, ROLLING_LAG, SNAP_STATES, WINDOWS
from shelfcast.functions import dates as D
from shelfcast.functions.scalars import has_event
from shelfcast.operators.panel import add_snap_flag, last_day
from shelfcast.session import broadcast_if_small, cut_lineage

RECENT_DAYS = 7
REACH = ROLLING_LAG + max(WINDOWS)


def append_predictions(history: DataFrame, predictions: DataFrame) -> DataFrame:
    """History with predicted sales below it, by column name."""
    return history.unionByName(
        predictions.withColumnRenamed("forecast", "sales"), allowMissingColumns=True
    )


def recent_mean(history: DataFrame, key: str, name: str, days: int = RECENT_DAYS) -> DataFrame:
    """Mean sales by key over the last day and the ``days`` before it."""
    recent = history.filter(F.col("date") >= F.date_sub(last_day(history), days))
    return recent.groupBy(key).agg(F.avg("sales").alias(name))


def join_recent_context(frame: DataFrame, history: DataFrame) -> DataFrame:
    """Recent mean of the row's store and department, 0 when unknown."""
    for key, name in (("store_id", "store_daily_mean"), ("dept_id", "dept_daily_mean")):
        means = recent_mean(history, key, name)
        frame = frame.join(means, key, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return frame


def history_features(history: DataFrame, day: date) -> DataFrame:
    """Lags and rolling statistics of every series for one day, in one aggregate.

    Lags and windows go by calendar distance; what is missing counts 0.
    """
    ago = F.datediff(F.lit(day), F.col("date"))
    sales = F.col("sales")
    aggs = [F.coalesce(F.max(F.when(ago == n, sales)), F.lit(0.0)).alias(f"sales_lag_{n}") for n in LAGS]
    for k in WINDOWS:
        inside = F.when((ago >= ROLLING_LAG) & (ago < ROLLING_LAG + k), sales)
        aggs.append(F.coalesce(F.avg(inside), F.lit(0.0)).alias(f"rolling_mean_{k}"))
        aggs.append(F.coalesce(F.stddev_samp(inside), F.lit(0.0)).alias(f"rolling_std_{k}"))
    return history.filter(ago.between(1, REACH)).groupBy("id").agg(*aggs)


def with_day_inputs(frame: DataFrame, day: date) -> DataFrame:
    """Calendar inputs of the day, the event flag if it is not there yet, and inputs of an unchanged price."""
    inputs = D.calendar_features(F.lit(day)) | {"date": F.lit(day)}
    if "has_event" not in frame.columns:
        name = F.col("event_name_1") if "event_name_1" in frame.columns else F.lit(None)
        inputs["has_event"] = has_event(name)
    inputs["price_roll_mean_28"] = F.col("sell_price")
    inputs |= {"price_change": F.lit(0.0), "price_relative": F.lit(1.0), "price_discount": F.lit(0.0)}
    return frame.withColumns(inputs)


def inference_features(series: DataFrame, history: DataFrame, day: date) -> DataFrame:
    """Model inputs of one future day for every series.

    ``series`` has one row per id with its keys, price and flags. The price is
    taken as unchanged.
    """
    frame = with_day_inputs(series, day)
    frame = frame.join(history_features(history, day), "id", "left").fillna(
        0.0, [f"sales_lag_{n}" for n in LAGS] + [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]
    )
    return join_recent_context(frame, history)


def series_state(series: DataFrame, history: DataFrame, last: date) -> DataFrame:
    """Every series with its sales of the last ``REACH`` days, oldest first; days without a row are null."""
    ago = F.datediff(F.lit(last), F.col("date")) + 1
    days = [F.max(F.when(ago == n, F.col("sales").cast("double"))) for n in range(REACH, 0, -1)]
    held = history.filter(ago.between(1, REACH)).groupBy("id").agg(F.array(*days).alias("recent"))
    nothing = F.array_repeat(F.lit(None).cast("double"), REACH)
    return series.join(held, "id", "left").withColumn("recent", F.coalesce("recent", nothing))


def state_features() -> dict[str, Column]:
    """The lags and rolling statistics of ``history_features`` for the day behind ``recent``."""
    known = lambda first, n: F.filter(F.slice("recent", first, n), lambda v: v.isNotNull())
    total = lambda own, f: F.aggregate(own, F.lit(0.0), lambda acc, v: acc + f(v))
    out = {f"sales_lag_{n}": F.coalesce(F.element_at("recent", -n), F.lit(0.0)) for n in LAGS}
    for k in WINDOWS:
        own = known(REACH + 2 - ROLLING_LAG - k, k)
        mean = total(own, lambda v: v) / F.size(own)
        out[f"rolling_mean_{k}"] = F.when(F.size(own) > 0, mean).otherwise(0.0)
        spread = F.sqrt(total(own, lambda v: F.pow(v - mean, F.lit(2))) / (F.size(own) - 1))
        out[f"rolling_std_{k}"] = F.when(F.size(own) > 1, spread).otherwise(0.0)
    return out


def join_state_context(state: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Mean of the row's store and department over the last day and the ``RECENT_DAYS`` before it, 0 when unknown."""
    own = F.filter(F.slice("recent", REACH - RECENT_DAYS, RECENT_DAYS + 1), lambda v: v.isNotNull())
    total = F.sum(F.aggregate(own, F.lit(0.0), lambda acc, v: acc + v))
    n = F.sum(F.size(own))
    frame = state
    for key, name in (("store_id", "store_daily_mean"), ("dept_id", "dept_daily_mean")):
        means = state.groupBy(key).agg(F.when(n > 0, total / F.nullif(n, F.lit(0))).otherwise(0.0).alias(name))
        frame = frame.join(broadcast_if_small(means, sizes[key]), key, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return frame


def with_day_flags(series: DataFrame, day: Row, states: dict[str, str], state_col: str) -> DataFrame:
    """``has_event`` and ``snap`` of one calendar row for every series."""
    flags = {c: F.lit(day[c]) for c in set(states.values()) if c in day}
    marked = series.withColumns({"has_event": has_event(F.lit(day["event_name_1"])), **flags})
    return add_snap_flag(marked, states, state_col).drop(*flags)


def recursive_forecast(
    predict: Callable[[DataFrame], DataFrame],
    series: DataFrame,
    history: DataFrame,
    horizon: int = HORIZON,
    calendar: DataFrame | None = None,
    states: dict[str, str] = SNAP_STATES,
    state_col: str = "state_id",
) -> DataFrame:
    """One predicted row per series and future day; later days see earlier predictions.

    ``calendar`` gives the events and benefit flags of the coming days, by the state named
    in ``state_col``; on days that it lacks, the flags of ``series`` hold.
    The state is one row a series with its last ``REACH`` days. A day reads the stored state, and writes it
    with the prediction behind it, so every day costs the same and the history is read once.
    """
    last = history.agg(F.max("date")).first()[0]
    state = cut_lineage(series_state(series, history, last))
    sizes = {c: state.agg(F.count_distinct(c)).first()[0] for c in ("store_id", "dept_id")}
    carried = state.columns
    flags = [c for c in ("has_event", "snap") if c in carried]
    ahead = {}
    if calendar is not None:
        within = F.col("date").between(F.lit(last + timedelta(days=1)), F.lit(last + timedelta(days=horizon)))
        ahead = {r["date"]: r for r in calendar.filter(within).collect()}
    results = None
    for step in range(1, horizon + 1):
        day = last + timedelta(days=step)
        frame = join_state_context(state, sizes).withColumns(state_features() | {f"_own_{c}": F.col(c) for c in flags})
        frame = with_day_flags(frame, ahead[day], states, state_col) if day in ahead else frame
        predicted = predict(with_day_inputs(frame, day))
        following = F.concat(F.slice("recent", 2, REACH - 1), F.array(F.col("forecast").cast("double")))
        # A day's flags are not those of the next one.
        kept = [F.col(f"_own_{c}").alias(c) if c in flags else F.col(c) for c in carried if c != "recent"]
        state = cut_lineage(predicted.select(*kept, F.lit(day).alias("date"), "forecast", following.alias("recent")))
        done = state.select(*ID_COLUMNS, "date", "forecast")
        state = state.drop("date", "forecast")
        results = done if results is None else results.unionByName(done)
    return results
