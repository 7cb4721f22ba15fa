"""Lag, rolling, price, calendar, event and context features of the panel.

Every window is partitioned by the series and ordered by the date, so one
shuffle and one sort serve all of them. A series has one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.fixed_values import LAGS, PRICE_LAGS, ROLLING_LAG, WINDOWS
from shelfcast.functions import dates as D
from shelfcast.functions.scalars import has_event
from shelfcast.operators.panel import drop_missing_lags
from shelfcast.session import broadcast_if_small, cut_lineage

EPOCH = "1970-01-01"


def by_series(group_cols: list[str]) -> WindowSpec:
    return Window.partitionBy(*group_cols).orderBy("date")


def by_series_days(group_cols: list[str]) -> WindowSpec:
    """Window over calendar distance: frames count days, not rows."""
    return Window.partitionBy(*group_cols).orderBy(F.datediff("date", F.lit(EPOCH)))


def add_calendar_features(df: DataFrame) -> DataFrame:
    df = df.withColumn("date", F.to_date("date"))
    return df.withColumns(D.calendar_features(F.col("date")))


def add_event_features(df: DataFrame) -> DataFrame:
    encoded = dict(df.dtypes)["event_name_1"] != "string"
    return df.withColumn("has_event", has_event(F.col("event_name_1"), encoded))


def lag_columns(lag_days: list[int], w: WindowSpec) -> dict[str, Column]:
    return {f"sales_lag_{n}": F.lag("sales", n).over(w) for n in lag_days}


def with_rolling(df: DataFrame, windows: list[int], lag: int, group_cols: list[str]) -> DataFrame:
    """Mean and deviation over the ``k`` rows that end ``lag`` rows back.

    Each window has a bounded frame of its own, so a value outside of it leaves no
    trace: differences of running sums would keep the rounding of a spike for good.
    All frames share one shuffle and one sort.
    """
    w = by_series(group_cols)
    out = {}
    for k in windows:
        frame = w.rowsBetween(-(lag + k - 1), -lag)
        out[f"rolling_mean_{k}"] = F.avg("sales").over(frame)
        out[f"rolling_std_{k}"] = F.stddev_samp("sales").over(frame)
    return df.withColumns(out)


def add_lag_features(df: DataFrame, lag_days: list[int] = LAGS, group_cols: list[str] = ["id"]) -> DataFrame:
    """Sales ``n`` rows earlier in the series; null at its start."""
    return df.withColumns(lag_columns(lag_days, by_series(group_cols)))


def add_rolling_features(
    df: DataFrame,
    windows: list[int] = WINDOWS,
    lag: int = ROLLING_LAG,
    group_cols: list[str] = ["id"],
) -> DataFrame:
    return with_rolling(df, windows, lag, group_cols)


def add_calendar_lags(df: DataFrame, lag_days: list[int] = LAGS, group_cols: list[str] = ["id"]) -> DataFrame:
    """Sales exactly ``n`` calendar days earlier, 0 when that day is missing."""
    w = by_series_days(group_cols)
    return df.withColumns(
        {
            f"sales_lag_{n}": F.coalesce(F.max("sales").over(w.rangeBetween(-n, -n)), F.lit(0.0))
            for n in lag_days
        }
    )


def add_calendar_rolling(
    df: DataFrame,
    windows: list[int] = WINDOWS,
    lag: int = ROLLING_LAG,
    group_cols: list[str] = ["id"],
) -> DataFrame:
    """Mean and deviation over the ``k`` days that end ``lag`` days back; 0 when empty."""
    w = by_series_days(group_cols)
    out = {}
    for k in windows:
        frame = w.rangeBetween(-(lag + k - 1), -lag)
        out[f"rolling_mean_{k}"] = F.coalesce(F.avg("sales").over(frame), F.lit(0.0))
        out[f"rolling_std_{k}"] = F.coalesce(F.stddev_samp("sales").over(frame), F.lit(0.0))
    return df.withColumns(out)


def add_price_features(
    df: DataFrame,
    group_cols: list[str] = ["item_id", "store_id"],
    as_of: Column | None = None,
) -> DataFrame:
    """Rolling price, price change, relative price and discount depth.

    Mean and highest price cover the whole series. With ``as_of`` the rows
    before that day use the days before it only.
    """
    price = F.col("sell_price")
    w = by_series(group_cols)
    whole = Window.partitionBy(*group_cols)

    def over_series(aggregate) -> Column:
        full = aggregate(price).over(whole)
        if as_of is None:
            return full
        known = aggregate(F.when(F.col("date") < as_of, price)).over(whole)
        return F.when(F.col("date") < as_of, known).otherwise(full)

    df = df.withColumns(
        {
            "price_roll_mean_28": F.avg(price).over(w.rowsBetween(-27, 0)),
            "price_change": F.coalesce(price - F.lag(price, 1).over(w), F.lit(0.0)),
            "_price_mean": over_series(F.avg),
            "price_max": over_series(F.max),
        }
    )
    top = F.col("price_max")
    return df.withColumns(
        {
            "price_relative": price / F.nullif(F.col("_price_mean"), F.lit(0.0)),
            "price_discount": (top - price) / F.greatest(top, F.lit(0.01)),
        }
    ).drop("_price_mean")


def add_price_lags(
    df: DataFrame, lag_days: list[int] = PRICE_LAGS, group_cols: list[str] = ["item_id", "store_id"]
) -> DataFrame:
    w = by_series(group_cols)
    return df.withColumns({f"price_lag_{n}": F.lag("sell_price", n).over(w) for n in lag_days})


def add_context_features(df: DataFrame, lag_days: int = 0) -> DataFrame:
    """Mean sales of the row's store and of its department on the day.

    With ``lag_days`` 0 the mean includes the row's own sales; 28 keeps the
    horizon out of it: a day then sees the means of 28 days before. One
    grouping by store, department and day serves both. The means are written
    once and counted: only a small table is broadcast.
    """
    sums = cut_lineage(
        df.groupBy("store_id", "dept_id", "date").agg(F.sum("sales").alias("_sum"), F.count("sales").alias("_n"))
    )
    for key, name in (("store_id", "store_daily_mean"), ("dept_id", "dept_daily_mean")):
        mean = (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias(name)
        means = sums.groupBy(key, F.date_add("date", lag_days).alias("date")).agg(mean)
        df = df.join(broadcast_if_small(means, means.count()), [key, "date"], "left")
    return df


def build_features(
    df: DataFrame,
    training: bool = True,
    as_of: Column | None = None,
    context_lag: int = 0,
) -> DataFrame:
    """All model inputs of the panel.

    ``id`` stands for item and store in the price windows too, so that every
    window shares one partitioning.
    """
    df = add_context_features(add_event_features(add_calendar_features(df)), context_lag)
    df = add_rolling_features(add_lag_features(df))
    df = add_price_features(df, ["id"], as_of)
    return drop_missing_lags(df) if training else df


def split_features(
    full: DataFrame, val_start: Column, context_lag: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Training and validation features from one pass over the whole panel.

    The features are written once and split from there. Lags of validation
    rows reach back into the training days; training rows see no price after
    the split.
    """
    features = build_features(full, training=False, as_of=val_start, context_lag=context_lag)
    features = cut_lineage(features.withColumn("_train", F.col("date") < val_start))
    train = drop_missing_lags(features.filter("_train")).drop("_train")
    return train, features.filter("NOT _train").drop("_train")
