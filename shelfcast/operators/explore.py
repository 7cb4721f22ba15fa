"""Exploratory summaries of the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.fixed_values import WEEKDAYS
from shelfcast.functions import dates as D


def total_by(df: DataFrame, keys: list[str], value: str = "sales") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(value))


def dataset_summary(panel: DataFrame) -> DataFrame:
    """One row: items, stores, series, days and rows.

    Series are counted after one grouping by series, so no distinct set is
    built over the full panel.
    """
    days = panel.select("date").distinct().agg(F.count("*").alias("n_days"))
    series = panel.groupBy("id", "item_id", "store_id").agg(F.count("*").alias("n"))
    return series.agg(
        F.count_distinct("item_id").alias("n_items"),
        F.count_distinct("store_id").alias("n_stores"),
        F.count("*").alias("n_series"),
        days.scalar().alias("n_days"),
        F.sum("n").alias("n_rows"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def is_zero(sales: Column) -> Column:
    return F.when(sales == 0, 1.0).otherwise(0.0)


def zero_rate(df: DataFrame, keys: list[str] = []) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(is_zero(F.col("sales"))).alias("zero_rate"))


def mean_daily_sales(df: DataFrame, key: str = "cat_id") -> DataFrame:
    """Mean over the series of each day, then over the days."""
    daily = df.groupBy(key, "date").agg(F.avg("sales").alias("daily_mean"))
    return daily.groupBy(key).agg(F.avg("daily_mean").alias("mean_sales"))


def weekday_profile(df: DataFrame) -> DataFrame:
    """Mean daily total by weekday, Monday first; a weekday without days is null."""
    daily = total_by(df, ["date"]).withColumn("weekday", D.weekday_name(F.col("date")))
    means = daily.groupBy("weekday").agg(F.avg("sales").alias("mean_sales"))
    place = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("weekday")).cast("int")
    return means.withColumn("place", place).orderBy("place")


def month_profile(df: DataFrame) -> DataFrame:
    daily = total_by(df, ["date"])
    return daily.groupBy(F.month("date").alias("month")).agg(F.avg("sales").alias("mean_sales"))


def event_uplift(df: DataFrame) -> DataFrame:
    """Mean daily total on each event's days against the mean of all days, in percent."""
    baseline = total_by(df, ["date"]).agg(F.avg("sales")).scalar()
    on_event = total_by(df.filter(F.col("event_name_1").isNotNull()), ["date", "event_name_1"])
    means = on_event.groupBy("event_name_1").agg(F.avg("sales").alias("mean_sales"))
    uplift = (F.col("mean_sales") / F.nullif(baseline, F.lit(0.0)) - 1) * 100
    return means.withColumn("uplift_pct", uplift).orderBy(F.desc("mean_sales"), "event_name_1")


def first_entities(df: DataFrame, column: str, k: int) -> DataFrame:
    """The first ``k`` values in sorted order, for a chart."""
    return df.select(column).distinct().orderBy(column).limit(k)


def series_tail(df: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` rows by date."""
    return df.orderBy(F.desc("date")).limit(n)


def sort_panel(df: DataFrame, keys: list[str] = ["id"]) -> DataFrame:
    """Series side by side in partitions, each in date order; no global sort."""
    return df.repartition(*keys).sortWithinPartitions(*keys, "date")
