"""Calendar and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.fixed_values import CALENDAR_COLUMNS, EVENTS, HOLIDAY_WINDOWS, SNAP_LAST_DAY
from shelfcast.functions import dates as D


def event_table(spark: SparkSession, events: list[tuple[str, str, str]] = EVENTS) -> DataFrame:
    """One event per day; a later entry replaces an earlier one of the same day."""
    rows = [(i, name, kind, day) for i, (name, kind, day) in enumerate(events)]
    listed = spark.createDataFrame(rows, "place int, name string, type string, day string")
    return one_event_per_day(listed.withColumn("date", F.to_date("day")), "place")


def one_event_per_day(events: DataFrame, place: str) -> DataFrame:
    last = F.max_by(F.struct("name", "type"), F.col(place)).alias("last")
    return events.groupBy("date").agg(last).select(
        "date",
        F.col("last.name").alias("event_name_1"),
        F.col("last.type").alias("event_type_1"),
    )


def holiday_table(spark: SparkSession, events: list[tuple[str, str, str]] = EVENTS) -> DataFrame:
    """Dated holidays with the days around them that count as holiday."""
    return holidays_of(event_table(spark, events))


def holidays_of(events: DataFrame) -> DataFrame:
    """Holiday table of the calendar's event days, with the fixed windows."""
    name = F.col("event_name_1")
    window = F.lit(None)
    for holiday, (lower, upper) in HOLIDAY_WINDOWS.items():
        span = F.struct(F.lit(lower).alias("lower_window"), F.lit(upper).alias("upper_window"))
        window = F.when(name == holiday, span).otherwise(window)
    found = events.withColumn("w", window).filter(F.col("w").isNotNull())
    return found.select(name.alias("holiday"), F.col("date").alias("ds"), "w.lower_window", "w.upper_window")


def days_between(bounds: DataFrame) -> DataFrame:
    """``bounds`` holds one row (first, last); the result one row per day."""
    return bounds.select(
        "first", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))


def build_calendar(bounds: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Calendar dimension, one row per day from first to last.

    ``events`` has one row per day at most, so it never outgrows the days
    and is broadcast.
    """
    day = F.col("date")
    days = days_between(bounds)
    if events is None:
        events = event_table(bounds.sparkSession)
    out = days.join(F.broadcast(events), "date", "left").withColumns(
        {
            "wm_yr_wk": D.iso_week_key(day),
            "weekday": D.weekday_name(day),
            "wday": D.day_of_week(day) + 1,
            "month": F.month(day),
            "year": F.year(day),
            "d": D.day_label(day, F.col("first")),
            "event_name_2": F.lit(None).cast("string"),
            "event_type_2": F.lit(None).cast("string"),
            **{c: D.flag(F.dayofmonth(day) <= n) for c, n in SNAP_LAST_DAY.items()},
        }
    )
    return out.select(*CALENDAR_COLUMNS)
