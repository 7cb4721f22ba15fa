"""Days around events and holidays, as equi-joins on expanded dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_windows(events: DataFrame, reach: int = 2, decay: float = 0.2) -> DataFrame:
    """Days within ``reach`` of an event, weighted ``1 - decay * |offset|``."""
    days = F.explode(F.sequence(F.date_sub("date", reach), F.date_add("date", reach)))
    return (
        events.select("event_name_1", F.col("date").alias("event_date"), days.alias("date"))
        .withColumn("event_offset", F.datediff("date", "event_date"))
        .withColumn("event_weight", 1 - F.lit(decay) * F.abs("event_offset"))
    )


def join_event_windows(df: DataFrame, events: DataFrame, reach: int = 2, decay: float = 0.2) -> DataFrame:
    """Rows with each event they are near to; a day near two events gives two rows.

    The expanded events hold a handful of rows per event day and are broadcast.
    """
    return df.join(F.broadcast(event_windows(events, reach, decay)), "date")


def strongest_event(df: DataFrame, events: DataFrame, reach: int = 2, decay: float = 0.2) -> DataFrame:
    """Left join to the nearest event of the day; ties go to the first name."""
    near = event_windows(events, reach, decay)
    ranked = F.struct((-F.col("event_weight")).alias("w"), "event_name_1", "event_offset", "event_weight")
    best = near.groupBy("date").agg(F.min(ranked).alias("e"))
    best = best.select("date", "e.event_name_1", "e.event_offset", "e.event_weight")
    return df.join(F.broadcast(best), "date", "left")


def holiday_days(holidays: DataFrame) -> DataFrame:
    """One row per day of each holiday's window, with its distance from the holiday."""
    span = F.sequence(
        F.expr("date_add(ds, lower_window)"), F.expr("date_add(ds, upper_window)"), F.expr("interval 1 day")
    )
    return holidays.select("holiday", "ds", F.explode(span).alias("date")).withColumn(
        "day_offset", F.datediff("date", "ds")
    )
