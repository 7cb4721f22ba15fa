"""Date expressions: calendar attributes, week keys and Fourier terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_LENGTH = 365.25
WEEK_LENGTH = 7


def flag(condition: Column) -> Column:
    return condition.cast("int")


def day_of_week(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day)


def iso_week_key(day: Column) -> Column:
    """ISO year times 100 plus ISO week."""
    return F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_quarter_start(day: Column) -> Column:
    return day == F.trunc(day, "quarter")


def is_quarter_end(day: Column) -> Column:
    return day == F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def day_label(day: Column, first: Column) -> Column:
    """``d_1`` for the first day, ``d_2`` for the next."""
    return F.concat(F.lit("d_"), (F.datediff(day, first) + 1).cast("string"))


def fourier(position: Column, period: float, order: int = 1) -> list[Column]:
    """sin and cos of each harmonic up to ``order``, sin first."""
    terms = []
    for k in range(1, order + 1):
        angle = F.lit(2.0) * F.pi() * k * position / F.lit(float(period))
        terms += [F.sin(angle), F.cos(angle)]
    return terms


def calendar_features(day: Column) -> dict[str, Column]:
    """The sixteen calendar inputs of the global model, by name."""
    year_sin, year_cos = fourier(F.dayofyear(day), YEAR_LENGTH)
    week_sin, week_cos = fourier(day_of_week(day), WEEK_LENGTH)
    return {
        "day_of_week": day_of_week(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": flag(day_of_week(day) >= 5),
        "is_month_start": flag(F.dayofmonth(day) == 1),
        "is_month_end": flag(day == F.last_day(day)),
        "is_quarter_start": flag(is_quarter_start(day)),
        "is_quarter_end": flag(is_quarter_end(day)),
        "sin_day_year": year_sin,
        "cos_day_year": year_cos,
        "sin_day_week": week_sin,
        "cos_day_week": week_cos,
    }
