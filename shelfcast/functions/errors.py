"""Forecast error aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAPE_FLOOR = 1.0
SMAPE_OFFSET = 1e-10


def mae(actual: Column, forecast: Column) -> Column:
    return F.avg(F.abs(actual - forecast))


def rmse(actual: Column, forecast: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - forecast, F.lit(2))))


def mape(actual: Column, forecast: Column) -> Column:
    """Percentage error with small actuals counted as one unit."""
    return 100 * F.avg(F.abs(actual - forecast) / F.greatest(F.abs(actual), F.lit(MAPE_FLOOR)))


def smape(actual: Column, forecast: Column) -> Column:
    middle = (F.abs(actual) + F.abs(forecast)) / 2 + F.lit(SMAPE_OFFSET)
    return 100 * F.avg(F.abs(actual - forecast) / middle)


def report_columns(actual: Column, forecast: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        mae(actual, forecast).alias("MAE"),
        rmse(actual, forecast).alias("RMSE"),
        mape(actual, forecast).alias("MAPE"),
        smape(actual, forecast).alias("SMAPE"),
    ]
