"""Evaluation of the naive forecast over several cut-off days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.fixed_values import HORIZON
from shelfcast.functions.errors import report_columns
from shelfcast.operators.panel import last_day


def rolling_origin_report(panel: DataFrame, folds: int = 5, horizon: int = HORIZON, recent: int = 7) -> DataFrame:
    """Errors of the naive forecast per fold, with cut-offs one horizon apart.

    A day belongs to the horizon of one fold and to the last week of at most
    one, so each row finds its folds by arithmetic and nothing is repeated.
    """
    back = F.datediff(last_day(panel), F.col("date"))
    dated = panel.select("id", "date", "sales", back.alias("_back"))
    tested = dated.filter(F.col("_back") < folds * horizon).withColumn(
        "fold", (F.floor(F.col("_back") / horizon) + 1).cast("int")
    )
    known = dated.filter(
        F.col("_back").between(horizon, folds * horizon + recent - 1) & (F.col("_back") % horizon < recent)
    ).withColumn("fold", F.floor(F.col("_back") / horizon).cast("int"))
    levels = known.groupBy("id", "fold").agg(F.avg("sales").alias("forecast"))
    pairs = tested.join(levels, ["id", "fold"])
    return pairs.groupBy("fold").agg(*report_columns(F.col("sales"), F.col("forecast")))
