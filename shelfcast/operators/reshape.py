"""Wide to long and entity by metric reshapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.fixed_values import ID_COLUMNS
from shelfcast.session import cut_lineage


def day_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("d_")]


def melt_sales(sales: DataFrame) -> DataFrame:
    """Long sales, one row per series and day column.

    The day columns become one array that is exploded by position; a row is
    never copied with all its columns.
    """
    ids = [c for c in ID_COLUMNS if c in sales.columns]
    days = day_columns(sales)
    labels = F.split(F.lit(",".join(days)), ",")
    packed = sales.select(*ids, F.array(*days).cast("array<double>").alias("_days"))
    exploded = packed.select(*ids, F.posexplode("_days").alias("_at", "sales"))
    return exploded.select(*ids, F.get(labels, F.col("_at")).alias("d"), "sales")


def widen_sales(panel: DataFrame, n_days: int) -> DataFrame:
    """Dense panel to one row per series with a column ``d_i`` per day.

    A series' days are packed into one array, as long as the calendar, and
    written once; thousands of pivot columns would each scan the group.
    """
    ids = [c for c in ID_COLUMNS if c in panel.columns]
    days = F.array_sort(F.collect_list(F.struct("date", "sales")))
    packed = cut_lineage(panel.groupBy(*ids).agg(days.alias("_days")).select(*ids, F.col("_days.sales").alias("_days")))
    return packed.selectExpr(*ids, *[f"_days[{i}] AS d_{i + 1}" for i in range(n_days)])


def metric_matrix(df: DataFrame, entity: str, metrics: list[str], values: list[str]) -> DataFrame:
    """One row per metric, one column per entity in ``values``."""
    long = df.select(entity, *[F.col(m).cast("double") for m in metrics]).unpivot(
        [entity], metrics, "metric", "value"
    )
    return long.groupBy("metric").pivot(entity, values).agg(F.first("value"))
