"""Row profiles and shared SQL pieces.

Panel-grain operators run over every series and day. Their result is compared
as counts and means by store and day, so that a query returns thousands of rows
and not millions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog.retail import r6

# Keeps means of short decimals off the rounding edge, where engines may differ.
OFF_EDGE = 1.1e-8
STORE_DAY = ["store_id", "date"]


def profile(df: DataFrame, columns: list[str], keys: list[str] = STORE_DAY) -> DataFrame:
    """Rows, non-null counts and means of the columns by key."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [F.count(c).alias(f"n_{c}"), r6(F.avg(F.col(c).cast("double")) + OFF_EDGE).alias(f"avg_{c}")]
    return df.groupBy(*keys).agg(*aggs)


def profile_sql(source: str, columns: list[str], keys: list[str] = STORE_DAY) -> str:
    parts = [*keys, "count(*) AS n_rows"]
    for c in columns:
        parts += [f"count({c}) AS n_{c}", f"round(avg(CAST({c} AS DOUBLE)) + {OFF_EDGE}, 6) + 0.0 AS avg_{c}"]
    return f"SELECT {', '.join(parts)} FROM {source} GROUP BY {', '.join(keys)}"


SPLIT_SQL = """
cut AS (SELECT max(date) - 27 AS start FROM panel),
train AS (SELECT * FROM panel WHERE date < (SELECT start FROM cut)),
val AS (SELECT * FROM panel WHERE date >= (SELECT start FROM cut))"""

NAIVE_SQL = (
    SPLIT_SQL
    + """,
level7 AS (
  SELECT id, avg(sales) AS level
  FROM (SELECT id, sales, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS rn FROM train)
  WHERE rn <= 7 GROUP BY id
),
naive AS (SELECT v.id, v.date, coalesce(l.level, 0.0) AS forecast FROM val v LEFT JOIN level7 l USING (id)),
pairs AS (SELECT v.*, n.forecast FROM val v JOIN naive n USING (id, date))"""
)

ERRORS_SQL = """count(*) AS n_rows,
  round(avg(abs(sales - forecast)), 6) + 0.0 AS MAE,
  round(sqrt(avg(pow(sales - forecast, 2))), 6) + 0.0 AS RMSE,
  round(100 * avg(abs(sales - forecast) / greatest(abs(sales), 1.0)), 6) + 0.0 AS MAPE,
  round(100 * avg(abs(sales - forecast) / ((abs(sales) + abs(forecast)) / 2 + 1e-10)), 6) + 0.0 AS SMAPE"""


def calendar_feature_sql(day: str = "date") -> dict[str, str]:
    """DuckDB text of the calendar inputs, by name."""
    integer = lambda e: f"CAST({e} AS INTEGER)"
    return {
        "day_of_week": integer(f"isodow({day}) - 1"),
        "day_of_month": integer(f"day({day})"),
        "day_of_year": integer(f"dayofyear({day})"),
        "week_of_year": integer(f"week({day})"),
        "month": integer(f"month({day})"),
        "quarter": integer(f"quarter({day})"),
        "year": integer(f"year({day})"),
        "is_weekend": integer(f"isodow({day}) >= 6"),
        "is_month_start": integer(f"day({day}) = 1"),
        "is_month_end": integer(f"{day} = last_day({day})"),
        "is_quarter_start": integer(f"{day} = date_trunc('quarter', {day})"),
        "is_quarter_end": integer(
            f"{day} = CAST(date_trunc('quarter', {day}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
        ),
        "sin_day_year": f"sin(2 * pi() * dayofyear({day}) / 365.25)",
        "cos_day_year": f"cos(2 * pi() * dayofyear({day}) / 365.25)",
        "sin_day_week": f"sin(2 * pi() * (isodow({day}) - 1) / 7)",
        "cos_day_week": f"cos(2 * pi() * (isodow({day}) - 1) / 7)",
    }


def lag_sql(lags: list[int], window: str = "w") -> list[str]:
    return [f"lag(sales, {n}) OVER {window} AS sales_lag_{n}" for n in lags]


def rolling_sql(windows: list[int], lag: int = 28, window: str = "w") -> list[str]:
    out = []
    for k in windows:
        frame = f"({window} ROWS BETWEEN {lag + k - 1} PRECEDING AND {lag} PRECEDING)"
        out += [
            f"avg(sales) OVER {frame} AS rolling_mean_{k}",
            f"stddev_samp(sales) OVER {frame} AS rolling_std_{k}",
        ]
    return out
