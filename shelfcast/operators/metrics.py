"""Forecast evaluation: reports, scaled errors, weights and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.fixed_values import HORIZON, ID_COLUMNS, SCORED_LEVELS
from shelfcast.functions.errors import report_columns
from shelfcast.functions.scalars import percent_change
from shelfcast.operators.hierarchy import roll_up, with_hierarchy

SCALE_FLOOR = 1e-10
METRICS = ["MAE", "RMSE", "MAPE", "SMAPE"]


def pair_forecasts(actuals: DataFrame, forecasts: DataFrame, keys: list[str] = ["id", "date"]) -> DataFrame:
    """Actual and forecast of the same key; other columns come from the actuals."""
    return actuals.join(forecasts.select(*keys, "forecast"), keys)


def evaluate_forecasts(actuals: DataFrame, forecasts: DataFrame, level_col: str | None = None) -> DataFrame:
    """Error report over all rows, or one row per value of ``level_col``."""
    pairs = pair_forecasts(actuals, forecasts)
    columns = report_columns(F.col("sales"), F.col("forecast"))
    if level_col and level_col in pairs.columns:
        grouped = pairs.filter(F.col(level_col).isNotNull()).groupBy(level_col).agg(*columns)
        group = F.col(level_col).cast("string")
        return grouped.select(group.alias("group"), F.lit(level_col).alias("level"), "n_rows", *METRICS)
    report = pairs.agg(*columns).filter(F.col("n_rows") > 0)
    return report.select(F.lit("all").alias("group"), F.lit("total").alias("level"), "n_rows", *METRICS)


def evaluate_levels(actuals: DataFrame, forecasts: DataFrame, level_cols: list[str]) -> DataFrame:
    """The report for several level columns and for all rows, in one pass."""
    pairs = pair_forecasts(actuals, forecasts)
    sets = [[]] + [[c] for c in level_cols]
    bits = len(level_cols)
    report = pairs.groupingSets(sets, *level_cols).agg(
        F.grouping_id().alias("_gid"), *report_columns(F.col("sales"), F.col("forecast"))
    )
    level, group = F.lit("total"), F.lit("all")
    for i, c in enumerate(level_cols):
        kept = F.col("_gid") == (2**bits - 1) - 2 ** (bits - 1 - i)
        level = F.when(kept, c).otherwise(level)
        group = F.when(kept, F.col(c).cast("string")).otherwise(group)
    return report.select(group.alias("group"), level.alias("level"), "n_rows", *METRICS).filter(
        F.col("n_rows") > 0
    )


def evaluate_hierarchy(pairs: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Error report of each hierarchy level, on sums of sales and forecasts, which one roll-up carries."""
    both = roll_up(pairs, ["sales", "forecast"], levels)
    return both.groupBy("level").agg(*report_columns(F.col("sales"), F.col("forecast")))


def naive_errors(df: DataFrame, keys: list[str] = ["id"]) -> DataFrame:
    """One-day change of each series; a series' first day is dropped."""
    w = Window.partitionBy(*keys).orderBy("date")
    change = F.col("sales") - F.lag("sales").over(w)
    return df.withColumn("naive_error", change).filter(F.col("naive_error").isNotNull())


def first_days(df: DataFrame, h: int, keys: list[str] = ["id"]) -> DataFrame:
    """The first ``h`` rows of each series."""
    w = Window.partitionBy(*keys).orderBy("date")
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= h).drop("_n")


def last_days(df: DataFrame, n: int, keys: list[str] = ["id"]) -> DataFrame:
    """The last ``n`` rows of each series."""
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def rmsse(
    actuals: DataFrame, forecasts: DataFrame, train: DataFrame, h: int = HORIZON, keys: list[str] = ["id"]
) -> DataFrame:
    """Root mean squared scaled error per series.

    Squared error of the first ``h`` days over the mean squared one-day change
    in training; a flat training series scores 0, one without a change is left out.
    """
    scale = naive_errors(train, keys).groupBy(*keys).agg(F.avg(F.pow("naive_error", F.lit(2))).alias("scale"))
    pairs = first_days(pair_forecasts(actuals, forecasts, keys + ["date"]), h, keys)
    mse = pairs.groupBy(*keys).agg(F.avg(F.pow(F.col("sales") - F.col("forecast"), F.lit(2))).alias("mse"))
    scaled = F.when(F.col("scale") < SCALE_FLOOR, 0.0).otherwise(
        F.sqrt(F.col("mse") / F.greatest("scale", F.lit(SCALE_FLOOR)))
    )
    return mse.join(scale, keys).select(*keys, scaled.alias("rmsse"))


def mean_prices(prices: DataFrame) -> DataFrame:
    return prices.groupBy("item_id", "store_id").agg(F.avg("sell_price").alias("avg_price"))


def with_mean_price(series: DataFrame, prices: DataFrame) -> DataFrame:
    """Mean price of the series over all weeks, 1 when it has none."""
    joined = series.join(mean_prices(prices), ["item_id", "store_id"], "left")
    return joined.withColumn("avg_price", F.coalesce("avg_price", F.lit(1.0)))


def revenue_weights(train: DataFrame, prices: DataFrame, days: int = HORIZON) -> DataFrame:
    """Share of each series in the revenue of the last training days."""
    start = F.date_sub(train.agg(F.max("date")).scalar(), days)
    recent = train.withColumn("_recent", F.when(F.col("date") > start, F.col("sales")).otherwise(0.0))
    totals = recent.groupBy("id", "item_id", "store_id").agg(F.sum("_recent").alias("sales"))
    revenue = with_mean_price(totals, prices).withColumn("revenue", F.col("sales") * F.col("avg_price"))
    overall = revenue.agg(F.greatest(F.sum("revenue"), F.lit(1e-10))).scalar()
    return revenue.select("id", (F.col("revenue") / overall).alias("weight"))


def weighted_score(scores: DataFrame, weights: DataFrame, keys: list[str], by: list[str] = []) -> DataFrame:
    """Weighted mean of the scaled errors; a missing weight counts 0, no weight at all scores 0."""
    w = F.coalesce("weight", F.lit(0.0))
    total = F.sum(w)
    score = F.when(total > 0, F.sum(w * F.col("rmsse")) / F.nullif(total, F.lit(0.0)))
    joined = scores.join(weights, keys, "left")
    return joined.groupBy(*by).agg(F.coalesce(score, F.lit(0.0)).alias("wrmsse"))


def wrmsse(
    actuals: DataFrame, forecasts: DataFrame, train: DataFrame, weights: DataFrame, h: int = HORIZON
) -> DataFrame:
    """One row: the weighted scaled error over all series."""
    return weighted_score(rmsse(actuals, forecasts, train, h), weights, ["id"])


def wrmsse_levels(
    actuals: DataFrame,
    forecasts: DataFrame,
    train: DataFrame,
    weights: DataFrame,
    hierarchy: DataFrame,
    levels: list[str] = SCORED_LEVELS,
    h: int = HORIZON,
) -> DataFrame:
    """Weighted scaled error of each level: sums of sales, forecasts and weights.

    All levels go through one roll-up and one scoring pass.
    """
    node = F.concat_ws("|", *ID_COLUMNS).alias("node")

    def rolled(df: DataFrame, value: str) -> DataFrame:
        keyed = with_hierarchy(df, hierarchy)
        if "date" not in keyed.columns:
            keyed = keyed.withColumn("date", F.lit(None).cast("date"))
        return roll_up(keyed, value, levels).select("level", node, "date", value)

    keys = ["level", "node"]
    scores = rmsse(rolled(actuals, "sales"), rolled(forecasts, "forecast"), rolled(train, "sales"), h, keys)
    return weighted_score(scores, rolled(weights, "weight").drop("date"), keys, ["level"])


def naive_baseline(val: DataFrame, train: DataFrame, h: int = HORIZON) -> DataFrame:
    """Mean of the last seven training days, repeated over the first ``h`` validation days.

    The days come as one short array, exploded per series; ids without
    training rows get 0.
    """
    level = last_days(train.select("id", "date", "sales"), 7).groupBy("id").agg(F.avg("sales").alias("level"))
    days = val.select("date").distinct().orderBy("date").limit(h)
    horizon = days.agg(F.sort_array(F.collect_list("date"))).scalar()
    return (
        val.select("id").distinct()
        .join(level, "id", "left")
        .select("id", F.explode(horizon).alias("date"), F.coalesce("level", F.lit(0.0)).alias("forecast"))
    )


def improvement(new: DataFrame, old: DataFrame) -> DataFrame:
    """Change of each metric from ``old`` to ``new``, one row per group and metric."""
    long = lambda df, name: df.unpivot(["group", "level"], METRICS, "metric", name)
    both = long(new, "value").join(long(old, "baseline"), ["group", "level", "metric"], "left")
    return both.withColumn("change_pct", percent_change(F.col("value"), F.col("baseline")))


def store_performance(pairs: DataFrame, store_col: str = "store_id") -> DataFrame:
    """Errors, totals and bias of each store."""
    sales, forecast = F.col("sales"), F.col("forecast")
    report = [c for c in report_columns(sales, forecast)[1:4]]
    out = pairs.groupBy(F.col(store_col).alias("store")).agg(
        *report, F.sum(sales).alias("total_sales"), F.sum(forecast).alias("total_forecast")
    )
    gap = F.col("total_forecast") - F.col("total_sales")
    return out.withColumn("bias_pct", gap / F.greatest("total_sales", F.lit(1.0)) * 100)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the extremes; the last edge is inside."""
    values = df.filter(F.col(column).isNotNull()).select(column)
    ends = values.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    placed = values.withColumn("_ends", ends).withColumn(
        "_width", (F.col("_ends.hi") - F.col("_ends.lo")) / F.lit(float(bins))
    )
    at = F.floor((F.col(column) - F.col("_ends.lo")) / F.nullif(F.col("_width"), F.lit(0.0)))
    bucket = F.when(at.isNotNull(), F.least(at, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return (
        placed.groupBy(bucket.alias("bin"))
        .agg(
            F.first("_ends").alias("_ends"), F.first("_width").alias("_width"), F.count(F.lit(1)).alias("n")
        )
        .select(
            "bin",
            (F.col("_ends.lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_ends.lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "n",
        )
    )


def residuals(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("residual", F.col("sales") - F.col("forecast"))


def first_residuals(pairs: DataFrame, n: int = 500) -> DataFrame:
    """The first ``n`` residuals by date, for the scatter chart; ids break ties."""
    return residuals(pairs).orderBy("date", "id").limit(n).select("id", "date", "residual")
