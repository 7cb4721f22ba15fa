"""Aggregations and the flagship: queries A."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.joins import PROPORTIONS_SQL, TOP_SQL, WEIGHT_SQL, split_and_naive, val_and_naive
from shelfcast.catalog.profiles import ERRORS_SQL, NAIVE_SQL, SPLIT_SQL
from shelfcast.fixed_values import LEVELS
from shelfcast.operators import explore as Q
from shelfcast.operators import hierarchy as H
from shelfcast.operators import metrics as M
from shelfcast.operators import panel as P
from shelfcast.operators import seasonal as N
from shelfcast.operators.features import add_context_features
from shelfcast.operators.recursive import recent_mean

_IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]


def _levels_sql(source: str, value: str) -> str:
    parts = []
    for level, keys in LEVELS.items():
        ids = ", ".join(c if c in keys else f"CAST(NULL AS VARCHAR) AS {c}" for c in _IDS)
        group = ", ".join([*keys, "date"])
        parts.append(f"SELECT '{level}' AS level, {ids}, date, sum({value}) AS {value} FROM {source} GROUP BY {group}")
    return " UNION ALL ".join(parts)


@query(
    "flagship_naive_accuracy",
    R.with_panel(
        f"SELECT level, {ERRORS_SQL} FROM (SELECT level, s.sales, f.forecast FROM sold s JOIN forecast f USING (level, node, date)) GROUP BY level",
        NAIVE_SQL,
        f"sold AS (SELECT level, concat_ws('|', {', '.join(_IDS)}) AS node, date, sales FROM ({_levels_sql('pairs', 'sales')}))",
        f"forecast AS (SELECT level, concat_ws('|', {', '.join(_IDS)}) AS node, date, forecast FROM ({_levels_sql('pairs', 'forecast')}))",
    ),
)
def flagship_naive_accuracy(spark, sf_dir):
    """Accuracy of the naive forecast at every level of the hierarchy."""
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.evaluate_hierarchy(M.pair_forecasts(val, naive)))


@query(
    "a1_bottom_up",
    R.with_panel(
        f"SELECT * REPLACE (round(forecast, 6) + 0.0 AS forecast) FROM ({_levels_sql('pairs', 'forecast')})", NAIVE_SQL
    ),
)
def a1_bottom_up(spark, sf_dir):
    _, naive = val_and_naive(spark, sf_dir)
    hierarchy = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return R.rounded(H.bottom_up(naive, hierarchy))


@query(
    "a2_group_daily_totals",
    R.with_panel(
        """SELECT 'store' AS grain, store_id AS key, date, sum(sales) AS sales FROM panel GROUP BY store_id, date
        UNION ALL SELECT 'dept', dept_id, date, sum(sales) FROM panel GROUP BY dept_id, date
        UNION ALL SELECT 'all', 'all', date, sum(sales) FROM panel GROUP BY date"""
    ),
)
def a2_group_daily_totals(spark, sf_dir):
    sums = H.roll_up(R.stored_panel(spark, sf_dir), "sales", ["store", "dept", "total"])
    grain = F.when(F.col("level") == "total", "all").otherwise(F.col("level"))
    return sums.select(
        grain.alias("grain"), F.coalesce("store_id", "dept_id", F.lit("all")).alias("key"), "date", "sales"
    )


@query(
    "a3_proportions",
    R.with_panel("SELECT id, round(proportion, 9) + 0.0 AS proportion FROM props", PROPORTIONS_SQL),
)
def a3_proportions(spark, sf_dir):
    props = H.compute_proportions(R.stored_panel(spark, sf_dir))
    return props.select("id", (F.round("proportion", 9) + 0.0).alias("proportion"))


@query(
    "a4_top_down_by_store",
    R.with_panel(
        """SELECT store_id, date, round(sum(forecast * proportion), 6) + 0.0 AS forecast
        FROM top CROSS JOIN props JOIN series USING (id) GROUP BY store_id, date""",
        NAIVE_SQL,
        PROPORTIONS_SQL,
        TOP_SQL,
    ),
)
def a4_top_down_by_store(spark, sf_dir):
    train, val, naive = split_and_naive(spark, sf_dir)
    top = naive.groupBy("date").agg(F.sum("forecast").alias("forecast"))
    down = H.top_down(top, H.compute_proportions(train.unionByName(val)))
    keyed = H.with_hierarchy(down, P.build_hierarchy_map(R.daily_sales(spark, sf_dir)))
    return R.rounded(Q.total_by(keyed, ["store_id", "date"], "forecast"))


@query(
    "a5_coherence",
    R.with_panel(
        """SELECT level, max_gap, max_gap <= 1e-6 AS coherent FROM (
          SELECT level, round(max(abs(s - t)), 6) + 0.0 AS max_gap FROM (
            SELECT level, date, sum(sales) AS s FROM ("""
        + _levels_sql("panel", "sales")
        + """) WHERE level <> 'total' GROUP BY ALL)
          JOIN (SELECT date, sum(sales) AS t FROM panel GROUP BY date) USING (date) GROUP BY level)"""
    ),
)
def a5_coherence(spark, sf_dir):
    return R.rounded(H.coherence(H.roll_up(R.stored_panel(spark, sf_dir), "sales"), "sales", 1e-6))


@query("a6_error_metrics", R.with_panel(f"SELECT {ERRORS_SQL} FROM pairs", NAIVE_SQL))
def a6_error_metrics(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.evaluate_forecasts(val, naive).drop("group", "level"))


@query(
    "a7_report_by_level",
    R.with_panel(
        " UNION ALL ".join(
            [f"SELECT 'all' AS \"group\", 'total' AS level, {ERRORS_SQL} FROM pairs"]
            + [f"SELECT {c}, '{c}', {ERRORS_SQL} FROM pairs GROUP BY {c}" for c in ("store_id", "cat_id", "dept_id")]
        ),
        NAIVE_SQL,
    ),
)
def a7_report_by_level(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.evaluate_levels(val, naive, ["store_id", "cat_id", "dept_id"]))


@query(
    "a7_report_one_level",
    R.with_panel(
        f"SELECT state_id AS \"group\", 'state_id' AS level, {ERRORS_SQL} FROM pairs GROUP BY state_id", NAIVE_SQL
    ),
)
def a7_report_one_level(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.evaluate_forecasts(val, naive, "state_id"))


SCORES_SQL = """
scores AS (
  SELECT id, CASE WHEN scale < 1e-10 THEN 0.0 ELSE sqrt(mse / scale) END AS rmsse
  FROM (SELECT id, avg(pow(sales - forecast, 2)) AS mse FROM pairs GROUP BY id)
  JOIN (SELECT id, avg(pow(sales - p, 2)) AS scale FROM (
          SELECT id, sales, lag(sales) OVER (PARTITION BY id ORDER BY date) AS p FROM train)
        WHERE p IS NOT NULL GROUP BY id) USING (id)
)"""


@query(
    "a8_rmsse",
    R.with_panel("SELECT id, round(rmsse, 6) + 0.0 AS rmsse FROM scores", NAIVE_SQL, SCORES_SQL),
)
def a8_rmsse(spark, sf_dir):
    train, val, naive = split_and_naive(spark, sf_dir)
    return R.rounded(M.rmsse(val, naive, train))


@query(
    "a9_revenue_weights",
    R.with_panel(
        "SELECT id, round(weight, 9) + 0.0 AS weight FROM weights", SPLIT_SQL, R.PRICES_SQL, WEIGHT_SQL
    ),
)
def a9_revenue_weights(spark, sf_dir):
    train, _ = P.train_val_split(R.stored_panel(spark, sf_dir))
    weights = M.revenue_weights(train, R.prices(spark, sf_dir))
    return weights.select("id", (F.round("weight", 9) + 0.0).alias("weight"))


@query(
    "a10_wrmsse",
    R.with_panel(
        "SELECT round(sum(weight * rmsse) / sum(weight), 6) + 0.0 AS wrmsse FROM scores JOIN weights USING (id)",
        NAIVE_SQL,
        SCORES_SQL,
        R.PRICES_SQL,
        WEIGHT_SQL,
    ),
)
def a10_wrmsse(spark, sf_dir):
    train, val, naive = split_and_naive(spark, sf_dir)
    return R.rounded(M.wrmsse(val, naive, train, M.revenue_weights(train, R.prices(spark, sf_dir))))


@query(
    "a11_naive_baseline",
    R.with_panel(
        "SELECT id, count(*) AS n_days, round(min(forecast), 6) + 0.0 AS forecast FROM naive GROUP BY id", NAIVE_SQL
    ),
)
def a11_naive_baseline(spark, sf_dir):
    _, naive = val_and_naive(spark, sf_dir)
    return naive.groupBy("id").agg(F.count("*").alias("n_days"), R.r6(F.min("forecast")).alias("forecast"))


_MEAN_SQL = "means AS (SELECT id, avg(sales) AS forecast FROM train GROUP BY id)"
_METRICS = ["MAE", "RMSE", "MAPE", "SMAPE"]


@query(
    "a12_improvement",
    R.with_panel(
        """SELECT 'all' AS "group", 'total' AS level, metric, round(value, 6) + 0.0 AS value,
        round(baseline, 6) + 0.0 AS baseline, round((value - baseline) * 100 / abs(baseline), 6) + 0.0 AS change_pct
        FROM ("""
        + " UNION ALL ".join(f"SELECT '{m}' AS metric, n.{m} AS value, b.{m} AS baseline FROM new n CROSS JOIN old b" for m in _METRICS)
        + ")",
        NAIVE_SQL,
        _MEAN_SQL,
        "old AS (SELECT " + ERRORS_SQL.replace("round(", "(").replace(", 6) + 0.0", ")") + " FROM pairs)",
        "new AS (SELECT " + ERRORS_SQL.replace("round(", "(").replace(", 6) + 0.0", ")")
        + " FROM (SELECT v.sales, m.forecast FROM val v JOIN means m USING (id)))",
    ),
)
def a12_improvement(spark, sf_dir):
    """The long-run mean of each series against the naive forecast."""
    train, val, naive = split_and_naive(spark, sf_dir)
    means = train.groupBy("id").agg(F.avg("sales").alias("forecast"))
    flat = val.select("id", "date").join(means, "id")
    return R.rounded(M.improvement(M.evaluate_forecasts(val, flat), M.evaluate_forecasts(val, naive)))


@query(
    "a13_store_performance",
    R.with_panel(
        """SELECT store_id AS store, round(avg(abs(sales - forecast)), 6) + 0.0 AS MAE,
        round(sqrt(avg(pow(sales - forecast, 2))), 6) + 0.0 AS RMSE,
        round(100 * avg(abs(sales - forecast) / greatest(abs(sales), 1.0)), 6) + 0.0 AS MAPE,
        sum(sales) AS total_sales, round(sum(forecast), 6) + 0.0 AS total_forecast,
        round((sum(forecast) - sum(sales)) / greatest(sum(sales), 1.0) * 100, 6) + 0.0 AS bias_pct
        FROM pairs GROUP BY store_id""",
        NAIVE_SQL,
    ),
)
def a13_store_performance(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.store_performance(M.pair_forecasts(val, naive)))


@query(
    "a14_context_means",
    R.with_panel(
        """SELECT id, count(*) AS n_rows, round(sum(s), 6) + 0.0 AS store_mean, round(sum(d), 6) + 0.0 AS dept_mean
        FROM (SELECT id, avg(sales) OVER (PARTITION BY store_id, date) AS s,
                avg(sales) OVER (PARTITION BY dept_id, date) AS d FROM panel) GROUP BY id"""
    ),
)
def a14_context_means(spark, sf_dir):
    return add_context_features(R.stored_panel(spark, sf_dir)).groupBy("id").agg(
        F.count("*").alias("n_rows"),
        R.r6(F.sum("store_daily_mean")).alias("store_mean"),
        R.r6(F.sum("dept_daily_mean")).alias("dept_mean"),
    )


@query(
    "a15_recent_means",
    R.with_panel(
        """SELECT 'store_id' AS grain, store_id AS key, round(avg(sales), 6) + 0.0 AS recent_mean FROM panel
        WHERE date >= (SELECT max(date) FROM panel) - 7 GROUP BY store_id
        UNION ALL SELECT 'dept_id', dept_id, round(avg(sales), 6) + 0.0 FROM panel
        WHERE date >= (SELECT max(date) FROM panel) - 7 GROUP BY dept_id"""
    ),
)
def a15_recent_means(spark, sf_dir):
    df = R.stored_panel(spark, sf_dir)
    parts = [
        recent_mean(df, k, "recent_mean").select(F.lit(k).alias("grain"), F.col(k).alias("key"), "recent_mean")
        for k in ("store_id", "dept_id")
    ]
    return R.rounded(parts[0].unionByName(parts[1]))


@query("a16_hierarchy_map", R.with_panel(f"SELECT {', '.join(_IDS)} FROM series"))
def a16_hierarchy_map(spark, sf_dir):
    return P.build_hierarchy_map(R.daily_sales(spark, sf_dir))


@query(
    "a17_dataset_summary",
    R.with_panel(
        """SELECT count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores,
        count(DISTINCT id) AS n_series, count(DISTINCT date) AS n_days, count(*) AS n_rows FROM panel"""
    ),
)
def a17_dataset_summary(spark, sf_dir):
    return Q.dataset_summary(R.stored_panel(spark, sf_dir))


@query(
    "a18_value_counts",
    R.with_panel(
        """SELECT 'cat_id' AS col, cat_id AS value, count(*) AS n FROM series GROUP BY cat_id
        UNION ALL SELECT 'dept_id', dept_id, count(*) FROM series GROUP BY dept_id"""
    ),
)
def a18_value_counts(spark, sf_dir):
    series = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    counts = [
        Q.value_counts(series, c).select(F.lit(c).alias("col"), F.col(c).alias("value"), "n")
        for c in ("cat_id", "dept_id")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "a19_zero_rate",
    R.with_panel(
        """SELECT id, round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS zero_rate FROM panel GROUP BY id
        UNION ALL SELECT 'all', round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 FROM panel"""
    ),
)
def a19_zero_rate(spark, sf_dir):
    df = R.stored_panel(spark, sf_dir)
    overall = Q.zero_rate(df).select(F.lit("all").alias("id"), "zero_rate")
    return R.rounded(Q.zero_rate(df, ["id"]).unionByName(overall))


@query(
    "a20_mean_daily_sales",
    R.with_panel(
        """SELECT cat_id, round(avg(m), 6) + 0.0 AS mean_sales
        FROM (SELECT cat_id, date, avg(sales) AS m FROM panel GROUP BY ALL) GROUP BY cat_id"""
    ),
)
def a20_mean_daily_sales(spark, sf_dir):
    return R.rounded(Q.mean_daily_sales(R.panel(spark, sf_dir)))


@query(
    "a21_weekday_profile",
    R.with_panel(
        """SELECT dayname(date) AS weekday, round(avg(s), 6) + 0.0 AS mean_sales, CAST(min(isodow(date)) AS INTEGER) AS place
        FROM (SELECT date, sum(sales) AS s FROM panel GROUP BY date) GROUP BY 1"""
    ),
)
def a21_weekday_profile(spark, sf_dir):
    return R.rounded(Q.weekday_profile(R.panel(spark, sf_dir)))


@query(
    "a21_month_profile",
    R.with_panel(
        """SELECT CAST(month(date) AS INTEGER) AS month, round(avg(s), 6) + 0.0 AS mean_sales
        FROM (SELECT date, sum(sales) AS s FROM panel GROUP BY date) GROUP BY 1"""
    ),
)
def a21_month_profile(spark, sf_dir):
    return R.rounded(Q.month_profile(R.panel(spark, sf_dir)))


@query(
    "a22_event_uplift",
    R.with_dated(
        """SELECT event_name_1, round(avg(s), 6) + 0.0 AS mean_sales,
        round((avg(s) / (SELECT avg(s) FROM (SELECT sum(sales) AS s FROM panel GROUP BY date)) - 1) * 100, 6) + 0.0 AS uplift_pct
        FROM (SELECT date, event_name_1, sum(sales) AS s FROM panel JOIN cal USING (date)
              WHERE event_name_1 IS NOT NULL GROUP BY ALL) GROUP BY event_name_1"""
    ),
)
def a22_event_uplift(spark, sf_dir):
    return R.rounded(Q.event_uplift(R.dated_panel(spark, sf_dir)))


@query("a23_store_totals", R.with_panel("SELECT store_id, sum(sales) AS sales FROM panel GROUP BY store_id"))
def a23_store_totals(spark, sf_dir):
    return Q.total_by(R.panel(spark, sf_dir), ["store_id"])


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""SELECT CAST(coalesce(least(floor(({column} - lo) / nullif((hi - lo) / {bins}.0, 0)), {bins - 1}), 0) AS INTEGER) AS bin,
      round(lo + min(coalesce(least(floor(({column} - lo) / nullif((hi - lo) / {bins}.0, 0)), {bins - 1}), 0)) * ((hi - lo) / {bins}.0), 6) + 0.0 AS bin_start,
      round(lo + (min(coalesce(least(floor(({column} - lo) / nullif((hi - lo) / {bins}.0, 0)), {bins - 1}), 0)) + 1) * ((hi - lo) / {bins}.0), 6) + 0.0 AS bin_end,
      count(*) AS n
      FROM {source} CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) GROUP BY 1, lo, hi"""


@query(
    "a24_residual_histogram",
    R.with_panel(
        _histogram_sql("resid", "residual", 60),
        NAIVE_SQL,
        "resid AS (SELECT CAST(sales - forecast AS DOUBLE) AS residual FROM pairs)",
    ),
)
def a24_residual_histogram(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.histogram(M.residuals(M.pair_forecasts(val, naive)), "residual", 60))


@query(
    "a24_sales_histogram",
    R.with_panel(
        _histogram_sql("sold", "sales", 80), "sold AS (SELECT CAST(sales AS DOUBLE) AS sales FROM panel WHERE sales > 0)"
    ),
)
def a24_sales_histogram(spark, sf_dir):
    return R.rounded(M.histogram(R.stored_panel(spark, sf_dir).filter(F.col("sales") > 0), "sales", 80))


@query(
    "a24_zero_rate_histogram",
    R.with_panel(
        _histogram_sql("rates", "rate", 40),
        "rates AS (SELECT avg(CASE WHEN sales = 0 THEN CAST(1 AS DOUBLE) ELSE 0 END) AS rate FROM panel GROUP BY id)",
    ),
)
def a24_zero_rate_histogram(spark, sf_dir):
    rates = Q.zero_rate(R.stored_panel(spark, sf_dir), ["id"])
    return R.rounded(M.histogram(rates, "zero_rate", 40))


@query(
    "a25_group_series",
    R.with_panel(
        """SELECT store_id, date AS ds, round(ln(1 + greatest(sum(sales), 0)), 6) + 0.0 AS y
        FROM panel GROUP BY store_id, date"""
    ),
)
def a25_group_series(spark, sf_dir):
    return R.rounded(N.prepare_series(R.panel(spark, sf_dir), "store_id"))
