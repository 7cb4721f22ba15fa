"""Joins, set operations and declared extras: queries J, U and X."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.profiles import ERRORS_SQL, NAIVE_SQL, OFF_EDGE, profile, profile_sql
from shelfcast.fixed_values import HORIZON, LAGS, SCORED_LEVELS, WINDOWS
from shelfcast.operators import baselines as B
from shelfcast.operators import events as E
from shelfcast.operators import features as X
from shelfcast.operators import hierarchy as H
from shelfcast.operators import metrics as M
from shelfcast.operators import panel as P
from shelfcast.operators import recursive as V
from shelfcast.operators.ordering import exact_median
from shelfcast.sources import calendar as C


def split_and_naive(spark, sf_dir):
    """Training days, validation days and the naive forecast of the latter."""
    train, val = P.train_val_split(R.stored_panel(spark, sf_dir))
    return train, val, M.naive_baseline(val, train)


def val_and_naive(spark, sf_dir):
    """Validation days and their naive forecast, from the days that these two need."""
    train, val = P.train_val_split(R.recent_panel(spark, sf_dir, HORIZON + 7))
    return val, M.naive_baseline(val, train)


@query(
    "j1_panel_calendar",
    R.with_dated(
        """SELECT store_id, wm_yr_wk, weekday, count(*) AS n_rows, sum(sales) AS sales,
        count(event_name_1) AS n_event_rows, min(date) AS first_day
        FROM panel JOIN cal USING (date) GROUP BY store_id, wm_yr_wk, weekday"""
    ),
)
def j1_panel_calendar(spark, sf_dir):
    """Joined on the day label, which is made from the date first."""
    calendar = R.calendar(spark, sf_dir)
    first = R.bounds(spark, sf_dir).select("first").scalar()
    long = R.panel(spark, sf_dir)
    labelled = long.withColumn("d", F.concat(F.lit("d_"), F.datediff("date", first) + 1)).drop("date")
    return (
        P.merge_calendar(labelled, calendar)
        .groupBy("store_id", "wm_yr_wk", "weekday")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("sales").alias("sales"),
            F.count("event_name_1").alias("n_event_rows"),
            F.min("date").alias("first_day"),
        )
    )


@query(
    "j2_panel_prices",
    R.with_priced(
        """SELECT store_id, wm_yr_wk, count(*) AS n_rows, count(raw_price) AS n_sell_price,
        round(avg(raw_price) + 1.1e-8, 6) + 0.0 AS avg_sell_price FROM joined GROUP BY ALL"""
    ),
)
def j2_panel_prices(spark, sf_dir):
    joined = P.join_prices(R.dated_panel(spark, sf_dir), R.prices(spark, sf_dir))
    return profile(joined, ["sell_price"], ["store_id", "wm_yr_wk"])


@query(
    "j3_median_imputation", R.with_priced(profile_sql("priced", ["sell_price"], ["id", "wm_yr_wk"]))
)
def j3_median_imputation(spark, sf_dir):
    return profile(
        P.merge_prices(R.dated_panel(spark, sf_dir), R.prices(spark, sf_dir)), ["sell_price"], ["id", "wm_yr_wk"]
    )


@query(
    "j3_overall_median",
    "SELECT round(median(l_extendedprice), 6) + 0.0 AS median FROM lineitem",
)
def j3_overall_median(spark, sf_dir):
    """The last resort of the price fill: an exact median over every row."""
    return R.rounded(exact_median(R.table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    "j4_actuals_forecasts",
    R.with_panel("SELECT id, date, sales, round(forecast, 6) + 0.0 AS forecast FROM pairs", NAIVE_SQL),
)
def j4_actuals_forecasts(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.pair_forecasts(val, naive).select("id", "date", "sales", "forecast"))


@query(
    "j5_metadata_enrichment",
    R.with_panel(
        """SELECT n.id, n.date, round(n.forecast, 6) + 0.0 AS forecast, item_id, dept_id, cat_id, store_id, state_id
        FROM naive n JOIN series USING (id)""",
        NAIVE_SQL,
    ),
)
def j5_metadata_enrichment(spark, sf_dir):
    _, naive = val_and_naive(spark, sf_dir)
    hierarchy = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return R.rounded(H.with_hierarchy(naive, hierarchy))


@query(
    "j6_mean_price",
    R.with_panel(
        """SELECT id, round(coalesce(avg_price, 1.0), 6) + 0.0 AS avg_price FROM series
        LEFT JOIN (SELECT item_id, store_id, avg(sell_price) AS avg_price FROM prices GROUP BY ALL)
        USING (item_id, store_id)""",
        R.PRICES_SQL,
    ),
)
def j6_mean_price(spark, sf_dir):
    hierarchy = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return R.rounded(M.with_mean_price(hierarchy, R.prices(spark, sf_dir)).select("id", "avg_price"))


PROPORTIONS_SQL = """
recent AS (SELECT id, date, sales FROM panel WHERE date > (SELECT max(date) FROM panel) - 365),
day_totals AS (SELECT date, sum(sales) AS total FROM recent GROUP BY date),
shares AS (
  SELECT id, avg(sales / greatest(total, 1e-6)) AS share FROM recent JOIN day_totals USING (date) GROUP BY id
),
props AS (SELECT id, share / (SELECT sum(share) FROM shares) AS proportion FROM shares)"""

TOP_SQL = """
top AS (SELECT date, sum(forecast) AS forecast FROM naive GROUP BY date)"""


@query(
    "j7_top_down",
    R.with_panel(
        "SELECT id, date, round(forecast * proportion, 6) + 0.0 AS forecast FROM top CROSS JOIN props",
        NAIVE_SQL,
        PROPORTIONS_SQL,
        TOP_SQL,
    ),
)
def j7_top_down(spark, sf_dir):
    train, val, naive = split_and_naive(spark, sf_dir)
    top = naive.groupBy("date").agg(F.sum("forecast").alias("forecast"))
    return R.rounded(H.top_down(top, H.compute_proportions(train.unionByName(val))))


@query(
    "j8_horizon_scaffold",
    R.with_panel("SELECT id, date, round(forecast, 6) + 0.0 AS forecast FROM naive", NAIVE_SQL),
)
def j8_horizon_scaffold(spark, sf_dir):
    return R.rounded(split_and_naive(spark, sf_dir)[2])


_GAPPY = "gappy AS (SELECT s.id, x.date, x.sales FROM sparse x JOIN series s USING (item_id, store_id))"
_BY_DAY = "(PARTITION BY id ORDER BY date"


_LAGS_SQL = (
    f"WITH {R.SHIPMENTS_SQL}, "
    "gappy AS MATERIALIZED (SELECT concat_ws('_', item_id, store_id) AS id, date, sum(l_quantity) AS sales FROM ship GROUP BY ALL), "
    f"later AS (SELECT id, CAST(date + n AS DATE) AS date, n, sales FROM gappy, (SELECT unnest([{', '.join(map(str, LAGS))}]) AS n)) "
    "SELECT g.id, g.date, "
    + ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN l.sales END), 0.0) AS sales_lag_{n}" for n in LAGS)
    + " FROM gappy g LEFT JOIN later l ON l.id = g.id AND l.date = g.date GROUP BY g.id, g.date"
)


@query("j9_calendar_lags", _LAGS_SQL)
def j9_calendar_lags(spark, sf_dir):
    """On the rows with shipments only, where days are missing."""
    lagged = X.add_calendar_lags(R.daily_sales(spark, sf_dir))
    return lagged.select("id", "date", *[f"sales_lag_{n}" for n in LAGS])


def _range_sql() -> str:
    out = []
    for k in WINDOWS:
        frame = f"{_BY_DAY} RANGE BETWEEN INTERVAL {27 + k} DAY PRECEDING AND INTERVAL 28 DAY PRECEDING)"
        out.append(f"round(coalesce(avg(sales) OVER {frame}, 0.0), 6) + 0.0 AS rolling_mean_{k}")
        out.append(f"round(coalesce(stddev_samp(sales) OVER {frame}, 0.0), 6) + 0.0 AS rolling_std_{k}")
    return ", ".join(out)


@query("j10_calendar_rolling", R.with_panel(f"SELECT id, date, {_range_sql()} FROM gappy", _GAPPY))
def j10_calendar_rolling(spark, sf_dir):
    rolled = X.add_calendar_rolling(R.daily_sales(spark, sf_dir))
    names = [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]
    return R.rounded(rolled.select("id", "date", *names))


_NEAR_SQL = """
near AS (
  SELECT event_name_1, date AS event_date, date + o AS near_day, o AS event_offset,
         CAST(1 - 0.2 * abs(o) AS DOUBLE) AS event_weight
  FROM events_found CROSS JOIN (SELECT CAST(unnest(generate_series(-2, 2)) AS INTEGER) AS o)
)"""


@query(
    "j11_event_windows",
    R.with_dated(
        """SELECT store_id, event_name_1, event_offset, count(*) AS n_rows,
        round(sum(sales * event_weight), 6) + 0.0 AS weighted_sales
        FROM panel p JOIN near n ON p.date = n.near_day GROUP BY ALL""",
        _NEAR_SQL,
    ),
)
def j11_event_windows(spark, sf_dir):
    near = E.join_event_windows(R.panel(spark, sf_dir), R.events(spark, sf_dir))
    return near.groupBy("store_id", "event_name_1", "event_offset").agg(
        F.count("*").alias("n_rows"),
        R.r6(F.sum(F.col("sales") * F.col("event_weight"))).alias("weighted_sales"),
    )


@query(
    "j11_strongest_event",
    R.with_calendar(
        """SELECT date, n.event_name_1, n.event_offset, round(n.event_weight, 6) + 0.0 AS event_weight
        FROM days LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY near_day ORDER BY event_weight DESC,
          event_name_1, event_offset) AS rn FROM near) n ON n.near_day = date AND rn = 1""",
        _NEAR_SQL,
    ),
)
def j11_strongest_event(spark, sf_dir):
    days = R.calendar(spark, sf_dir).select("date")
    return R.rounded(E.strongest_event(days, R.events(spark, sf_dir)))


@query(
    "j12_holiday_windows",
    R.with_calendar(
        """SELECT holiday, ds, CAST(unnest(generate_series(ds + lo, ds + hi, INTERVAL 1 DAY)) AS DATE) AS date,
        CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS day_offset
        FROM (SELECT event_name_1 AS holiday, date AS ds,
                CASE event_name_1 WHEN 'SuperBowl' THEN -1 WHEN 'Thanksgiving' THEN -2 ELSE -7 END AS lo,
                CASE event_name_1 WHEN 'SuperBowl' THEN 1 ELSE 0 END AS hi
              FROM events_found WHERE event_name_1 IN ('SuperBowl', 'Thanksgiving', 'Christmas'))"""
    ),
)
def j12_holiday_windows(spark, sf_dir):
    return E.holiday_days(C.holidays_of(R.events(spark, sf_dir)))


@query(
    "j13_daily_share",
    R.with_panel(
        """SELECT store_id, date, round(sum(sales / greatest(total, 1e-6)) + 1.1e-8, 6) + 0.0 AS share
        FROM panel JOIN (SELECT date, sum(sales) AS total FROM panel GROUP BY date) USING (date)
        GROUP BY store_id, date"""
    ),
)
def j13_daily_share(spark, sf_dir):
    shares = H.daily_shares(R.stored_panel(spark, sf_dir), ["id", "store_id"])
    return shares.groupBy("store_id", "date").agg(R.r6(F.sum("share") + OFF_EDGE).alias("share"))


@query(
    "j14_membership_edges",
    R.with_panel(
        """SELECT 'item_store' AS level, id AS node_id, id AS bottom_id FROM series
        UNION ALL SELECT 'store', 'store|' || store_id, id FROM series
        UNION ALL SELECT 'state', 'state|' || state_id, id FROM series
        UNION ALL SELECT 'cat', 'cat|' || cat_id, id FROM series
        UNION ALL SELECT 'dept', 'dept|' || dept_id, id FROM series
        UNION ALL SELECT 'total', 'total', id FROM series"""
    ),
)
def j14_membership_edges(spark, sf_dir):
    hierarchy = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return H.membership_edges(hierarchy, ["store", "state", "cat", "dept", "total"])


@query(
    "j15_context_lookup",
    R.with_panel(
        """SELECT id, round(coalesce(s.m, 0.0), 6) + 0.0 AS store_daily_mean,
        round(coalesce(d.m, 0.0), 6) + 0.0 AS dept_daily_mean FROM series
        LEFT JOIN (SELECT store_id, avg(sales) AS m FROM panel
                   WHERE date >= (SELECT max(date) FROM panel) - 7 GROUP BY 1) s USING (store_id)
        LEFT JOIN (SELECT dept_id, avg(sales) AS m FROM panel
                   WHERE date >= (SELECT max(date) FROM panel) - 7 GROUP BY 1) d USING (dept_id)"""
    ),
)
def j15_context_lookup(spark, sf_dir):
    panel = R.stored_panel(spark, sf_dir)
    series = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return R.rounded(
        V.join_recent_context(series, panel).select("id", "store_daily_mean", "dept_daily_mean")
    )


@query(
    "u1_append_predictions",
    R.with_panel(
        """SELECT id, count(*) AS n_rows, round(sum(sales), 6) + 0.0 AS sales, count(item_id) AS n_items,
        max(date) AS last_day FROM (
          SELECT id, date, sales, item_id FROM train
          UNION ALL SELECT id, date, forecast, NULL FROM naive) GROUP BY id""",
        NAIVE_SQL,
    ),
)
def u1_append_predictions(spark, sf_dir):
    train, _, naive = split_and_naive(spark, sf_dir)
    return V.append_predictions(train, naive).groupBy("id").agg(
        F.count("*").alias("n_rows"),
        R.r6(F.sum("sales")).alias("sales"),
        F.count("item_id").alias("n_items"),
        F.max("date").alias("last_day"),
    )


@query(
    "u2_first_row_per_id",
    R.with_panel(
        """SELECT id, date, sales FROM (SELECT s.id, x.date, x.sales,
          row_number() OVER (PARTITION BY s.id ORDER BY x.date) AS rn
          FROM sparse x JOIN series s USING (item_id, store_id)) WHERE rn = 1"""
    ),
)
def u2_first_row_per_id(spark, sf_dir):
    return M.first_days(R.daily_sales(spark, sf_dir), 1).select("id", "date", "sales")


@query(
    "u2_drop_duplicates",
    R.with_ship("SELECT DISTINCT store_id, dept_id, date FROM ship"),
)
def u2_drop_duplicates(spark, sf_dir):
    return R.shipments(spark, sf_dir).select("store_id", "dept_id", "date").distinct()


@query(
    "x1_price_lags",
    R.with_priced(
        profile_sql("lagged_prices", ["price_lag_1", "price_lag_7", "price_lag_28"]),
        """lagged_prices AS (SELECT store_id, date, """
        + ", ".join(f"lag(sell_price, {n}) OVER w AS price_lag_{n}" for n in (1, 7, 28))
        + " FROM priced WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date))",
    ),
)
def x1_price_lags(spark, sf_dir):
    lagged = X.add_price_lags(R.priced_panel(spark, sf_dir))
    return profile(lagged, ["price_lag_1", "price_lag_7", "price_lag_28"])


@query(
    "x2_rolling_origin",
    R.with_panel(
        f"""SELECT fold, {ERRORS_SQL} FROM (
          SELECT f.fold, p.id, p.date, p.sales, l.level AS forecast FROM panel p
          CROSS JOIN folds f JOIN levels l ON l.id = p.id AND l.fold = f.fold
          WHERE p.date > f.cut AND p.date <= f.cut + 28) GROUP BY fold""",
        """folds AS (SELECT CAST(k AS INTEGER) AS fold, (SELECT max(date) FROM panel) - CAST(28 * k AS INTEGER) AS cut
                  FROM (SELECT unnest(generate_series(1, 5)) AS k)),
        levels AS (SELECT fold, id, avg(sales) AS level FROM panel CROSS JOIN folds
                   WHERE date <= cut AND date > cut - 7 GROUP BY fold, id)""",
    ),
)
def x2_rolling_origin(spark, sf_dir):
    return R.rounded(B.rolling_origin_report(R.stored_panel(spark, sf_dir), folds=5))


WEIGHT_SQL = """
mean_prices AS (SELECT item_id, store_id, avg(sell_price) AS avg_price FROM prices GROUP BY ALL),
revenue AS (
  SELECT t.id, t.item_id, t.store_id, t.dept_id, t.cat_id,
         sum(CASE WHEN date > (SELECT max(date) FROM train) - 28 THEN sales ELSE 0 END) * max(coalesce(avg_price, 1.0)) AS revenue
  FROM train t LEFT JOIN mean_prices USING (item_id, store_id) GROUP BY ALL
),
weights AS (SELECT *, revenue / greatest((SELECT sum(revenue) FROM revenue), 1e-10) AS weight FROM revenue)"""


def _level_sql(level: str, key: str) -> str:
    return f"""SELECT '{level}' AS level, round(sum(w * r) / sum(w), 6) + 0.0 AS wrmsse FROM (
      SELECT g, w, CASE WHEN scale < 1e-10 THEN 0.0 ELSE sqrt(mse / scale) END AS r
      FROM (SELECT g, avg(pow(s - f, 2)) AS mse FROM (
              SELECT {key} AS g, date, sum(sales) AS s, sum(forecast) AS f FROM pairs GROUP BY ALL) GROUP BY g)
      JOIN (SELECT g, avg(pow(s - p, 2)) AS scale FROM (
              SELECT g, s, lag(s) OVER (PARTITION BY g ORDER BY date) AS p FROM (
                SELECT {key} AS g, date, sum(sales) AS s FROM train GROUP BY ALL)) WHERE p IS NOT NULL GROUP BY g)
        USING (g)
      JOIN (SELECT {key} AS g, sum(weight) AS w FROM weights GROUP BY ALL) USING (g))"""


_LEVEL_KEYS = {"item_store": "id", "item": "item_id", "dept": "dept_id", "cat": "cat_id", "store": "store_id", "total": "'all'"}


@query(
    "x3_multi_level_wrmsse",
    R.with_panel(
        " UNION ALL ".join(_level_sql(n, _LEVEL_KEYS[n]) for n in SCORED_LEVELS),
        NAIVE_SQL,
        R.PRICES_SQL,
        WEIGHT_SQL,
    ),
)
def x3_multi_level_wrmsse(spark, sf_dir):
    train, val, naive = split_and_naive(spark, sf_dir)
    weights = M.revenue_weights(train, R.prices(spark, sf_dir))
    hierarchy = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return R.rounded(M.wrmsse_levels(val, naive, train, weights, hierarchy))


@query(
    "x3_average_wrmsse",
    R.with_panel(
        "SELECT round(avg(wrmsse), 6) + 0.0 AS wrmsse, count(*) AS n_levels FROM (" + " UNION ALL ".join(_level_sql(n, _LEVEL_KEYS[n]) for n in SCORED_LEVELS) + ")",
        NAIVE_SQL,
        R.PRICES_SQL,
        WEIGHT_SQL,
    ),
)
def x3_average_wrmsse(spark, sf_dir):
    """The levels' scores count alike."""
    levels = x3_multi_level_wrmsse(spark, sf_dir)
    return levels.agg(R.r6(F.avg("wrmsse")).alias("wrmsse"), F.count("*").alias("n_levels"))


@query(
    "x4_ratio_split",
    R.with_panel(
        """SELECT date <= cut AS is_train, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day
        FROM panel CROSS JOIN (SELECT lo + CAST(floor((hi - lo) * 0.85) AS INTEGER) AS cut FROM bounds) GROUP BY 1"""
    ),
)
def x4_ratio_split(spark, sf_dir):
    train, test = P.ratio_split(R.stored_panel(spark, sf_dir), 0.85)
    sized = lambda df, flag: df.agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    ).withColumn("is_train", F.lit(flag))
    return sized(train, True).unionByName(sized(test, False))
