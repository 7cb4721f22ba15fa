"""Window functions, sorts and scalar functions: queries W, T and F."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.data import _LAGS_SQL
from shelfcast.catalog.joins import val_and_naive
from shelfcast.catalog.profiles import NAIVE_SQL, SPLIT_SQL, calendar_feature_sql, profile, profile_sql
from shelfcast.fixed_values import FEATURES, LAGS, WINDOWS
from shelfcast.functions import dates as D
from shelfcast.functions import scalars as S
from shelfcast.operators import explore as Q
from shelfcast.operators import features as X
from shelfcast.operators import metrics as M
from shelfcast.operators import panel as P

_LAG_NAMES = [f"sales_lag_{n}" for n in LAGS]
_ROLLING_NAMES = [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]
_PRICE_NAMES = ["price_roll_mean_28", "price_change", "price_relative", "price_max", "price_discount"]

PRICE_FEATURES_SQL = """
price_parts AS (
  SELECT *, avg(sell_price) OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS price_roll_mean_28,
    coalesce(sell_price - lag(sell_price) OVER w, 0) AS price_change,
    sell_price / avg(sell_price) OVER (PARTITION BY item_id, store_id) AS price_relative,
    max(sell_price) OVER (PARTITION BY item_id, store_id) AS price_max
  FROM priced WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date)
),
price_features AS (
  SELECT *, (price_max - sell_price) / greatest(price_max, 0.01) AS price_discount FROM price_parts
)"""


@query("w1_lag_features", R.with_panel(profile_sql("lagged", _LAG_NAMES), _LAGS_SQL))
def w1_lag_features(spark, sf_dir):
    return profile(X.add_lag_features(R.panel(spark, sf_dir)), _LAG_NAMES)


@query("w2_rolling_stats", R.with_panel(profile_sql("lagged", _ROLLING_NAMES), _LAGS_SQL))
def w2_rolling_stats(spark, sf_dir):
    return profile(X.add_rolling_features(R.panel(spark, sf_dir)), _ROLLING_NAMES)


def _price_query(name: str, column: str) -> None:
    @query(name, R.with_priced(profile_sql("price_features", [column]), PRICE_FEATURES_SQL))
    def run(spark, sf_dir):
        return profile(X.add_price_features(R.priced_panel(spark, sf_dir)), [column])


_price_query("w3_rolling_price", "price_roll_mean_28")
_price_query("w4_price_change", "price_change")
_price_query("w5_relative_price", "price_relative")
_price_query("w6_discount_depth", "price_discount")


@query(
    "w7_last_rows",
    R.with_panel(
        """SELECT id, date, sales FROM (SELECT id, date, sales,
          row_number() OVER (PARTITION BY id ORDER BY date DESC) AS rn FROM train) WHERE rn <= 7""",
        SPLIT_SQL,
    ),
)
def w7_last_rows(spark, sf_dir):
    train, _ = P.train_val_split(R.stored_panel(spark, sf_dir))
    return M.last_days(train, 7).select("id", "date", "sales")


@query(
    "w8_first_rows",
    R.with_panel(
        """SELECT id, date, sales, round(forecast, 6) + 0.0 AS forecast FROM (SELECT *,
          row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM pairs) WHERE rn <= 14""",
        NAIVE_SQL,
    ),
)
def w8_first_rows(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    first = M.first_days(M.pair_forecasts(val, naive), 14)
    return R.rounded(first.select("id", "date", "sales", "forecast"))


@query(
    "w9_naive_errors",
    R.with_panel(
        profile_sql("errors", ["naive_error"]),
        """errors AS (SELECT * FROM (SELECT store_id, date, sales - lag(sales) OVER (PARTITION BY id ORDER BY date)
           AS naive_error FROM panel) WHERE naive_error IS NOT NULL)""",
    ),
)
def w9_naive_errors(spark, sf_dir):
    return profile(M.naive_errors(R.panel(spark, sf_dir)), ["naive_error"])


@query(
    "w10_partition_median",
    R.with_ship(
        """SELECT store_id, dept_id, date, sales, median(sales) OVER (PARTITION BY store_id, dept_id) AS group_median
        FROM (SELECT store_id, dept_id, date, sum(l_quantity) AS sales FROM ship GROUP BY ALL)"""
    ),
)
def w10_partition_median(spark, sf_dir):
    daily = Q.total_by(R.daily_sales(spark, sf_dir), ["store_id", "dept_id", "date"])
    medians = daily.groupBy("store_id", "dept_id").agg(F.median("sales").alias("group_median"))
    return daily.join(medians, ["store_id", "dept_id"])


@query(
    "t1_panel_sort",
    R.with_panel("SELECT id, date, sales FROM sparse JOIN series USING (item_id, store_id) ORDER BY id, date"),
)
def t1_panel_sort(spark, sf_dir):
    return Q.sort_panel(R.daily_sales(spark, sf_dir)).select("id", "date", "sales")


@query(
    "t3_first_entities",
    R.with_panel(
        """SELECT 'store_id' AS col, v AS value FROM (SELECT DISTINCT store_id AS v FROM series ORDER BY v LIMIT 3)
        UNION ALL SELECT 'dept_id', v FROM (SELECT DISTINCT dept_id AS v FROM series ORDER BY v LIMIT 4)
        UNION ALL SELECT 'item_id', v FROM (SELECT DISTINCT item_id AS v FROM series ORDER BY v LIMIT 3)"""
    ),
)
def t3_first_entities(spark, sf_dir):
    df = R.daily_sales(spark, sf_dir)
    named = lambda c, k: Q.first_entities(df, c, k).select(F.lit(c).alias("col"), F.col(c).alias("value"))
    return named("store_id", 3).unionByName(named("dept_id", 4)).unionByName(named("item_id", 3))


@query(
    "t4_series_tail",
    R.with_panel("SELECT date, sum(sales) AS sales FROM panel GROUP BY date ORDER BY date DESC LIMIT 400"),
)
def t4_series_tail(spark, sf_dir):
    return Q.series_tail(Q.total_by(R.panel(spark, sf_dir), ["date"]), 400)


@query(
    "t4_first_residuals",
    R.with_panel(
        "SELECT id, date, round(sales - forecast, 6) + 0.0 AS residual FROM pairs ORDER BY date, id LIMIT 500",
        NAIVE_SQL,
    ),
)
def t4_first_residuals(spark, sf_dir):
    val, naive = val_and_naive(spark, sf_dir)
    return R.rounded(M.first_residuals(M.pair_forecasts(val, naive), 500))


@query(
    "t5_events_ranked",
    R.with_dated(
        """SELECT event_name_1, CAST(rank() OVER (ORDER BY m DESC, event_name_1) AS INTEGER) AS place FROM (
          SELECT event_name_1, avg(s) AS m FROM (SELECT event_name_1, date, sum(sales) AS s FROM panel
          JOIN cal USING (date) WHERE event_name_1 IS NOT NULL GROUP BY ALL) GROUP BY event_name_1)"""
    ),
)
def t5_events_ranked(spark, sf_dir):
    """One row per event name, so the final rank is over a handful of rows."""
    ranked = Q.event_uplift(R.dated_panel(spark, sf_dir))
    names = ranked.agg(F.collect_list(F.struct((-F.col("mean_sales")).alias("m"), "event_name_1")).alias("all"))
    return names.select(F.posexplode(F.sort_array("all")).alias("at", "e")).select(
        "e.event_name_1", (F.col("at") + 1).cast("int").alias("place")
    )


def _days(spark, sf_dir):
    return R.calendar(spark, sf_dir).select("date")


def _feature_sql(names: list[str]) -> str:
    text = calendar_feature_sql()
    cols = [f"round({text[n]}, 6) + 0.0 AS {n}" if n[:4] in ("sin_", "cos_") else f"{text[n]} AS {n}" for n in names]
    return R.with_calendar(f"SELECT date, {', '.join(cols)} FROM days")


def _calendar_query(name: str, columns: list[str]) -> None:
    @query(name, _feature_sql(columns))
    def run(spark, sf_dir):
        return R.rounded(X.add_calendar_features(_days(spark, sf_dir)).select("date", *columns))


_calendar_query("f1_day_of_week", ["day_of_week"])
_calendar_query("f2_date_parts", ["day_of_month", "day_of_year", "month", "quarter", "year"])
_calendar_query("f3_iso_week", ["week_of_year"])
_calendar_query("f4_is_weekend", ["is_weekend"])
_calendar_query("f5_month_edges", ["is_month_start", "is_month_end"])
_calendar_query("f6_quarter_edges", ["is_quarter_start", "is_quarter_end"])
_calendar_query("f7_fourier", ["sin_day_year", "cos_day_year", "sin_day_week", "cos_day_week"])


@query(
    "f8_iso_week_key",
    """SELECT o_orderkey, CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS wm_yr_wk FROM orders""",
)
def f8_iso_week_key(spark, sf_dir):
    orders = R.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", D.iso_week_key(F.to_date("o_orderdate")).alias("wm_yr_wk"))


@query(
    "f9_weekday_name",
    "SELECT dayname(o_orderdate) AS weekday, count(*) AS n_orders FROM orders GROUP BY 1",
)
def f9_weekday_name(spark, sf_dir):
    weekday = D.weekday_name(F.to_date("o_orderdate")).alias("weekday")
    return R.table(spark, sf_dir, "orders").groupBy(weekday).agg(F.count("*").alias("n_orders"))


@query(
    "f10_has_event",
    R.with_calendar("SELECT date, CAST(event_name_1 IS NOT NULL AS INTEGER) AS has_event FROM cal"),
)
def f10_has_event(spark, sf_dir):
    return X.add_event_features(R.calendar(spark, sf_dir)).select("date", "has_event")


@query(
    "f11_log_and_back",
    """SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) + 0.0 AS logged,
    round(greatest(exp(ln(1 + greatest(c_acctbal, 0))) - 1, 0), 6) + 0.0 AS back FROM customer""",
)
def f11_log_and_back(spark, sf_dir):
    logged = S.log_sales(F.col("c_acctbal"))
    return R.rounded(
        R.table(spark, sf_dir, "customer").select(
            "c_custkey", logged.alias("logged"), S.unlog_sales(logged).alias("back")
        )
    )


@query(
    "f12_series_ids",
    R.with_panel(
        """SELECT concat_ws('_', item_id, store_id, 'evaluation') AS series, split_part(store_id, '_', 1) AS state,
        count(*) AS n_days FROM sparse GROUP BY ALL"""
    ),
)
def f12_series_ids(spark, sf_dir):
    series = S.series_id(F.col("item_id"), F.col("store_id"), "evaluation").alias("series")
    state = S.state_of_store(F.col("store_id")).alias("state")
    return R.daily_sales(spark, sf_dir).groupBy(series, state).agg(F.count("*").alias("n_days"))


@query("f13_day_labels", R.with_calendar("SELECT date, d FROM cal"))
def f13_day_labels(spark, sf_dir):
    ends = R.bounds(spark, sf_dir)
    label = D.day_label(F.col("date"), ends.select("first").scalar())
    return _days(spark, sf_dir).select("date", label.alias("d"))


@query(
    "f14_price_rounding",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
    sum(CAST(round(greatest(CAST(l_extendedprice * (1 - l_discount) / 1000 AS DECIMAL(20,6)), 0.5), 2) AS DOUBLE)) AS price
    FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def f14_price_rounding(spark, sf_dir):
    raw = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1000
    price = S.round_price(raw, 0.5)
    lines = R.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return lines.agg(F.count("*").alias("n_rows"), F.sum(price).alias("price"))


_FAMILY_SQL = """CASE WHEN contains(feature, 'lag') THEN 'lag' WHEN contains(feature, 'rolling') THEN 'rolling'
  WHEN contains(feature, 'price') THEN 'price'
  WHEN regexp_matches(feature, 'sin|cos|day|week|month|year|quarter') THEN 'calendar'
  WHEN regexp_matches(feature, 'store|cat|dept|item|state') THEN 'id' ELSE 'other' END AS family"""


@query(
    "f15_feature_families",
    R.with_panel(
        f"SELECT feature, n, {_FAMILY_SQL} FROM (SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature) CROSS JOIN (SELECT count(*) AS n FROM series)"
    ),
)
def f15_feature_families(spark, sf_dir):
    """Families of the model inputs, beside the number of series they describe."""
    names = F.explode(F.array(*[F.lit(f) for f in FEATURES])).alias("feature")
    series = P.build_hierarchy_map(R.daily_sales(spark, sf_dir)).agg(F.count("*").alias("n"))
    return series.select("n", names).withColumn("family", S.feature_family(F.col("feature")))


@query(
    "f16_prefix_test",
    R.with_ship("SELECT item_id, sum(l_quantity) AS sales FROM ship WHERE starts_with(item_id, 'PROMO_r') GROUP BY item_id"),
)
def f16_prefix_test(spark, sf_dir):
    df = R.daily_sales(spark, sf_dir).filter(F.col("id").startswith("PROMO_r"))
    return Q.total_by(df, ["item_id"])
