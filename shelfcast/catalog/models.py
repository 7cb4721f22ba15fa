"""Models, recursive forecast and reconciliation: queries M, H, S4 and T2."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.data import _LABELS_SQL
from shelfcast.catalog.profiles import OFF_EDGE, calendar_feature_sql, lag_sql, profile, profile_sql, rolling_sql
from shelfcast.catalog.windows import PRICE_FEATURES_SQL
from shelfcast.fixed_values import FEATURES, HORIZON, ID_COLUMNS, LAGS, WINDOWS
from shelfcast.operators import boosting as G
from shelfcast.operators import features as X
from shelfcast.operators import hierarchy as H
from shelfcast.operators import ordering as O
from shelfcast.operators import panel as P
from shelfcast.operators import recursive as V
from shelfcast.operators import reconcile as REC
from shelfcast.operators import reshape
from shelfcast.operators import seasonal as N
from shelfcast.plans.forecast_run import preprocess, preprocess_panel
from shelfcast.session import cut_lineage, shared_folder
from shelfcast.sources import calendar as C

ROUNDS = 30
DEPTH = 5
PATIENCE = 5
_fitted: dict[tuple, tuple] = {}


def _trained(spark, sf_dir):
    """(model, training and validation features, panel, encoders), fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fitted:
        sold = R.sold_days(spark, sf_dir)
        done = preprocess_panel(R.dated_panel_of(spark, sf_dir, sold), R.prices_of(sold), states=R.STATE_FLAGS)
        full = done["full"]
        train, val = X.split_features(full, P.validation_start(full), context_lag=28)
        model = G.fit_tweedie(train, val, early_stopping_rounds=PATIENCE, rounds=ROUNDS, max_depth=DEPTH, learning_rate=0.15)
        _fitted[key] = (model, train, val, full, done["encoders"])
    return _fitted[key]


@query("m1_tweedie_boosting")
def m1_tweedie_boosting(spark, sf_dir):
    """Tweedie loss of the training rows before the first round and after each."""
    model, train, *_ = _trained(spark, sf_dir)
    start = train.agg(G.deviance(F.col("sales"), F.lit(model.start)).alias("deviance")).select(F.lit(0).alias("round"), "deviance")
    rounds = G.history_table(model, spark).select("round", F.col("train_loss").alias("deviance"))
    return start.unionByName(rounds)


@query("m2_feature_importance")
def m2_feature_importance(spark, sf_dir):
    return _trained(spark, sf_dir)[0].importance_table(spark)


@query("t2_top_features")
def t2_top_features(spark, sf_dir):
    return G.top_features(_trained(spark, sf_dir)[0].importance_table(spark), 25)


@query("m3_batch_prediction")
def m3_batch_prediction(spark, sf_dir):
    """Predictions of every training row, totalled by day."""
    model, train, *_ = _trained(spark, sf_dir)
    return model.predict(train).groupBy("date").agg(
        F.sum("sales").alias("sales"), F.sum("forecast").alias("forecast"), F.min("forecast").alias("lowest")
    )


@query("m4_direct_forecast")
def m4_direct_forecast(spark, sf_dir):
    model, _, val, *_ = _trained(spark, sf_dir)
    return model.predict(val).select(*ID_COLUMNS, "date", "sales", "forecast")


@query("m5_recursive_forecast")
def m5_recursive_forecast(spark, sf_dir):
    """28 days from the last one on, with the events and benefit flags of their own dates."""
    model, _, _, full, encoders = _trained(spark, sf_dir)
    last = full.groupBy("id").agg(F.max_by(F.struct(*ID_COLUMNS[1:], "sell_price", "snap"), "date").alias("l"))
    series = last.select("id", "l.*").withColumn("has_event", F.lit(0))
    series = O.decode_labels(series, encoders, "state_id", "state_label")
    ahead = R.coming_calendar(spark, sf_dir, HORIZON)
    return V.recursive_forecast(model.predict, series, full, HORIZON, ahead, R.STATE_FLAGS, "state_label")


@query("m7_early_stopping")
def m7_early_stopping(spark, sf_dir):
    return G.history_table(_trained(spark, sf_dir)[0], spark)


@query(
    "s4_model_persistence",
    R.with_panel(
        """SELECT 'trees' AS model, count(*) AS n_rows, 0.0::DOUBLE AS max_gap FROM panel, bounds WHERE date > hi - 28
        UNION ALL SELECT 'seasons', 28 * count(DISTINCT store_id), 0.0 FROM series"""
    ),
)
def s4_model_persistence(spark, sf_dir):
    """Largest difference between the forecasts of both kinds of model before and after a round trip."""
    model, _, val, *_ = _trained(spark, sf_dir)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.save(spark, f"{path}/trees")
    again = G.TweedieModel.load(spark, f"{path}/trees").predict(val)
    groups = _group_model(spark, sf_dir, "store_id")
    groups.save(f"{path}/seasons")
    later = N.SeasonalModel.load(spark, f"{path}/seasons").predict(28)

    def compared(name, before, after, keys, value):
        both = before.select(*keys, F.col(value).alias("a")).join(after.select(*keys, F.col(value).alias("b")), keys)
        return both.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_gap"))

    trees = compared("trees", model.predict(val), again, ["id", "date"], "forecast")
    return trees.unionByName(compared("seasons", groups.predict(28), later, ["store_id", "ds"], "yhat"))


def _rolling_day_sql() -> str:
    parts = [f"coalesce(max(CASE WHEN ago = {n} THEN sales END), 0.0) AS sales_lag_{n}" for n in LAGS]
    for k in WINDOWS:
        inside = f"CASE WHEN ago >= 28 AND ago < {28 + k} THEN sales END"
        parts += [
            f"round(coalesce(avg({inside}), 0.0), 6) + 0.0 AS rolling_mean_{k}",
            f"round(coalesce(stddev_samp({inside}), 0.0), 6) + 0.0 AS rolling_std_{k}",
        ]
    return ", ".join(parts)


def _inference_sql() -> str:
    text = calendar_feature_sql("(hi + 1)")
    cal = ", ".join(
        f"round({e}, 6) + 0.0 AS {n}" if n[:4] in ("sin_", "cos_") else f"{e} AS {n}" for n, e in text.items()
    )
    return f"""SELECT id, hi + 1 AS date, {cal}, t.* EXCLUDE (id),
      round(s.m, 6) + 0.0 AS store_daily_mean, round(d.m, 6) + 0.0 AS dept_daily_mean
      FROM series JOIN (SELECT id, {_rolling_day_sql()} FROM (
          SELECT id, sales, (SELECT hi + 1 FROM bounds) - date AS ago FROM panel) GROUP BY id) t USING (id)
      JOIN (SELECT store_id, avg(sales) AS m FROM panel WHERE date >= (SELECT hi FROM bounds) - 7 GROUP BY 1) s USING (store_id)
      JOIN (SELECT dept_id, avg(sales) AS m FROM panel WHERE date >= (SELECT hi FROM bounds) - 7 GROUP BY 1) d USING (dept_id)
      CROSS JOIN bounds"""


@query("m6_inference_features", R.with_panel(_inference_sql()))
def m6_inference_features(spark, sf_dir):
    """Inputs of the day after the last one, for every series."""
    history = R.stored_panel(spark, sf_dir)
    last = R.bounds(spark, sf_dir).first()[1]
    series = P.build_hierarchy_map(history).withColumns({"sell_price": F.lit(1.0), "snap": F.lit(0)})
    frame = V.inference_features(series, history, last + timedelta(days=1))
    columns = list(calendar_feature_sql()) + [f"sales_lag_{n}" for n in LAGS]
    columns += [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]
    return R.rounded(frame.select("id", "date", *columns, "store_daily_mean", "dept_daily_mean"))


_NUMERIC = [c for c in FEATURES if c not in ID_COLUMNS]


def _features_sql() -> str:
    text = calendar_feature_sql()
    skip = ("month", "year")
    cal = ", ".join(f"{e} AS {n}" for n, e in text.items() if n not in skip)
    windowed = ", ".join(lag_sql(LAGS) + rolling_sql(WINDOWS))
    return f"""with_lags AS (
      SELECT *, CAST(event_name_1 IS NOT NULL AS INTEGER) AS has_event, {cal}, {windowed},
        avg(sales) OVER (PARTITION BY store_id, date) AS store_daily_mean,
        avg(sales) OVER (PARTITION BY dept_id, date) AS dept_daily_mean
      FROM price_features WINDOW w AS (PARTITION BY id ORDER BY date)),
    features AS (SELECT * FROM with_lags WHERE sales_lag_28 IS NOT NULL AND rolling_mean_28 IS NOT NULL)"""


@query(
    "m13_build_features",
    R.with_priced(profile_sql("features", _NUMERIC, ["id"]), PRICE_FEATURES_SQL, _features_sql()),
)
def m13_build_features(spark, sf_dir):
    """All model inputs but the codes, averaged over the days of each series."""
    return profile(X.build_features(cut_lineage(R.priced_panel(spark, sf_dir))), _NUMERIC, ["id"])




@query(
    "m14_preprocess",
    R.with_priced(
        """SELECT part, k1.code AS item_id, k2.code AS store_id, count(*) AS n_rows, sum(sales) AS sales,
        CAST(sum(snap) AS BIGINT) AS snap, round(avg(sell_price) + 1.1e-8, 6) + 0.0 AS sell_price,
        min(date) AS first_day, max(date) AS last_day FROM (
          SELECT *, CASE WHEN date < (SELECT hi - 27 FROM bounds) THEN 'train' ELSE 'val' END AS part FROM priced)
        JOIN codes k1 ON k1.col = 'item_id' AND k1.label = item_id
        JOIN codes k2 ON k2.col = 'store_id' AND k2.label = store_id GROUP BY ALL""",
        _LABELS_SQL,
    ),
)
def m14_preprocess(spark, sf_dir):
    done = preprocess_panel(R.dated_panel(spark, sf_dir), R.prices(spark, sf_dir), states=R.STATE_FLAGS)
    return _sized(done, "train").unionByName(_sized(done, "val"))


def _sized(done: dict, name: str, digits: int = 6) -> DataFrame:
    """Counts and totals of one part by item and store."""
    return done[name].groupBy("item_id", "store_id").agg(
        F.lit(name).alias("part"),
        F.count("*").alias("n_rows"),
        F.sum(F.col("sales").cast("double")).alias("sales"),
        F.sum("snap").alias("snap"),
        (F.round(F.avg("sell_price") + OFF_EDGE, digits) + 0.0).alias("sell_price"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
    )


@query(
    "m14_from_wide",
    R.with_priced(
        """SELECT part, k1.code AS item_id, k2.code AS store_id, count(*) AS n_rows, sum(sales) AS sales,
        CAST(sum(snap) AS BIGINT) AS snap, round(avg(CAST(CAST(sell_price AS FLOAT) AS DOUBLE)) + 1.1e-8, 5) + 0.0 AS sell_price,
        min(date) AS first_day, max(date) AS last_day FROM (
          SELECT *, CASE WHEN date < (SELECT hi - 27 FROM bounds) THEN 'train' ELSE 'val' END AS part FROM priced)
        JOIN codes k1 ON k1.col = 'item_id' AND k1.label = item_id
        JOIN codes k2 ON k2.col = 'store_id' AND k2.label = store_id GROUP BY ALL""",
        _LABELS_SQL,
    ),
)
def m14_from_wide(spark, sf_dir):
    """The whole preparation: wide sales, melt, day labels, prices, flags, codes, narrow types, split."""
    first, last = R.bounds(spark, sf_dir).first()
    wide = cut_lineage(reshape.widen_sales(R.panel(spark, sf_dir), (last - first).days + 1))
    done = preprocess(wide, R.calendar(spark, sf_dir), R.prices(spark, sf_dir), states=R.STATE_FLAGS)
    return _sized(done, "train", 5).unionByName(_sized(done, "val", 5))


def store_flags(stores: DataFrame, calendar: DataFrame) -> DataFrame:
    """(store_id, date, snap) of each store by its state's flag; stores without a flag have no rows."""
    own = [F.struct(F.lit(state).alias("state_id"), F.col(flag).alias("snap")) for state, flag in R.STATE_FLAGS.items()]
    days = calendar.select("date", F.explode(F.array(*own)).alias("f")).select("date", "f.*")
    return stores.select("store_id", "state_id").distinct().join(days, "state_id").select("store_id", "date", "snap")


def _group_model(spark, sf_dir, group: str, snap: bool = False):
    df = P.train_val_split(R.stored_panel(spark, sf_dir))[0]
    holidays = C.holidays_of(R.events(spark, sf_dir))
    flags = store_flags(df, R.calendar(spark, sf_dir)) if snap else None
    return N.fit_groups(df, group, holidays, flags)


@query("m8_store_season_fit")
def m8_store_season_fit(spark, sf_dir):
    """Coefficient count and residual deviation of each store's model."""
    model = _group_model(spark, sf_dir, "store_id")
    return model.coefficients.select("store_id", F.size("beta").alias("n_inputs"), "sigma")


@query("m9_dept_season_fit")
def m9_dept_season_fit(spark, sf_dir):
    model = _group_model(spark, sf_dir, "dept_id")
    return model.coefficients.select("dept_id", F.size("beta").alias("n_inputs"), "sigma")


@query("m10_group_forecast")
def m10_group_forecast(spark, sf_dir):
    return _group_model(spark, sf_dir, "store_id").predict(28)


@query("m11_components")
def m11_components(spark, sf_dir):
    return _group_model(spark, sf_dir, "store_id").components(28)


@query("m12_snap_regressor")
def m12_snap_regressor(spark, sf_dir):
    """The benefit flag's own part of each store's forecast."""
    scored = _group_model(spark, sf_dir, "store_id", snap=True).components(0)
    return scored.groupBy("store_id").agg(F.max("regressors").alias("most"), F.min("regressors").alias("least"))


LEVELS = ["store", "state", "cat", "dept", "total"]


def _nodes(spark, sf_dir, levels):
    panel = R.stored_panel(spark, sf_dir)
    return cut_lineage(REC.node_table(panel, "sales", levels)), P.build_hierarchy_map(panel)


def base_forecasts(nodes: DataFrame) -> DataFrame:
    """Mean log sales of the same weekday over eight weeks, by node: not coherent."""
    end = nodes.agg(F.max("date")).scalar()
    recent = nodes.filter(F.col("date") > F.date_sub(end, 56))
    level = recent.groupBy("node_id", F.weekday("date").alias("dow")).agg(F.avg(F.log1p("sales")).alias("m"))
    return level.select(
        "node_id", F.date_add(end, F.pmod(F.col("dow") - F.weekday(end) - 1, F.lit(7)) + 1).alias("date"),
        F.expm1("m").alias("forecast"),
    )


def base_residuals(nodes: DataFrame) -> DataFrame:
    """What the weekday means of all days leave of them: (node_id, t, residual)."""
    days = nodes.withColumn("dow", F.weekday("date"))
    level = days.groupBy("node_id", "dow").agg(F.expm1(F.avg(F.log1p("sales"))).alias("fit"))
    t = F.datediff("date", F.lit("1970-01-01")).alias("t")
    return days.join(level, ["node_id", "dow"]).select(
        "node_id", t, (F.col("sales") - F.col("fit")).alias("residual")
    )


_BASE_SQL = """
base_nodes AS (
  SELECT id AS node_id, date, sales FROM panel UNION ALL SELECT 'total', date, sum(sales) FROM panel GROUP BY date
),
base AS (
  SELECT node_id, CAST(isodow(date) - 1 AS INTEGER) AS dow, exp(avg(ln(1 + sales))) - 1 AS forecast FROM base_nodes
  WHERE date > (SELECT hi FROM bounds) - 56 GROUP BY ALL
),
gap AS (
  SELECT dow, sum(CASE WHEN node_id = 'total' THEN forecast ELSE -forecast END) AS gap,
    count(*) AS n FROM base GROUP BY dow
)"""


@query(
    "h1_ols_two_levels",
    R.with_panel(
        """SELECT node_id, dow, round(forecast + CASE WHEN node_id = 'total' THEN -gap / n ELSE gap / n END, 6) + 0.0 AS forecast
        FROM base JOIN gap USING (dow)""",
        _BASE_SQL,
    ),
)
def h1_ols_two_levels(spark, sf_dir):
    """Series and total only, where the projection spreads the gap evenly."""
    nodes, tree = _nodes(spark, sf_dir, ["total"])
    done = REC.ols_reconcile(base_forecasts(nodes), H.membership_edges(tree, ["total"]), "direct")
    return R.rounded(done.select("node_id", F.weekday("date").alias("dow"), "forecast"))


@query("h1_ols_all_levels")
def h1_ols_all_levels(spark, sf_dir):
    nodes, tree = _nodes(spark, sf_dir, LEVELS)
    return REC.ols_reconcile(base_forecasts(nodes), H.membership_edges(tree, LEVELS), "direct")


@query(
    "h2_mint_wls_two_levels",
    R.with_panel(
        """SELECT node_id, dow, round(forecast + CASE WHEN node_id = 'total' THEN -v ELSE v END * gap / (SELECT sum(v) FROM vars), 6) + 0.0 AS forecast
        FROM base JOIN gap USING (dow) JOIN vars USING (node_id)""",
        _BASE_SQL,
        """vars AS (SELECT node_id, var_pop(e) AS v FROM (
            SELECT node_id, date, sales - lag(sales) OVER (PARTITION BY node_id ORDER BY date) AS e FROM base_nodes)
            WHERE e IS NOT NULL GROUP BY node_id)""",
    ),
)
def h2_mint_wls_two_levels(spark, sf_dir):
    nodes, tree = _nodes(spark, sf_dir, ["total"])
    residuals = REC.naive_residuals(nodes)
    done = REC.mint_reconcile(base_forecasts(nodes), H.membership_edges(tree, ["total"]), residuals, "wls", "direct")
    return R.rounded(done.select("node_id", F.weekday("date").alias("dow"), "forecast"))


@query("h2_mint_shrink")
def h2_mint_shrink(spark, sf_dir):
    nodes, tree = _nodes(spark, sf_dir, LEVELS)
    residuals = cut_lineage(base_residuals(nodes))
    return REC.mint_reconcile(base_forecasts(nodes), H.membership_edges(tree, LEVELS), residuals, "shrink", "direct")


_AGGREGATES_SQL = " + ".join(f"count(DISTINCT {n}_id)" for n in ("store", "state", "cat", "dept")) + " + 1"


@query(
    "h3_strategy_gaps",
    R.with_panel(
        f"""SELECT method, true AS coherent, 7 * (SELECT {_AGGREGATES_SQL} FROM series) AS n_rows
        FROM (SELECT unnest(['bottom_up', 'top_down', 'ols', 'mint']) AS method)"""
    ),
)
def h3_strategy_gaps(spark, sf_dir):
    """Largest incoherence left by each strategy; all are near zero."""
    nodes, tree = _nodes(spark, sf_dir, LEVELS)
    history = R.stored_panel(spark, sf_dir)
    base, residuals = cut_lineage(base_forecasts(nodes)), cut_lineage(base_residuals(nodes))
    edges = REC.aggregate_edges(H.membership_edges(tree, LEVELS))
    out = None
    for method in REC.METHODS:
        done = REC.reconcile(method, base, tree, LEVELS, history, residuals, solver="direct")
        worst = REC.aggregate_gaps(done, edges, "date", "forecast").agg(
            F.max(F.abs("gap")).alias("max_gap"), F.count("*").alias("n_rows")
        )
        row = worst.select(F.lit(method).alias("method"), (F.col("max_gap") < 1e-6).alias("coherent"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query("a26_covariance")
def a26_covariance(spark, sf_dir):
    nodes, _ = _nodes(spark, sf_dir, LEVELS)
    residuals = cut_lineage(base_residuals(nodes))
    parts = [
        REC.covariance_table(residuals, m).withColumn("method", F.lit(m)) for m in ("shrink", "sample", "wls", "ols")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
