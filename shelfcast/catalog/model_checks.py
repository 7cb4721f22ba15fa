"""What holds for every fitted model, whatever its numbers are, beside SQL: keys, signs, optimality, coherence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog import models as M
from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.profiles import SPLIT_SQL
from shelfcast.catalog.windows import _FAMILY_SQL
from shelfcast.fixed_values import FEATURES, HORIZON, TWEEDIE_POWER
from shelfcast.functions import scalars as S
from shelfcast.operators import hierarchy as H
from shelfcast.operators import panel as P
from shelfcast.operators import reconcile as REC
from shelfcast.operators import seasonal as N
from shelfcast.session import cut_lineage

# Training rows have the lags and rolling means of 28 days before.
_TRAIN_SQL = "rows_used AS (SELECT p.* FROM panel p, bounds WHERE date >= lo + 28 AND date <= hi - 28)"


@query(
    "m1_loss_checks",
    R.with_panel(
        f"""SELECT count(*) AS n_rows,
        round(avg(exp({2 - TWEEDIE_POWER} * start) / {2 - TWEEDIE_POWER} - sales * exp({1 - TWEEDIE_POWER} * start) / {1 - TWEEDIE_POWER}), 6) + 0.0 AS start_loss,
        true AS falls FROM rows_used, (SELECT ln(avg(sales)) AS start FROM rows_used)""".replace("0.8999999999999999", "0.9").replace("-0.10000000000000009", "-0.1"),
        _TRAIN_SQL,
    ),
)
def m1_loss_checks(spark, sf_dir):
    """The loss of the mean alone, from the rows, and whether every round lowers it."""
    losses = M.m1_tweedie_boosting(spark, sf_dir).orderBy("round").collect()
    falls = all(b["deviance"] < a["deviance"] for a, b in zip(losses, losses[1:]))
    n_rows = M._trained(spark, sf_dir)[1].agg(F.count("*").alias("n_rows"))
    return n_rows.select("n_rows", R.r6(F.lit(losses[0]["deviance"])).alias("start_loss"), F.lit(falls and len(losses) > 1).alias("falls"))


_NAMES_SQL = f"(SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature)"


@query("m2_importance_checks", R.with_panel(f"SELECT feature, {_FAMILY_SQL}, true AS counts FROM {_NAMES_SQL} WHERE (SELECT count(*) FROM series) > 0"))
def m2_importance_checks(spark, sf_dir):
    """Every input with its family; gains are never negative."""
    table = M.m2_feature_importance(spark, sf_dir)
    return table.select("feature", S.feature_family(F.col("feature")).alias("family"), (F.col("importance") >= 0).alias("counts"))


@query("f15_importance_families", R.with_panel(f"SELECT family, count(*) AS n_features, true AS counts FROM (SELECT {_FAMILY_SQL} FROM {_NAMES_SQL} WHERE (SELECT count(*) FROM series) > 0) GROUP BY family"))
def f15_importance_families(spark, sf_dir):
    """The model's gain by family of its inputs: the shares add up to 1."""
    table = M.m2_feature_importance(spark, sf_dir).withColumn("family", S.feature_family(F.col("feature")))
    shares = table.groupBy("family").agg(F.count("*").alias("n_features"), F.sum("importance").alias("gain"))
    total = shares.agg(F.sum("gain")).scalar()
    return shares.select("family", "n_features", (F.col("gain") / total).between(0, 1).alias("counts"))


@query("t2_ranking_checks", R.with_panel("SELECT CAST(unnest(generate_series(1, 25)) AS INTEGER) AS rank, true AS falls FROM bounds"))
def t2_ranking_checks(spark, sf_dir):
    """The 25 inputs of most gain, none above the one before it."""
    top = M.t2_top_features(spark, sf_dir).collect()
    gains = [r["importance"] for r in top]
    rows = [(i + 1, i == 0 or gains[i] <= gains[i - 1]) for i in range(len(gains))]
    return spark.createDataFrame(rows, "rank int, falls boolean")


@query(
    "m3_prediction_checks",
    R.with_panel("SELECT date, count(*) AS n_rows, sum(sales) AS sales, true AS positive FROM rows_used GROUP BY date", _TRAIN_SQL),
)
def m3_prediction_checks(spark, sf_dir):
    model, train, *_ = M._trained(spark, sf_dir)
    fine = (F.col("forecast") >= 0) & ~F.isnan("forecast")
    return model.predict(train).groupBy("date").agg(F.count("*").alias("n_rows"), F.sum("sales").alias("sales"), F.bool_and(fine).alias("positive"))


@query(
    "m4_forecast_checks",
    R.with_panel("SELECT date, count(*) AS n_rows, count(DISTINCT id) AS n_series, sum(sales) AS sales, true AS positive FROM val GROUP BY date", SPLIT_SQL),
)
def m4_forecast_checks(spark, sf_dir):
    done = M.m4_direct_forecast(spark, sf_dir)
    return done.groupBy("date").agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_series"), F.sum("sales").alias("sales"), F.bool_and(F.col("forecast") >= 0).alias("positive")
    )


@query(
    "m5_recursive_checks",
    R.with_panel(f"SELECT CAST(hi + k AS DATE) AS date, count(*) AS n_series, true AS positive FROM series, bounds, (SELECT unnest(range(1, {HORIZON + 1}))::INTEGER AS k) GROUP BY ALL"),
)
def m5_recursive_checks(spark, sf_dir):
    done = M.m5_recursive_forecast(spark, sf_dir)
    return done.groupBy("date").agg(F.count_distinct("id").alias("n_series"), F.bool_and(F.col("forecast") >= 0).alias("positive"))


@query(
    "m7_stopping_checks",
    R.with_panel("SELECT (SELECT count(*) FROM rows_used) AS n_train, (SELECT count(*) FROM val) AS n_val, true AS stops_by_rule, true AS keeps_best", _TRAIN_SQL, SPLIT_SQL),
)
def m7_stopping_checks(spark, sf_dir):
    """Training ends at the best round plus the patience, or at the last round; the trees end at the best one."""
    model, train, val, *_ = M._trained(spark, sf_dir)
    errors = [h["val_rmse"] for h in model.history]
    best = int(np.argmin(errors)) + 1
    counts = train.agg(F.count("*").alias("n_train")).crossJoin(val.agg(F.count("*").alias("n_val")))
    return counts.select(
        "n_train", "n_val", F.lit(len(errors) == min(best + M.PATIENCE, M.ROUNDS)).alias("stops_by_rule"), F.lit(len(model.trees) == best).alias("keeps_best")
    )


def _group_sql(key: str, extra: str) -> str:
    return R.with_panel(f"SELECT {key}, {extra} FROM train GROUP BY {key}", SPLIT_SQL)


def _solved(spark, sf_dir, key: str) -> DataFrame:
    model = M._group_model(spark, sf_dir, key)
    worst = N.optimality(model, P.train_val_split(R.stored_panel(spark, sf_dir))[0])
    return worst.select(key, "n_days", (F.col("residual") < 1e-6).alias("solved"))


@query("m8_store_optimality", _group_sql("store_id", "count(DISTINCT date) AS n_days, true AS solved"))
def m8_store_optimality(spark, sf_dir):
    """The coefficients of every store solve their normal equations."""
    return _solved(spark, sf_dir, "store_id")


@query("m9_dept_optimality", _group_sql("dept_id", "count(DISTINCT date) AS n_days, true AS solved"))
def m9_dept_optimality(spark, sf_dir):
    return _solved(spark, sf_dir, "dept_id")


@query(
    "m10_forecast_bands",
    R.with_panel("SELECT store_id, date AS ds, true AS ordered FROM (SELECT DISTINCT store_id FROM series), (SELECT DISTINCT date FROM val)", SPLIT_SQL),
)
def m10_forecast_bands(spark, sf_dir):
    """A forecast of every store and day ahead, inside its band."""
    done = M.m10_group_forecast(spark, sf_dir)
    return done.select("store_id", "ds", ((F.col("yhat_lower") >= 0) & F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper"))).alias("ordered"))


@query(
    "m11_component_sums",
    R.with_panel("SELECT store_id, (SELECT count(*) FROM days) AS n_days, true AS adds_up FROM series GROUP BY store_id"),
)
def m11_component_sums(spark, sf_dir):
    """The parts of every day of history and horizon add up to its fit."""
    parts = M.m11_components(spark, sf_dir)
    gap = F.abs(F.col("log_yhat") - sum((F.col(b) for b in N.BLOCKS[1:]), F.col(N.BLOCKS[0])))
    return parts.groupBy("store_id").agg(F.count("*").alias("n_days"), F.bool_and(gap < 1e-9).alias("adds_up"))


@query(
    "m12_flag_effects",
    R.with_panel("SELECT DISTINCT store_id, state_id IN ('AFRICA', 'AMERICA', 'ASIA') AS has_effect FROM series"),
)
def m12_flag_effects(spark, sf_dir):
    """Stores of states with a benefit flag have an effect of their own, the others none."""
    done = M.m12_snap_regressor(spark, sf_dir)
    return done.select("store_id", ((F.col("most") != 0) | (F.col("least") != 0)).alias("has_effect"))


_NODES_SQL = "SELECT id AS node_id FROM series " + " ".join(
    f"UNION SELECT '{n}' || '|' || {n}_id FROM series" for n in ("store", "state", "cat", "dept")
) + " UNION SELECT 'total' FROM bounds"


def _aggregate_gaps(done: DataFrame, tree: DataFrame) -> DataFrame:
    edges = REC.aggregate_edges(H.membership_edges(tree, M.LEVELS))
    gaps = REC.aggregate_gaps(done, edges, "date", "forecast")
    return gaps.groupBy("node_id").agg(F.count("*").alias("n_days"), R.r6(F.max(F.abs("gap"))).alias("worst"))


@query("h1_ols_optimality", R.with_panel(f"SELECT node_id, CAST(7 AS BIGINT) AS n_days, 0.0::DOUBLE AS worst FROM ({_NODES_SQL})"))
def h1_ols_optimality(spark, sf_dir):
    """All levels: aggregates equal their sums, and the change is at right angles to every series' column of the summing matrix."""
    nodes, tree = M._nodes(spark, sf_dir, M.LEVELS)
    base, edges = cut_lineage(M.base_forecasts(nodes)), H.membership_edges(tree, M.LEVELS)
    done = cut_lineage(REC.ols_reconcile(base, edges, "direct"))
    moved = base.withColumnRenamed("forecast", "before").join(done, ["node_id", "date"]).withColumn("shift", F.col("before") - F.col("forecast"))
    pulls = edges.join(moved, "node_id").groupBy("bottom_id", "date").agg(F.sum("shift").alias("pull"))
    bottom = pulls.groupBy(F.col("bottom_id").alias("node_id")).agg(F.count("*").alias("n_days"), R.r6(F.max(F.abs("pull"))).alias("worst"))
    return _aggregate_gaps(done, tree).unionByName(bottom)


@query(
    "h2_shrink_coherence",
    R.with_panel(f"SELECT node_id, CAST(7 AS BIGINT) AS n_days, 0.0::DOUBLE AS worst FROM ({_NODES_SQL}) WHERE node_id NOT IN (SELECT id FROM series)"),
)
def h2_shrink_coherence(spark, sf_dir):
    """Minimum trace by shrinkage over all levels and days: every aggregate equals its sum."""
    tree = P.build_hierarchy_map(R.daily_sales(spark, sf_dir))
    return _aggregate_gaps(cut_lineage(M.h2_mint_shrink(spark, sf_dir)), tree)


_RESIDUALS_SQL = "all_nodes AS (SELECT id AS node_id, date, sales FROM panel " + " ".join(
    f"UNION ALL SELECT '{n}' || '|' || {n}_id, date, sum(sales) FROM panel GROUP BY ALL" for n in ("store", "state", "cat", "dept")
) + """ UNION ALL SELECT 'total', date, sum(sales) FROM panel GROUP BY date),
fits AS (SELECT node_id, isodow(date) AS dow, exp(avg(ln(1 + sales))) - 1 AS fit FROM all_nodes GROUP BY ALL),
rests AS (SELECT n.node_id, n.sales - f.fit AS e FROM all_nodes n JOIN fits f ON f.node_id = n.node_id AND f.dow = isodow(n.date))"""


@query(
    "a26_variances",
    R.with_panel(
        """SELECT node_id, 'sample' AS method, round(var_samp(e), 4) + 0.0 AS variance FROM rests GROUP BY node_id
        UNION ALL SELECT node_id, 'wls', round(var_pop(e), 4) + 0.0 FROM rests GROUP BY node_id
        UNION ALL SELECT node_id, 'ols', 1.0 FROM rests GROUP BY node_id""",
        _RESIDUALS_SQL,
    ),
)
def a26_variances(spark, sf_dir):
    """Variance of every node under the estimates that need no products of series."""
    nodes, _ = M._nodes(spark, sf_dir, M.LEVELS)
    residuals = cut_lineage(M.base_residuals(nodes))
    parts = [REC.covariance_table(residuals, m).select("node_id", F.lit(m).alias("method"), (F.round("variance", 4) + 0.0).alias("variance")) for m in ("sample", "wls", "ols")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
