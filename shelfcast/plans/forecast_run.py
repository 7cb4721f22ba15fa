"""The whole forecasting run: preprocess, features, models, reconciliation, evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.fixed_values import HORIZON, SNAP_STATES
from shelfcast.functions.scalars import unlog_sales
from shelfcast.operators import boosting, hierarchy, metrics, ordering, panel, reshape, seasonal
from shelfcast.operators import features as X
from shelfcast.operators import reconcile as REC
from shelfcast.session import broadcast_if_small, cut_lineage


def preprocess_panel(
    long: DataFrame,
    prices: DataFrame,
    val_days: int = HORIZON,
    states: dict[str, str] = SNAP_STATES,
    narrow: bool = False,
) -> dict[str, DataFrame]:
    """Price, flag, encode and split a dated panel.

    The priced panel is written once; codes and the split read it again.
    """
    full = panel.add_snap_flag(panel.merge_prices(long, prices), states)
    labels = cut_lineage(full)
    encoders = ordering.fit_encoders(labels)
    coded = ordering.encode_labels(labels, encoders)
    if narrow:
        coded = panel.narrow_types(coded)
    train, val = panel.train_val_split(coded, val_days)
    return {
        "train": train,
        "val": val,
        "full": coded,
        "hierarchy": panel.build_hierarchy_map(labels),
        "encoders": encoders,
        "prices": prices,
    }


def preprocess(
    sales: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    val_days: int = HORIZON,
    states: dict[str, str] = SNAP_STATES,
    narrow: bool = True,
) -> dict[str, DataFrame]:
    """Wide sales, calendar and prices to train, val, full, hierarchy, encoders and prices."""
    long = panel.merge_calendar(reshape.melt_sales(sales), calendar)
    return preprocess_panel(long, prices, val_days, states, narrow)


@dataclass
class ForecastRun:
    """One run over preprocessed tables; every stage keeps its result.

    With another method than ``bottom_up`` the store models supply the store
    level of the base forecasts, so that the levels have something to settle.
    ``context_lag`` 0 lets the store and department means include the day
    itself; 28 keeps the horizon out of them. ``residual_days`` limits the
    residuals of the error covariance to the last days of training; None takes all.
    """

    processed: dict[str, DataFrame]
    val_days: int = HORIZON
    method: str = "bottom_up"
    context_lag: int = 0
    residual_days: int | None = None
    boosting: dict = field(default_factory=dict)
    holidays: DataFrame | None = None
    results: dict[str, DataFrame] = field(default_factory=dict)
    model: boosting.TweedieModel | None = None
    seasonal_model: seasonal.SeasonalModel | None = None

    def engineer_features(self) -> "ForecastRun":
        full = self.processed["full"]
        start = panel.validation_start(full, self.val_days)
        train, val = X.split_features(full, start, self.context_lag)
        self.results["train_features"] = train
        self.results["val_features"] = val
        return self

    def train_global(self, early_stopping_rounds: int = 30) -> "ForecastRun":
        val = self.results["val_features"]
        self.model = boosting.fit_tweedie(
            self.results["train_features"],
            val,
            early_stopping_rounds=early_stopping_rounds,
            **({"rounds": 200} | self.boosting),
        )
        forecasts = self.model.predict(val).select("id", "date", "forecast")
        self.results["forecasts"] = cut_lineage(forecasts)
        return self

    def train_seasonal(self) -> "ForecastRun":
        train = ordering.decode_labels(
            self.processed["train"], self.processed["encoders"], "store_id", "store_id_label"
        )
        self.seasonal_model = seasonal.fit_groups(train, "store_id_label", self.holidays)
        self.results["store_forecasts"] = self.seasonal_model.predict(self.val_days)
        return self

    def reconcile(self) -> "ForecastRun":
        forecasts, tree = self.results["forecasts"], self.processed["hierarchy"]
        if self.method == "bottom_up":
            self.results["reconciled"] = hierarchy.bottom_up(forecasts, tree)
            return self
        keyed = hierarchy.with_hierarchy(forecasts, tree)
        levels = hierarchy.DEFAULT_EDGE_LEVELS
        base = REC.node_table(keyed, "forecast", levels)
        history = hierarchy.with_hierarchy(self.processed["train"].select("id", "date", "sales"), tree)
        nodes = cut_lineage(REC.node_table(history, "sales", levels))
        residuals = REC.naive_residuals(nodes, self.residual_days)
        if self.seasonal_model is not None:
            base = self._store_level(base, self.results["store_forecasts"], F.col("yhat"), "forecast")
            residuals = self._store_residuals(residuals, nodes)
        done = REC.reconcile(self.method, base, tree, levels, history, residuals)
        bottom = done.withColumnRenamed("node_id", "id").join(tree.select("id"), "id", "left_semi")
        self.results["reconciled"] = hierarchy.bottom_up(bottom, tree)
        return self

    def _store_level(self, nodes: DataFrame, stores: DataFrame, value: Column, name: str) -> DataFrame:
        """Nodes with the store rows taken from the seasonal models where those exist.

        The seasonal models hold one row per store and day and are counted.
        """
        node = F.concat_ws(hierarchy.NODE_SEPARATOR, F.lit("store"), self.seasonal_model.group_col)
        own = cut_lineage(stores.select(node.alias("node_id"), F.col("ds").alias("date"), value.alias("_own")))
        joined = nodes.join(broadcast_if_small(own, own.count()), ["node_id", "date"], "left")
        return joined.withColumn(name, F.coalesce("_own", name)).drop("_own")

    def _store_residuals(self, residuals: DataFrame, nodes: DataFrame) -> DataFrame:
        """Residuals with those of the store models in place of one-day changes."""
        fitted = self.seasonal_model.components(0)
        marked = nodes.withColumn("fit", F.lit(None).cast("double"))
        both = self._store_level(marked, fitted, unlog_sales(F.col("log_yhat")), "fit")
        own = both.filter(F.col("fit").isNotNull()).select(
            "node_id", F.datediff("date", F.lit("1970-01-01")).alias("t"), (F.col("sales") - F.col("fit")).alias("_own")
        )
        joined = residuals.join(own, ["node_id", "t"], "left")
        return cut_lineage(joined.select("node_id", "t", F.coalesce("_own", "residual").alias("residual")))

    def evaluate(self) -> "ForecastRun":
        """Reports of the model and the naive forecast, and the weighted scaled error.

        Keys are the labels of the hierarchy map; revenue takes the mean of the price table's weeks.
        """
        tree = self.processed["hierarchy"]
        val = hierarchy.with_hierarchy(self.processed["val"].select("id", "date", "sales"), tree)
        train = self.processed["train"].select("id", "date", "sales")
        forecasts = self.results["forecasts"]
        naive = metrics.naive_baseline(val, train)
        self.results["summary"] = metrics.evaluate_forecasts(val, forecasts)
        self.results["naive_summary"] = metrics.evaluate_forecasts(val, naive)
        self.results["improvement"] = metrics.improvement(
            self.results["summary"], self.results["naive_summary"]
        )
        self.results["by_level"] = metrics.evaluate_levels(val, forecasts, ["store_id", "cat_id", "dept_id"])
        weights = metrics.revenue_weights(hierarchy.with_hierarchy(train, tree), self.processed["prices"])
        self.results["wrmsse"] = metrics.wrmsse(val, forecasts, train, weights)
        return self

    def run(self) -> "ForecastRun":
        return self.engineer_features().train_global().train_seasonal().reconcile().evaluate()
