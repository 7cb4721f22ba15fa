"""Trend, season and holiday models of grouped daily totals.

Sales of a group and day are modelled on the log scale as a sum of a piecewise
linear trend, yearly and weekly Fourier terms, holiday effects and optional
regressors, with normal priors on the coefficients. All groups are fitted in
one job: tasks add up products of the inputs, and only these sums meet for each group.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.fixed_values import HORIZON, SEASONAL_DEFAULTS
from shelfcast.functions import dates as D
from shelfcast.functions.scalars import log_sales, unlog_sales
from shelfcast.operators.events import holiday_days
from shelfcast.session import cut_lineage

BLOCKS = ["trend", "yearly", "weekly", "holidays", "regressors"]


def prepare_series(df: DataFrame, group_col: str) -> DataFrame:
    """Daily totals of every group on the log scale: group, ds, y."""
    daily = df.groupBy(group_col, F.col("date").alias("ds")).agg(F.sum("sales").alias("total"))
    return daily.select(group_col, "ds", log_sales(F.col("total")).alias("y"))


@dataclass
class Design:
    """Layout of the model inputs of one day."""

    first: date
    last: date
    params: dict = field(default_factory=lambda: dict(SEASONAL_DEFAULTS))
    holiday_keys: list[str] = field(default_factory=list)
    regressors: list[str] = field(default_factory=list)

    def sizes(self) -> dict[str, int]:
        p = self.params
        return {
            "trend": 2 + p["changepoints"],
            "yearly": 2 * p["yearly_order"],
            "weekly": 2 * p["weekly_order"],
            "holidays": len(self.holiday_keys),
            "regressors": len(self.regressors),
        }

    def prior_widths(self) -> list[float]:
        """Standard deviation of each coefficient; level and slope are nearly free."""
        p, n = self.params, self.sizes()
        return (
            [1e3, 5.0]
            + [p["changepoint_prior"]] * p["changepoints"]
            + [p["seasonality_prior"]] * (n["yearly"] + n["weekly"])
            + [p["holiday_prior"]] * (n["holidays"] + n["regressors"])
        )

    def inputs(self) -> Column:
        """The input array of a row with ``ds``, ``holiday_keys`` and the regressors."""
        p, ds = self.params, F.col("ds")
        span = max((self.last - self.first).days, 1)
        t = F.datediff(ds, F.lit(self.first)) / F.lit(float(span))
        knots = [p["changepoint_range"] * (i + 1) / (p["changepoints"] + 1) for i in range(p["changepoints"])]
        parts = [F.lit(1.0), t, *[F.greatest(t - k, F.lit(0.0)) for k in knots]]
        day = F.datediff(ds, F.lit("1970-01-01")).cast("double")
        parts += D.fourier(day, D.YEAR_LENGTH, p["yearly_order"]) if p["yearly_order"] else []
        parts += D.fourier(day, D.WEEK_LENGTH, p["weekly_order"]) if p["weekly_order"] else []
        held = F.col("holiday_keys")
        parts += [F.coalesce(F.array_contains(held, k), F.lit(False)).cast("double") for k in self.holiday_keys]
        parts += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.regressors]
        return F.array(*parts)

    def day_inputs(
        self, days: DataFrame, holidays: DataFrame | None, regressors: DataFrame | None, keys: list[str]
    ) -> DataFrame:
        """``keys`` and x for distinct keys: ds, and the group if regressors have one row per group and day."""
        if holidays is not None:
            keyed = holiday_days(holidays).groupBy(F.col("date").alias("ds"))
            key = F.concat_ws("|", "holiday", F.col("day_offset").cast("string"))
            days = days.join(F.broadcast(keyed.agg(F.collect_set(key).alias("holiday_keys"))), "ds", "left")
        else:
            days = days.withColumn("holiday_keys", F.lit(None).cast("array<string>"))
        if self.regressors:
            extra = regressors.withColumnRenamed("date", "ds").select(*keys, *self.regressors)
            days = days.join(F.broadcast(extra) if keys == ["ds"] else extra, keys, "left")
        return days.select(*keys, self.inputs().alias("x"))


def input_keys(group_col: str, regressors: DataFrame | None) -> list[str]:
    """What the inputs depend on: the day, and the group where the regressors name it."""
    return [group_col, "ds"] if regressors is not None and group_col in regressors.columns else ["ds"]


def holiday_columns(holidays: DataFrame | None) -> list[str]:
    """One input per holiday name and distance; as many as there are names."""
    if holidays is None:
        return []
    windows = holidays.groupBy("holiday").agg(F.min("lower_window"), F.max("upper_window")).collect()
    return [f"{name}|{k}" for name, lower, upper in sorted(windows) for k in range(lower, upper + 1)]


def moments(rows: DataFrame, group_col: str, width: int) -> DataFrame:
    """Sums of the products of (inputs, y) by group: rows (group, i, products) of the symmetric matrix, with its y last.

    Tasks add up their own rows and Spark their sums, so no task needs all rows of a group. The row behind the
    matrix holds the largest size of y.
    """
    kind = dict(rows.dtypes)[group_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            groups = np.array(batch.column(0).to_pylist(), dtype=object)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            z = np.column_stack([batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width), y])
            for group in dict.fromkeys(groups.tolist()):
                own = z[groups == group] if group is not None else z[[g is None for g in groups]]
                held = total.setdefault(group, [np.zeros((width + 1, width + 1)), 0.0])
                held[0] += own.T @ own
                held[1] = max(held[1], float(np.abs(own[:, -1]).max()))
        for group, (products, largest) in total.items():
            rows_ = [*products, np.append(largest, np.zeros(width))]
            columns = [pa.array([group] * len(rows_), batch.schema.field(0).type), pa.array(range(len(rows_)), pa.int32()), pa.array([r.tolist() for r in rows_])]
            yield pa.RecordBatch.from_arrays(columns, [group_col, "i", "products"])

    parts = rows.select(group_col, "x", "y").mapInArrow(run, f"{group_col} {kind}, i int, products array<double>")
    return parts.select(group_col, "i", F.posexplode("products").alias("j", "v")).groupBy(group_col, "i", "j").agg(
        F.when(F.col("i") > width, F.max("v")).otherwise(F.sum("v")).alias("v")
    )


def solve_moments(products: np.ndarray, largest: float, widths: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Coefficients under normal priors, residual deviation and the noise level that the priors were weighed by.

    The noise level, as a share of the largest y, is found by repeated fits; the first input is constant, so sums
    stand beside it.
    """
    scale = max(largest, 1e-12)
    gram, target, squares, n = products[:-1, :-1], products[:-1, -1] / scale, products[-1, -1] / scale**2, products[0, 0]
    noise = 0.1
    for _ in range(5):
        used = max(noise, 1e-6)
        beta = np.linalg.lstsq(gram + np.diag(used**2 / widths**2), target, rcond=None)[0]
        rest = squares - 2 * beta @ target + beta @ gram @ beta
        mean = (target[0] - gram[0] @ beta) / n
        noise = float(np.sqrt(max(rest / n - mean**2, 0.0)))
    return beta * scale, noise * scale, used


@dataclass
class SeasonalModel:
    """Fitted groups: one row (group, beta, sigma) each."""

    group_col: str
    design: Design
    coefficients: DataFrame
    holidays: DataFrame | None = None
    regressors: DataFrame | None = None

    def _scored(self, days: DataFrame) -> DataFrame:
        """Rows (group, ds) with the log-scale sum of every block."""
        keys = input_keys(self.group_col, self.regressors)
        inputs = self.design.day_inputs(days.select(*keys).distinct(), self.holidays, self.regressors, keys)
        inputs = F.broadcast(inputs) if keys == ["ds"] else inputs
        rows = days.join(inputs, keys).join(self.coefficients, self.group_col)
        terms = F.zip_with("beta", "x", lambda b, v: b * v)
        start, blocks = 1, {}
        for name, n in self.design.sizes().items():
            part = F.slice("_terms", start, n)
            blocks[name] = F.aggregate(part, F.lit(0.0), lambda a, v: a + v) if n else F.lit(0.0)
            start += n
        rows = rows.withColumn("_terms", terms).withColumns(blocks)
        log_total = sum((F.col(b) for b in BLOCKS[1:]), F.col(BLOCKS[0]))
        return rows.withColumn("log_yhat", log_total).drop("_terms", "beta", "x", "noise")

    def _dates(self, start: date, days: int) -> DataFrame:
        span = F.sequence(F.lit(start), F.date_add(F.lit(start), days - 1), F.expr("interval 1 day"))
        return self.coefficients.select(self.group_col, F.explode(span).alias("ds"))

    def predict(self, horizon: int = HORIZON) -> DataFrame:
        """The days after the history, back on the sales scale, with an 80 % band."""
        future = date.fromordinal(self.design.last.toordinal() + 1)
        band = self.design.params["interval_z"] * F.col("sigma")
        return self._scored(self._dates(future, horizon)).select(
            self.group_col,
            "ds",
            unlog_sales(F.col("log_yhat")).alias("yhat"),
            unlog_sales(F.col("log_yhat") - band).alias("yhat_lower"),
            unlog_sales(F.col("log_yhat") + band).alias("yhat_upper"),
            "trend",
            "weekly",
            "yearly",
        )

    def components(self, horizon: int = HORIZON) -> DataFrame:
        """Log-scale blocks over the history and the horizon."""
        days = (self.design.last - self.design.first).days + 1 + horizon
        return self._scored(self._dates(self.design.first, days)).select(
            self.group_col, "ds", "log_yhat", *BLOCKS
        )

    def save(self, path: str) -> None:
        spec = asdict(self.design) | {"first": str(self.design.first), "last": str(self.design.last)}
        spec["group_col"] = self.group_col
        spark = self.coefficients.sparkSession
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        spark.createDataFrame([(json.dumps(spec),)], "spec string").write.mode("overwrite").json(f"{path}/spec")
        for name in ("holidays", "regressors"):
            if getattr(self, name) is not None:
                getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SeasonalModel":
        spec = json.loads(spark.read.schema("spec string").json(f"{path}/spec").first()[0])
        group_col = spec.pop("group_col")
        design = Design(date.fromisoformat(spec.pop("first")), date.fromisoformat(spec.pop("last")), **spec)
        stored = lambda name, used: spark.read.parquet(f"{path}/{name}") if used else None
        return cls(
            group_col,
            design,
            spark.read.parquet(f"{path}/coefficients"),
            stored("holidays", design.holiday_keys),
            stored("regressors", design.regressors),
        )


def fit_groups(
    df: DataFrame,
    group_col: str,
    holidays: DataFrame | None = None,
    regressors: DataFrame | None = None,
    **params,
) -> SeasonalModel:
    """One model per value of ``group_col``; groups with too few days are left out.

    ``regressors`` has a ``date`` column and one column per regressor, and must
    cover the forecast days too. With the group column it has a row per group and
    day; a group or day without one has 0.
    """
    series = prepare_series(df, group_col)
    first, last = df.agg(F.min("date"), F.max("date")).first()
    names = [c for c in regressors.columns if c not in ("date", group_col)] if regressors is not None else []
    design = Design(first, last, SEASONAL_DEFAULTS | params, holiday_columns(holidays), names)
    keys = input_keys(group_col, regressors)
    inputs = design.day_inputs(series.select(*keys).distinct(), holidays, regressors, keys)
    widths, least = np.array(design.prior_widths()), design.params["min_days"]
    kind = dict(df.dtypes)[group_col]

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        products = np.zeros((len(widths) + 2, len(widths) + 1))
        products[rows["i"], rows["j"]] = rows["v"]
        if products[0, 0] < least:
            return pd.DataFrame({group_col: [], "beta": [], "sigma": [], "noise": []}, dtype=object)
        beta, sigma, noise = solve_moments(products[:-1], products[-1, 0], widths)
        return pd.DataFrame({group_col: [key[0]], "beta": [beta], "sigma": [sigma], "noise": [noise]})

    rows = series.join(F.broadcast(inputs) if keys == ["ds"] else inputs, keys)
    # A group has as many moments as inputs squared, however many days it has.
    fitted = moments(rows, group_col, len(widths)).groupBy(group_col).applyInPandas(
        fit, f"{group_col} {kind}, beta array<double>, sigma double, noise double"
    )
    # Stored, so that prediction, components and saving do not fit again.
    return SeasonalModel(group_col, design, cut_lineage(fitted), holidays, regressors)


def optimality(model: SeasonalModel, df: DataFrame) -> DataFrame:
    """(group, n_days, residual): how far each group's coefficients are from solving their normal equations.

    The largest entry of X'(y - Xb) - penalty b, as a share of the largest of X'y.
    """
    group, keys = model.group_col, input_keys(model.group_col, model.regressors)
    series = prepare_series(df, group)
    inputs = model.design.day_inputs(series.select(*keys).distinct(), model.holidays, model.regressors, keys)
    rows = series.join(F.broadcast(inputs) if keys == ["ds"] else inputs, keys).join(model.coefficients, group)
    fit = F.aggregate(F.zip_with("beta", "x", lambda b, v: b * v), F.lit(0.0), lambda a, v: a + v)
    rows = rows.withColumn("width", F.array(*[F.lit(w) for w in model.design.prior_widths()]))
    terms = rows.select(group, "y", (F.col("y") - fit).alias("rest"), "noise", F.posexplode(F.arrays_zip("x", "beta", "width")).alias("j", "c"))
    sums = terms.groupBy(group, "j").agg(
        F.count("*").alias("n"), F.sum(F.col("rest") * F.col("c.x")).alias("pull"), F.sum(F.col("y") * F.col("c.x")).alias("size"),
        F.first(F.col("c.beta") * F.pow(F.col("noise") / F.col("c.width"), F.lit(2))).alias("hold"),
    )
    worst = sums.groupBy(group).agg(F.max("n").alias("n_days"), F.max(F.abs(F.col("pull") - F.col("hold"))).alias("worst"), F.max(F.abs("size")).alias("most"))
    return worst.select(group, "n_days", (F.col("worst") / F.greatest("most", F.lit(1e-12))).alias("residual"))
