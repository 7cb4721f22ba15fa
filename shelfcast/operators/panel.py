"""The dense daily panel: scaffold, joins, fills, splits and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.fixed_values import CALENDAR_COLUMNS, ID_COLUMNS, SNAP_STATES
from shelfcast.operators.ordering import exact_median
from shelfcast.session import broadcast_if_small, cut_lineage


def pick(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def last_day(df: DataFrame, date_col: str = "date") -> Column:
    """Latest date as a scalar subquery."""
    return df.agg(F.max(date_col)).scalar()


def densify(sparse: DataFrame, first: Column, last: Column, key: str = "id") -> DataFrame:
    """Fill the days a series has no row for with zero sales.

    Each row emits the days up to the series' next row, and the first row the
    days before it. One shuffle on the key, no scaffold and no join; later
    windows on the key reuse the partitioning. A series has at most one row
    per day here, so no key is larger than the calendar.
    """
    w = Window.partitionBy(key).orderBy("date")
    begin = F.when(F.lag("date").over(w).isNull(), first).otherwise(F.col("date"))
    end = F.coalesce(F.date_sub(F.lead("date").over(w), 1), last)
    spans = sparse.withColumns({"_begin": begin, "_end": end})
    days = F.explode(F.sequence("_begin", "_end", F.expr("interval 1 day"))).alias("_day")
    rest = [c for c in sparse.columns if c not in ("date", "sales")]
    sales = F.when(F.col("_day") == F.col("date"), F.col("sales")).otherwise(F.lit(0.0))
    return spans.select(*rest, "date", "sales", days).select(
        *rest, F.col("_day").alias("date"), sales.alias("sales")
    )


def merge_calendar(long: DataFrame, calendar: DataFrame, on: str = "d") -> DataFrame:
    """Left join to the calendar; one row per day, so it is broadcast."""
    wanted = [c for c in pick(calendar, CALENDAR_COLUMNS).columns if c == on or c not in long.columns]
    days = calendar.select(*wanted)
    if "date" in days.columns:
        days = days.withColumn("date", F.to_date("date"))
    return long.join(F.broadcast(days), on, "left")


def price_keys(df: DataFrame, prices: DataFrame) -> list[str]:
    return [k for k in ("store_id", "item_id", "wm_yr_wk") if k in df.columns and k in prices.columns]


def join_prices(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on the shared price keys; price 1 when there is no key."""
    keys = price_keys(df, prices)
    if not keys or "sell_price" not in prices.columns:
        return df.withColumn("sell_price", F.lit(1.0))
    return df.join(prices.select(*keys, "sell_price"), keys, "left")


def fill_prices(
    df: DataFrame, group_cols: list[str] = ["item_id", "store_id"], weight: str | None = None
) -> DataFrame:
    """Missing price: median of the group, then of all rows so filled, then 1.

    A row counts ``weight`` times. The group medians are written once, one row
    per group. The overall median costs an own pass and is only computed when
    some group has no price at all.
    """
    groups = [c for c in group_cols if c in df.columns]
    times = F.col(weight) if weight else F.lit(1)
    if groups:
        medians = cut_lineage(df.groupBy(*groups).agg(F.percentile("sell_price", 0.5, times).alias("_median")))
        size = medians.agg(F.count("*"), F.count("_median")).first()
        df = (
            df.join(broadcast_if_small(medians, size[0]), groups, "left")
            .withColumn("sell_price", F.coalesce("sell_price", "_median"))
            .drop("_median")
        )
        if size[0] == size[1]:
            return df
    overall = exact_median(df, "sell_price", weight).scalar()
    return df.withColumn("sell_price", F.coalesce("sell_price", overall, F.lit(1.0)))


def merge_prices(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Panel with a price on every row.

    Prices are the same on all rows of a store, item and week, so they are
    joined and filled on that grain, weighted by its rows, and reach the panel
    in one join. The table of weeks is written once and counted: a small one
    is broadcast and leaves the panel's partitioning alone.
    """
    keys = price_keys(df, prices)
    if not keys or "sell_price" not in prices.columns:
        return df.withColumn("sell_price", F.lit(1.0))
    weeks = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    filled = fill_prices(cut_lineage(join_prices(weeks, prices)), [k for k in keys if k != "wm_yr_wk"], "_n")
    filled = cut_lineage(filled.select(*[F.col(k).alias(f"_{k}") for k in keys], "sell_price"))
    same = [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = df.join(broadcast_if_small(filled, filled.count()), same, "left")
    return joined.drop(*[f"_{k}" for k in keys])


def add_snap_flag(df: DataFrame, states: dict[str, str] = SNAP_STATES, state_col: str = "state_id") -> DataFrame:
    """Benefit flag of the row's own state; 0 for other states or without flags."""
    snap = F.lit(0)
    if state_col in df.columns:
        for state, column in states.items():
            if column in df.columns:
                snap = F.when(F.col(state_col) == state, F.col(column)).otherwise(snap)
    return df.withColumn("snap", snap.cast("int"))


def build_hierarchy_map(df: DataFrame) -> DataFrame:
    return pick(df, ID_COLUMNS).distinct()


def validation_start(df: DataFrame, val_days: int = 28) -> Column:
    return F.date_sub(last_day(df), val_days - 1)


def train_val_split(df: DataFrame, val_days: int = 28) -> tuple[DataFrame, DataFrame]:
    """The last ``val_days`` days are the validation part."""
    start = validation_start(df, val_days)
    return df.filter(F.col("date") < start), df.filter(F.col("date") >= start)


def ratio_split(df: DataFrame, ratio: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """Split at a share of the date span."""
    bounds = df.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = F.floor(F.datediff("b", "a") * F.lit(ratio)).cast("int")
    cut = bounds.select(F.date_add("a", days)).scalar()
    return df.filter(F.col("date") <= cut), df.filter(F.col("date") > cut)


def trailing_days(df: DataFrame, days: int, end: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days, the end day included."""
    return df.filter(F.col("date") > F.date_sub(last_day(df) if end is None else end, days))


def drop_missing_lags(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["sales_lag_28", "rolling_mean_28"])


def with_min_history(df: DataFrame, group_col: str, days: int = 60) -> DataFrame:
    """Keep the groups that have at least ``days`` distinct dates."""
    daily = df.groupBy(group_col, "date").agg(F.count(F.lit(1)).alias("n"))
    enough = daily.groupBy(group_col).count().filter(F.col("count") >= days)
    return df.join(enough.select(group_col), group_col, "left_semi")


INTEGERS = [
    (T.ByteType(), 8),
    (T.ShortType(), 16),
    (T.IntegerType(), 32),
    (T.LongType(), 64),
]
FLOAT_MAX = 3.4028234663852886e38


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast each number column to the smallest type that holds its range.

    One aggregate finds every range. Floating columns become float even where
    digits are lost; text, dates and all-null columns stay.
    """
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)
                and not isinstance(f.dataType, T.DecimalType)]
    if not whole + floating:
        return df
    ranges = df.agg(
        *[g(F.col(c)).alias(f"{p}{c}") for c in whole + floating for p, g in (("<", F.min), (">", F.max))]
    ).first()
    casts = {}
    for c in whole:
        lo, hi = ranges[f"<{c}"], ranges[f">{c}"]
        if lo is not None:
            fits = next(t for t, bits in INTEGERS if -(2 ** (bits - 1)) <= lo and hi < 2 ** (bits - 1))
            casts[c] = F.col(c).cast(fits)
    for c in floating:
        lo, hi = ranges[f"<{c}"], ranges[f">{c}"]
        if lo is not None and -FLOAT_MAX <= lo and hi <= FLOAT_MAX:
            casts[c] = F.col(c).cast("float")
    return df.withColumns(casts) if casts else df
