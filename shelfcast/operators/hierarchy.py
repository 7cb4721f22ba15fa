"""Hierarchy levels: roll-up, proportions, top-down shares, coherence, memberships."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.fixed_values import ID_COLUMNS, LEVELS
from shelfcast.operators.panel import trailing_days

KEYS = ID_COLUMNS[1:]
DEFAULT_EDGE_LEVELS = ["store", "state", "cat", "total"]
NODE_SEPARATOR = "|"


def node_name(level: str, keys: list[str]) -> Column:
    return F.concat_ws(NODE_SEPARATOR, F.lit(level), *[F.col(k) for k in keys])


def roll_up(df: DataFrame, value: str | list[str] = "forecast", levels: list[str] | None = None) -> DataFrame:
    """Sums of a bottom table at every level, long: level, keys, date and the value, or several values.

    The rows are grouped once by item and once by department and store; every
    higher level is summed from the latter, which has no items left. Bottom
    rows pass through unchanged. Keys that a level lacks are null.
    """
    levels = levels or list(LEVELS)
    for name in levels:
        if name not in LEVELS:
            raise ValueError(f"unknown level {name!r}; known: {list(LEVELS)}")
    values = [value] if isinstance(value, str) else value
    sums = [F.sum(v).alias(v) for v in values]
    shape = ["level", *ID_COLUMNS, "date", *values]

    def shaped(part: DataFrame, level: Column, kept: list[str]) -> DataFrame:
        typed = lambda c: F.col(c) if c in kept else F.lit(None).cast(df.schema[c].dataType).alias(c)
        return part.select(level.alias("level"), *[typed(c) for c in ID_COLUMNS], "date", *values)

    parts = []
    if "item_store" in levels:
        parts.append(shaped(df, F.lit("item_store"), ["id"]))
    if "item" in levels:
        items = df.groupBy("item_id", "date").agg(*sums)
        parts.append(shaped(items, F.lit("item"), ["item_id"]))
    upper = [n for n in levels if n not in ("item_store", "item")]
    if upper:
        held = ["dept_id", "cat_id", "store_id", "state_id"]
        base = df.groupBy(*held, "date").agg(*sums)
        sets = [[*LEVELS[n], "date"] for n in upper]
        grouped = base.groupingSets(sets, *held, "date").agg(F.grouping_id().alias("_gid"), *sums)
        level = F.lit(None).cast("string")
        for n in upper:
            gid = sum(2 ** (len(held) - i) for i, c in enumerate(held) if c not in LEVELS[n])
            level = F.when(F.col("_gid") == gid, n).otherwise(level)
        parts.append(shaped(grouped, level, held))
    return reduce(DataFrame.unionByName, parts).select(*shape)


def with_hierarchy(df: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Key columns from the hierarchy map, each once and without suffixes."""
    own = [c for c in df.columns if c == "id" or c not in hierarchy.columns]
    return df.select(*own).join(hierarchy, "id", "left")


def bottom_up(forecasts: DataFrame, hierarchy: DataFrame | None = None) -> DataFrame:
    missing = [c for c in KEYS if c not in forecasts.columns]
    if missing and hierarchy is None:
        raise ValueError(f"forecasts lack {missing} and no hierarchy map was given")
    return roll_up(with_hierarchy(forecasts, hierarchy) if missing else forecasts)


def daily_shares(df: DataFrame, keys: list[str] = ["id"]) -> DataFrame:
    """Share of each key in the total of its day.

    Daily totals are one row per day and are broadcast.
    """
    daily = df.groupBy(*keys, "date").agg(F.sum("sales").alias("sales"))
    totals = df.groupBy("date").agg(F.sum("sales").alias("total"))
    share = F.col("sales") / F.greatest("total", F.lit(1e-6))
    return daily.join(F.broadcast(totals), "date").withColumn("share", share)


def compute_proportions(history: DataFrame, recent_days: int = 365) -> DataFrame:
    """Mean daily share of each series in the total, scaled to sum to 1."""
    shares = daily_shares(trailing_days(history, recent_days))
    means = shares.groupBy("id").agg(F.avg("share").alias("proportion"))
    whole = means.agg(F.nullif(F.sum("proportion"), F.lit(0.0))).scalar()
    return means.withColumn("proportion", F.col("proportion") / whole)


def top_down(top: DataFrame, proportions: DataFrame) -> DataFrame:
    """Each series gets its share of the total forecast of every day.

    Undated shares receive the top forecast as one array, as long as the
    horizon, and explode it; dated shares join on the day.
    """
    if "date" in proportions.columns:
        joined = proportions.join(F.broadcast(top.select("date", "forecast")), "date")
    else:
        path = top.agg(F.collect_list(F.struct("date", "forecast"))).scalar()
        joined = proportions.select("*", F.explode(path).alias("_t")).select(
            "id", "proportion", "_t.date", "_t.forecast"
        )
    return joined.select("id", "date", (F.col("forecast") * F.col("proportion")).alias("forecast"))


def coherence(reconciled: DataFrame, value: str = "forecast", tolerance: float = 1.0) -> DataFrame:
    """Largest gap of each level's daily sum from the total level.

    Levels are those present; without a total level nothing is reported.
    """
    daily = reconciled.groupBy("level", "date").agg(F.sum(value).alias("_sum"))
    totals = daily.filter(F.col("level") == "total").select("date", F.col("_sum").alias("_total"))
    gaps = daily.filter(F.col("level") != "total").join(F.broadcast(totals), "date")
    worst = gaps.groupBy("level").agg(F.max(F.abs(F.col("_sum") - F.col("_total"))).alias("max_gap"))
    return worst.withColumn("coherent", F.col("max_gap") <= tolerance)


def check_coherence(
    reconciled: DataFrame, tolerance: float = 1.0, level: str = "store", value: str = "forecast"
) -> bool:
    """True when the level adds up to the total, or when either is missing."""
    row = coherence(reconciled, value, tolerance).filter(F.col("level") == level).first()
    return True if row is None else row["coherent"]


def membership_edges(
    hierarchy: DataFrame, levels: list[str] = DEFAULT_EDGE_LEVELS, identity: bool = True
) -> DataFrame:
    """The summing matrix as edges (level, node_id, bottom_id)."""
    nodes = [F.struct(F.lit(n).alias("level"), node_name(n, LEVELS[n]).alias("node_id")) for n in levels]
    if identity:
        nodes.insert(0, F.struct(F.lit("item_store").alias("level"), F.col("id").alias("node_id")))
    exploded = hierarchy.select(F.col("id").alias("bottom_id"), F.explode(F.array(*nodes)).alias("n"))
    return exploded.select("n.level", "n.node_id", "bottom_id")
