"""Reconciliation of forecasts by projection onto the coherent space.

With bottom series b, aggregates a, the membership matrix A and C = [-A I],
the reconciled forecasts are y - S C' (C S C')^-1 C y, where S is the error
covariance. C y is the gap of every aggregate from the sum of its members, a
distributed join. ``iterative`` solves the system by conjugate residuals over joins and holds no
matrix. A caller with few aggregates can name ``direct``: it inverts C S C' on the driver and
refuses more than ``MAX_DIRECT`` aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators import hierarchy as H
from shelfcast.session import broadcast_if_small, cut_lineage

SOLVERS = ("direct", "iterative")
METHODS = ("bottom_up", "top_down", "ols", "mint")
GRAM_BLOCK = 2048  # a tile of 32 MB
MAX_DIRECT = 1000  # an inverse of 8 MB


def aggregate_edges(edges: DataFrame) -> DataFrame:
    """(node_id, bottom_id) without the bottom series' own rows."""
    return edges.filter(F.col("node_id") != F.col("bottom_id")).select("node_id", "bottom_id")


def aggregate_gaps(base: DataFrame, edges: DataFrame, on: str, value: str) -> DataFrame:
    """Value of each aggregate minus the sum over its members, by ``on``."""
    members = edges.join(base.withColumnRenamed("node_id", "bottom_id"), "bottom_id")
    sums = members.groupBy("node_id", on).agg(F.sum(value).alias("_sum"))
    return base.join(sums, ["node_id", on]).select("node_id", on, (F.col(value) - F.col("_sum")).alias("gap"))


@dataclass
class Covariance:
    """Error covariance as ``low_rank * R R' / T`` plus a diagonal.

    ``diagonal`` has (node_id, v); None stands for ``level`` on every series.
    ``residuals`` are the centred residuals R (node_id, t, residual).
    """

    level: float = 1.0
    diagonal: DataFrame | None = None
    low_rank: float = 0.0
    residuals: DataFrame | None = None
    periods: int = 1


def centred(residuals: DataFrame) -> DataFrame:
    means = residuals.groupBy("node_id").agg(F.avg("residual").alias("_mean"))
    return residuals.join(means, "node_id").select(
        "node_id", "t", (F.col("residual") - F.col("_mean")).alias("residual")
    )


def packed_blocks(rows: DataFrame, long: str, short: str, block: int) -> DataFrame:
    """Rows (long, block, cells): a long key's values at the short keys of one block, as (place in the block, value)."""
    index = rows.select(short).distinct().select(short, (F.row_number().over(Window.orderBy(short)) - 1).alias("place"))
    placed = rows.join(index, short).select(
        F.col(long).alias("long"), F.floor(F.col("place") / block).cast("int").alias("block"), F.struct((F.col("place") % block).alias("i"), F.col("residual").alias("x")).alias("c")
    )
    return placed.groupBy("long", "block").agg(F.collect_list("c").alias("cells"))


def matrix_of(cells: pa.ListArray, width: int) -> np.ndarray:
    flat = cells.flatten()
    out = np.zeros((len(cells), width))
    row = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy(zero_copy_only=False))
    out[row, flat.field("i").to_numpy(zero_copy_only=False)] = flat.field("x").to_numpy(zero_copy_only=False)
    return out


def tile_sums(blocks: DataFrame, n_blocks: int, chunks: int, width: int) -> DataFrame:
    """(p, q, i, products): row i of the products of blocks p and q, p <= q, one part for each chunk of long keys.

    A task holds one tile of products at a time. A block goes to the tiles of its row and column, so with
    one block nothing is copied.
    """
    spans = [F.struct(F.least("block", F.lit(o)).alias("p"), F.greatest("block", F.lit(o)).alias("q")) for o in range(n_blocks)]
    dealt = blocks.select("long", "block", "cells", F.explode(F.array(*spans)).alias("t"), F.pmod(F.hash("long"), F.lit(chunks)).alias("chunk"))
    dealt = dealt.select("t.p", "t.q", "chunk", "long", "block", "cells")
    keys = ["p", "q", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, total, waiting = None, np.zeros((0, 0)), None
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def multiply() -> None:
            if pairs:
                left, right = (np.stack(side) for side in zip(*pairs))
                total[:] += left.T @ right
                pairs.clear()

        def finished() -> pa.RecordBatch:
            multiply()
            n = len(total)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(total.ravel()))
            return pa.RecordBatch.from_arrays([pa.array([here[0]] * n, pa.int32()), pa.array([here[1]] * n, pa.int32()), pa.array(range(n), pa.int32()), lists], ["p", "q", "i", "products"])

        for batch in batches:
            tags = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi == lo:
                    continue
                tile = tuple(tags[lo].tolist())
                if tile != here:
                    if here is not None:
                        yield finished()
                    here, total, waiting = tile, np.zeros((width, width)), None
                part = batch.slice(lo, hi - lo)
                x = matrix_of(part.column(5), width)
                if tile[0] == tile[1]:
                    total += x.T @ x
                    continue
                # A long key's two blocks are neighbours, the lower first; a key without values in one has no products.
                for key, block, row in zip(part.column(3).to_pylist(), part.column(4).to_pylist(), x):
                    if block == tile[0]:
                        waiting = (key, row)
                    elif waiting is not None and waiting[0] == key:
                        pairs.append((waiting[1], row))
                        if len(pairs) == 256:
                            multiply()
        if here is not None:
            yield finished()

    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "long", "block")
    return ordered.mapInArrow(run, "p int, q int, i int, products array<double>")


def gram_squares(rows: DataFrame, n_series: int, n_periods: int, block: int = GRAM_BLOCK) -> float:
    """Sum of the squared products of all pairs of periods, which is also that of all pairs of series.

    So the shorter of both sides is multiplied out. Chunks of the longer one are at least twice as
    long as a tile is wide, so their tiles take at most half of the residuals' own size.
    """
    long, short = ("node_id", "t") if n_periods <= n_series else ("t", "node_id")
    width = min(n_series, n_periods)
    n_blocks = -(-width // block)
    block = -(-width // n_blocks)
    chunks = max(1, max(n_series, n_periods) // (2 * block))
    parts = tile_sums(packed_blocks(rows, long, short, block), n_blocks, chunks, block)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, here, row = 0.0, None, np.zeros(block)
        for batch in batches:
            values = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, block)
            for key, own in zip(zip(*(batch.column(i).to_pylist() for i in range(3))), values):
                if key != here:
                    found += (row @ row) * (1 if here is None or here[0] == here[1] else 2)
                    here, row = key, np.zeros(block)
                row = row + own
        found += (row @ row) * (1 if here is None or here[0] == here[1] else 2)
        yield pa.RecordBatch.from_arrays([pa.array([found])], ["squares"])

    sums = parts.repartition("p", "q", "i").sortWithinPartitions("p", "q", "i").mapInArrow(add_up, "squares double")
    return sums.agg(F.sum("squares")).first()[0]


def shrinkage(residuals: DataFrame, n_series: int, n_periods: int) -> tuple[float, float]:
    """Ledoit-Wolf weight and mean variance of centred residuals, from three sums."""
    by_period = residuals.groupBy("t").agg(F.sum(F.col("residual") * F.col("residual")).alias("own"))
    trace, fourth = by_period.agg(F.sum("own"), F.sum(F.col("own") * F.col("own"))).first()
    squares = gram_squares(residuals, n_series, n_periods) / n_periods**2
    mean = trace / (n_series * n_periods)
    beta = (fourth / n_periods - squares) / (n_series * n_periods)
    distance = (squares - n_series * mean**2) / n_series
    weight = 0.0 if beta <= 0 or distance <= 0 else min(beta, distance) / distance
    return weight, mean


def estimate_covariance(residuals: DataFrame, method: str = "shrink") -> Covariance:
    """``shrink``, ``sample``, ``wls`` or the identity for any other name."""
    if method == "wls":
        variances = residuals.groupBy("node_id").agg(F.var_pop("residual").alias("v"))
        return Covariance(diagonal=variances)
    if method not in ("shrink", "sample"):
        return Covariance()
    rows = cut_lineage(centred(residuals))
    size = rows.agg(F.count_distinct("node_id"), F.count_distinct("t")).first()
    n_series, periods = size
    if method == "sample":
        return Covariance(0.0, None, periods / max(periods - 1, 1), rows, periods)
    weight, mean = shrinkage(rows, n_series, periods)
    return Covariance(weight * mean, None, 1 - weight, rows, periods)


def covariance_table(residuals: DataFrame, method: str = "shrink") -> DataFrame:
    """Variance of each series under the estimate, with its two parts."""
    cov = estimate_covariance(residuals, method)
    nodes = residuals.select("node_id").distinct()
    if cov.diagonal is not None:
        return cov.diagonal.select("node_id", F.col("v").alias("variance"), F.lit(1.0).alias("diagonal_weight"))
    if cov.residuals is None:
        return nodes.select("node_id", F.lit(1.0).alias("variance"), F.lit(1.0).alias("diagonal_weight"))
    own = cov.residuals.groupBy("node_id").agg(F.avg(F.pow("residual", F.lit(2))).alias("v"))
    variance = F.col("v") * cov.low_rank + cov.level
    return own.select("node_id", variance.alias("variance"), F.lit(1 - cov.low_rank).alias("diagonal_weight"))


def member_products(edges: DataFrame, diagonal: DataFrame | None) -> DataFrame:
    """Entries (a, b, v) of A D A': variance shared by two aggregates.

    Series with the same memberships are summed first, so pairs are formed
    within one short list of nodes per combination and not per series.
    """
    weights = edges
    if diagonal is not None:
        weights = edges.join(diagonal.withColumnRenamed("node_id", "bottom_id"), "bottom_id")
    else:
        weights = edges.withColumn("v", F.lit(1.0))
    per_series = weights.groupBy("bottom_id").agg(
        F.sort_array(F.collect_list("node_id")).alias("nodes"), F.first("v").alias("v")
    )
    combos = per_series.groupBy("nodes").agg(F.sum("v").alias("v"))
    left = combos.select("nodes", "v", F.explode("nodes").alias("a"))
    return left.select("a", F.explode("nodes").alias("b"), "v").groupBy("a", "b").agg(F.sum("v").alias("v"))


@dataclass
class System:
    """A covariance, the edges of the aggregates, the forecast days and the gaps of the residuals."""

    cov: Covariance
    edges: DataFrame
    days: list[date]
    residual_gaps: DataFrame | None = None


def _direct_inverse(system: System, names: list[str]) -> np.ndarray:
    cov, edges = system.cov, system.edges
    place = {name: i for i, name in enumerate(names)}
    n = len(names)
    matrix = np.zeros((n, n))
    if cov.diagonal is not None or cov.level:
        unit = 1.0 if cov.diagonal is not None else cov.level
        for a, b, v in member_products(edges, cov.diagonal).collect():
            matrix[place[a], place[b]] += unit * v
        if cov.diagonal is not None:
            nodes = edges.select("node_id").distinct()
            own = {r["node_id"]: r["v"] for r in cov.diagonal.join(nodes, "node_id").collect()}
            matrix[np.diag_indices(n)] += [own[name] for name in names]
        else:
            matrix[np.diag_indices(n)] += cov.level
    if cov.residuals is not None:
        gaps = system.residual_gaps.collect()
        times = {t: i for i, t in enumerate(sorted({r["t"] for r in gaps}))}
        cr = np.zeros((n, len(times)))
        for r in gaps:
            cr[place[r["node_id"]], times[r["t"]]] = r["gap"]
        matrix += cov.low_rank * cr @ cr.T / cov.periods
    return np.linalg.pinv(matrix, hermitian=True)


def _solve_direct(system: System, gaps: DataFrame) -> DataFrame:
    """Multipliers (node_id, date, m) by the inverse over all aggregates."""
    found = system.edges.select("node_id").distinct().limit(MAX_DIRECT + 1).collect()
    if len(found) > MAX_DIRECT:
        raise ValueError(f"more than {MAX_DIRECT} aggregates: use the iterative solver")
    names = sorted(r[0] for r in found)
    inverse = _direct_inverse(system, names)
    rows = [(name, cells.tolist()) for name, cells in zip(names, inverse)]
    table = gaps.sparkSession.createDataFrame(rows, "other string, cells array<double>")
    place = gaps.sparkSession.createDataFrame(list(enumerate(names)), "place int, node_id string")
    cells = table.select("other", F.posexplode("cells").alias("place", "cell"))
    cells = cells.join(broadcast_if_small(place, len(names)), "place")
    cells = broadcast_if_small(cells, len(names) ** 2)
    joined = gaps.withColumnRenamed("node_id", "other").join(cells, "other")
    return joined.groupBy("node_id", "date").agg(F.sum(F.col("gap") * F.col("cell")).alias("m"))


def spread(multipliers: DataFrame, system: System, rows: int) -> DataFrame:
    """S C' m as (node_id, date, shift), over bottom series and aggregates.

    ``rows`` is the counted size of the multipliers: small ones are broadcast,
    so that the total node's many edges need no shuffle. Forecast days stand beside each other
    in columns, so that a residual is one row for all of them.
    """
    cov, edges = system.cov, system.edges
    multipliers = broadcast_if_small(multipliers, rows)
    own = multipliers.select("node_id", "date", F.col("m").alias("shift"))
    members = edges.join(multipliers, "node_id").groupBy(F.col("bottom_id").alias("node_id"), "date")
    transposed = own.unionByName(members.agg((-F.sum("m")).alias("shift")))
    parts = []
    if cov.diagonal is not None:
        parts.append(transposed.join(cov.diagonal, "node_id").select("node_id", "date", F.col("shift") * F.col("v")))
    elif cov.level:
        parts.append(transposed.select("node_id", "date", F.col("shift") * F.lit(cov.level)))
    if cov.residuals is not None:
        of_day = lambda d: F.max(F.when(F.col("date") == F.lit(d), F.col("m")))
        wide = multipliers.groupBy("node_id").agg(*[of_day(d).alias(f"m{i}") for i, d in enumerate(system.days)])
        weights = [F.sum(F.col("gap") * F.col(f"m{i}")).alias(f"w{i}") for i in range(len(system.days))]
        by_time = system.residual_gaps.join(broadcast_if_small(wide, rows), "node_id").groupBy("t").agg(*weights)
        sums = [F.sum(F.col("residual") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(system.days))]
        shifted = cov.residuals.join(broadcast_if_small(by_time, cov.periods), "t").groupBy("node_id").agg(*sums)
        scale = F.lit(cov.low_rank / cov.periods)
        by_day = [F.struct(F.lit(d).alias("date"), (F.col(f"s{i}") * scale).alias("shift")) for i, d in enumerate(system.days)]
        parts.append(shifted.select("node_id", F.inline(F.array(*by_day))).filter(F.col("shift").isNotNull()))
    parts = [p.toDF("node_id", "date", "shift") for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("node_id", "date").agg(F.sum("shift").alias("shift"))


def _solve_iterative(system: System, gaps: DataFrame, tolerance: float = 1e-10, max_steps: int = 500) -> DataFrame:
    """Conjugate residuals on C S C' m = gap, all days at once, over joins.

    They make the residual least, so a singular system (a sample covariance of few periods) gets
    the solution that the pseudo-inverse gives, up to parts that the forecasts do not see. Steps end when
    C S C' times the residual vanishes beside its first value, on every day.
    """

    def applied(r: DataFrame) -> DataFrame:
        image = spread(r.select("node_id", "date", F.col("r").alias("m")), system, rows)
        return aggregate_gaps(image, system.edges, "date", "shift").withColumnRenamed("gap", "ar")

    def by_day(state: DataFrame) -> DataFrame:
        dot = lambda a, b: F.sum(F.col(a) * F.col(b))
        return cut_lineage(state.groupBy("date").agg(dot("r", "ar").alias("rar"), dot("ap", "ap").alias("apap"), dot("ar", "ar").alias("arar")))

    safe = lambda a, b: F.when((a > 0) & (b > 0), a / F.nullif(b, F.lit(0.0))).otherwise(F.lit(0.0))
    start = cut_lineage(gaps.select("node_id", "date", F.col("gap").alias("r")))
    rows = start.count()
    first = start.join(applied(start), ["node_id", "date"])
    state = cut_lineage(first.select("node_id", "date", F.lit(0.0).alias("m"), "r", "ar", F.col("r").alias("p"), F.col("ar").alias("ap")))
    sums = by_day(state)
    goal = sums.select("date", F.col("arar").alias("goal"))
    for _ in range(max_steps):
        step = safe(F.col("rar"), F.col("apap"))
        moved = state.join(F.broadcast(sums.select("date", "rar", "apap")), "date").select(
            "node_id", "date", "rar", "p", "ap", (F.col("m") + step * F.col("p")).alias("m"), (F.col("r") - step * F.col("ap")).alias("r")
        )
        moved = cut_lineage(moved)
        both = cut_lineage(moved.join(applied(moved), ["node_id", "date"]))
        turn = both.groupBy("date").agg(F.sum(F.col("r") * F.col("ar")).alias("fresh"))
        share = safe(F.col("fresh"), F.col("rar"))
        state = cut_lineage(
            both.join(F.broadcast(turn), "date").select(
                "node_id", "date", "m", "r", "ar", (F.col("r") + share * F.col("p")).alias("p"), (F.col("ar") + share * F.col("ap")).alias("ap")
            )
        )
        sums = by_day(state)
        open_days = sums.join(goal, "date").filter((F.col("arar") > tolerance**2 * F.col("goal")) & (F.col("rar") > 0))
        if open_days.isEmpty():
            return state.select("node_id", "date", "m")
    raise RuntimeError(f"no convergence in {max_steps} steps")


def project(base: DataFrame, edges: DataFrame, cov: Covariance, solver: str = "iterative") -> DataFrame:
    """Coherent forecasts (node_id, date, forecast) nearest to ``base`` under ``cov``."""
    if solver not in SOLVERS:
        raise ValueError(f"unknown solver {solver!r}; use one of {SOLVERS}")
    edges = cut_lineage(aggregate_edges(edges))
    base = cut_lineage(base.select("node_id", "date", "forecast"))
    days = [r[0] for r in base.select("date").distinct().orderBy("date").collect()]
    system = System(cov, edges, days)
    if cov.residuals is not None:
        system.residual_gaps = cut_lineage(aggregate_gaps(cov.residuals, edges, "t", "residual"))
    gaps = aggregate_gaps(base, edges, "date", "forecast")
    solve = _solve_direct if solver == "direct" else _solve_iterative
    multipliers = cut_lineage(solve(system, gaps))
    shift = spread(multipliers, system, multipliers.count())
    moved = base.join(shift, ["node_id", "date"], "left")
    return moved.select(
        "node_id", "date", (F.col("forecast") - F.coalesce("shift", F.lit(0.0))).alias("forecast")
    )


def ols_reconcile(base: DataFrame, edges: DataFrame, solver: str = "iterative") -> DataFrame:
    return project(base, edges, Covariance(), solver)


def mint_reconcile(
    base: DataFrame, edges: DataFrame, residuals: DataFrame, method: str = "shrink", solver: str = "iterative"
) -> DataFrame:
    """Minimum-trace reconciliation under an estimated covariance."""
    return project(base, edges, estimate_covariance(residuals, method), solver)


def node_table(df: DataFrame, value: str, levels: list[str]) -> DataFrame:
    """Bottom rows and their sums at the levels, as (node_id, date, value)."""
    bottom = df.select(F.col("id").alias("node_id"), "date", value)
    name = F.concat_ws(H.NODE_SEPARATOR, "level", *H.KEYS)
    return bottom.unionByName(H.roll_up(df, value, levels).select(name.alias("node_id"), "date", value))


def naive_residuals(nodes: DataFrame, days: int | None = None, value: str = "sales") -> DataFrame:
    """One-day changes of every node over the last days, or all days: (node_id, t, residual)."""
    recent = nodes
    if days is not None:
        recent = nodes.filter(F.col("date") >= F.date_sub(nodes.agg(F.max("date")).scalar(), days))
    change = F.col(value) - F.lag(value).over(Window.partitionBy("node_id").orderBy("date"))
    t = F.datediff("date", F.lit("1970-01-01")).alias("t")
    return recent.select("node_id", t, change.alias("residual")).filter(F.col("residual").isNotNull())


def reconcile(
    method: str,
    base: DataFrame,
    hierarchy: DataFrame,
    levels: list[str] = H.DEFAULT_EDGE_LEVELS,
    history: DataFrame | None = None,
    residuals: DataFrame | None = None,
    covariance: str = "shrink",
    solver: str = "iterative",
) -> DataFrame:
    """Coherent forecasts of all nodes, (node_id, date, forecast), by the named strategy."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    edges = H.membership_edges(hierarchy, levels)
    if method == "ols":
        return ols_reconcile(base, edges, solver)
    if method == "mint":
        if residuals is None:
            raise ValueError("mint needs residuals")
        return mint_reconcile(base, edges, residuals, covariance, solver)
    if method == "top_down":
        if history is None:
            raise ValueError("top_down needs the sales history")
        total = base.filter(F.col("node_id") == "total").select("date", "forecast")
        bottom = H.top_down(total, H.compute_proportions(history))
    else:
        bottom = base.withColumnRenamed("node_id", "id").join(hierarchy.select("id"), "id", "left_semi")
    return node_table(H.with_hierarchy(bottom, hierarchy), "forecast", levels)
