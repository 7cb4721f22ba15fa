"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts by spectral bisection and
swaps; a small classifier (one hidden layer) learns the share of each part among a
point's neighbours. Every row is indexed under its most probable part. A query visits
its most probable parts, as many as reach ``target`` recall on the sample, and all rows there are
reranked by exact distance.

The number of parts is half the square root of the number of rows, as a power of two, so parts and rows of a part grow
alike. The sample holds ``SAMPLE_PER_PART`` rows for each part, ``SAMPLE`` at least and ``MAX_SAMPLE`` at most; that bounds
the parts too, and only beyond some 67 million rows do parts grow with the table. Of few distinct vectors there
are fewer parts, four vectors each. Parts and queries meet in cells of bounded size, so a part that holds
most rows is many cells. Equal vectors: see ``topk``.

Left out are null ids, and vectors that are null, zero, of another length than most, or
hold null or non-finite components. Ties go to the smaller id. A query never finds its own
id. Queries whose parts hold too few rows visit further ones, so fewer than ``k`` come back only if
there are fewer candidates. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfcast.llm.blocks import BLOCK_QUERIES, best_of, matrix, per_cell
from shelfcast.llm.topk import query_classes, ranked, thinned, to_members
from shelfcast.session import cut_lineage

SAMPLE = 4096
SAMPLE_PER_PART = 16
MAX_SAMPLE = 65_536
MAX_PARTS = MAX_SAMPLE // SAMPLE_PER_PART
BLOCK_ROWS = 4096


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each point."""
    out = []
    for at in range(0, len(x), 256):
        d = distances(x[at : at + 256], x)
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def bisect(edges: np.ndarray, members: np.ndarray, rng: np.random.Generator, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of ``members``: the median cut of a smooth vector on the graph, then swaps."""
    place = np.full(edges.max() + 1 if edges.size else 0, -1)
    place[members] = np.arange(members.size)
    a, b = place[edges[:, 0]], place[edges[:, 1]]
    inside = (a >= 0) & (b >= 0)
    a, b = np.concatenate((a[inside], b[inside])), np.concatenate((b[inside], a[inside]))
    degree = np.bincount(a, minlength=members.size) + 1.0
    v = rng.standard_normal(members.size)
    for _ in range(steps):
        v = (np.bincount(a, v[b], members.size) + v) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(members.size, dtype=bool)
    side[np.argsort(v, kind="stable")[members.size // 2 :]] = True
    for _ in range(4):
        across = np.bincount(a, side[a] != side[b], members.size)
        gain = 2 * across - np.bincount(a, minlength=members.size)
        low, high = (np.flatnonzero(side == s) for s in (False, True))
        low, high = low[np.argsort(-gain[low], kind="stable")], high[np.argsort(-gain[high], kind="stable")]
        n = min(low.size, high.size)
        swap = gain[low[:n]] + gain[high[:n]] > 1
        if not swap.any():
            break
        side[low[:n][swap]], side[high[:n][swap]] = True, False
    return members[~side], members[side]


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each point, by halving the neighbour graph again and again."""
    edges = np.stack([np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()], axis=1)
    held = [np.arange(len(graph))]
    while len(held) < parts:
        held = [half for m in held for half in bisect(edges, m, rng)]
    part = np.zeros(len(graph), dtype=np.int64)
    for i, members in enumerate(held):
        part[members] = i
    return part


@dataclass(frozen=True)
class Router:
    """Classifier over parts, and how many parts a query visits."""

    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    probes: int

    @property
    def parts(self) -> int:
        return self.layers[3].size

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        h = np.maximum((x - self.mean) / self.scale @ self.layers[0] + self.layers[1], 0)
        return np.argsort(-(h @ self.layers[2] + self.layers[3]), axis=1, kind="stable")


def train(x: np.ndarray, goal: np.ndarray, rng: np.random.Generator, hidden: int = 128, epochs: int = 40) -> tuple[np.ndarray, ...]:
    """Cross-entropy towards shares of parts, by Adam."""
    n, d, m = len(x), x.shape[1], goal.shape[1]
    w = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, m)) * np.sqrt(1 / hidden), np.zeros(m)]
    first, second, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(n)
        for at in range(0, n, 256):
            own = order[at : at + 256]
            h = np.maximum(x[own] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            dz = (p / p.sum(1, keepdims=True) - goal[own]) / len(own)
            dh = (dz @ w[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x[own].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] = w[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(w)


def learn_router(x: np.ndarray, parts: int, k: int = 10, target: float = 0.97, seed: int = 0) -> Router:
    """Fit on sample vectors; ``probes`` reaches ``target`` recall of a held-out tenth of them."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))]
    mean, scale = x.mean(0), x.std(0) + 1e-9
    while parts > 1 and len(x) < 4 * parts:
        parts //= 2
    if parts == 1:
        d = x.shape[1]
        return Router(mean, scale, (np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1)
    graph = neighbour_graph(x, min(k, len(x) - 1))
    part = balanced_parts(graph, parts, rng)
    goal = np.eye(parts)[part] + np.eye(parts)[part[graph]].mean(axis=1)
    test = max(1, len(x) // 10)
    layers = train((x[test:] - mean) / scale, goal[test:] / 2, rng)
    router = Router(mean, scale, layers, parts)
    order = router.order(x)
    hit = (order[:test, None, :] == order[graph[:test], 0][:, :, None]).mean(axis=(0, 1)).cumsum()
    return Router(mean, scale, layers, int(min(parts, np.searchsorted(hit, target) + 1)))


def parts_for(rows: int) -> int:
    """Half the square root of the rows, as a power of two."""
    return min(MAX_PARTS, 1 << max(0, round(float(np.log2(max(rows, 1) ** 0.5 / 2)))))


def sample_vectors(rows: DataFrame, limit: int) -> np.ndarray:
    """A pseudo-random choice of at most ``limit`` rows."""
    chosen = rows.select("vec", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(limit)
    vec = chosen.toArrow().column("vec").combine_chunks()  # flat doubles, no Python object for each
    return vec.flatten().to_numpy().reshape(len(vec), -1)


def route(frame: DataFrame, router: Router, most: int) -> DataFrame:
    """Add ``parts``: the most probable ``most`` parts of ``vec``, in order."""
    held = frame.sparkSession.sparkContext.broadcast(router)  # of fixed size

    @pandas_udf("array<int>")
    def parts(vec: pd.Series) -> pd.Series:
        return pd.Series(list(held.value.order(matrix(vec))[:, :most].astype(np.int32))) if len(vec) else pd.Series([], dtype=object)

    return frame.withColumn("parts", parts("vec"))


def rerank(k: int):
    """The ``k`` nearest rows of a cell to each of its queries."""

    def run(_: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        x, ids, names = matrix(rows["vec"]), rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        q, out = matrix(queries["vec"]), []
        norm = (x * x).sum(1)
        for at in range(0, len(q), 256):
            own = q[at : at + 256]
            near = distances(own, x)
            # Rounding of the quick form: all that may belong to the k nearest are measured again.
            slack = 1e-9 * (norm.max() + (own * own).sum(1))[:, None]
            kth = np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1 : min(k, len(x))]
            row, col = np.nonzero(near <= kth + slack)
            score = np.sqrt(((own[row] - x[col]) ** 2).sum(1))
            best = best_of(row, ids[col], score, k)
            out.append(pd.DataFrame({"query_id": names[at : at + 256][row[best]], "vec_id": ids[col[best]], "score": score[best]}))
        return pd.concat(out, ignore_index=True)

    return run


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 10, parts: int | None = None, target: float = 0.97,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (distance) of each query's ``k`` nearest found.

    Both tables have ``vec_id`` and ``vec``, an array of doubles of one length.
    """
    need = k + 1
    kept = cut_lineage(thinned(rows, need))
    total = kept.count()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    parts = parts or parts_for(total)
    sample = min(max(SAMPLE, SAMPLE_PER_PART * parts), MAX_SAMPLE)
    router = learn_router(sample_vectors(kept, sample), parts, k, target)
    parts = router.parts
    indexed = cut_lineage(route(kept, router, 1).select("vec_id", "vec", F.element_at("parts", 1).alias("part")))
    counts = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}  # a row for each part
    classes = cut_lineage(query_classes(queries))
    sizes = F.create_map(*[F.lit(v) for p in range(parts) for v in (p, counts.get(p, 0))])
    # A query visits its first parts, and more until they hold enough rows.
    visits = route(classes, router, parts).select("query_id", "vec", F.posexplode("parts").alias("nth", "part"), "parts")
    before = F.aggregate(F.slice("parts", F.lit(1), F.col("nth")), F.lit(0).cast("long"), lambda s, p: s + F.element_at(sizes, p))
    visits = visits.filter((F.col("nth") < router.probes) | (before < need)).select("query_id", "vec", "part")
    visits = cut_lineage(visits)
    asked = {r["part"]: r["count"] for r in visits.groupBy("part").count().collect()}
    cuts = lambda n, size: F.create_map(*[F.lit(v) for p in range(parts) for v in (p, max(1, -(-n.get(p, 0) // size)))])
    row_blocks, query_blocks = cuts(counts, block_rows), cuts(asked, block_queries)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.element_at(n, F.col("part"))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.element_at(n, F.col("part")) - 1))
    left = indexed.withColumn("rb", block("vec_id", row_blocks)).select("*", every(query_blocks).alias("qb"))
    right = visits.withColumn("qb", block("query_id", query_blocks)).select("*", every(row_blocks).alias("rb"))
    found = per_cell(left, right, ["part", "rb", "qb"], rerank(need), "query_id long, vec_id long, score double")
    order = (F.asc("score"), F.asc("vec_id"))
    return to_members(ranked(found, need, *order).drop("rank"), queries, classes, k, *order)
