"""Vectors, and a stated set of queries searched against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


def vectors(rows: DataFrame, name: str = "embedding", nonzero: bool = False) -> DataFrame:
    """``vec_id`` and ``vec`` (doubles) of the rows that take part.

    Left out are null ids, null vectors, vectors with null or non-finite components,
    with ``nonzero`` also zero vectors, and vectors of another length than the most
    frequent one (the shorter one, where two are as frequent).
    """
    vec = F.col(name).cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.select("vec_id", vec.alias("vec")).filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & fine)
    if nonzero:
        kept = kept.filter(F.exists("vec", lambda x: x != 0))
    lengths = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").select("n").first()
    return kept.filter(F.size("vec") == (lengths["n"] if lengths else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def best_of(query: np.ndarray, ids: np.ndarray, cost: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` least (cost, id) of each query, ordered by query."""
    order = np.lexsort((ids, cost, query))
    q = query[order]
    first = np.concatenate(([True], q[1:] != q[:-1])) if q.size else np.zeros(0, bool)
    rank = np.arange(q.size) - np.flatnonzero(first)[np.cumsum(first) - 1] if q.size else np.zeros(0, int)
    return order[rank < k]


def per_cell(
    rows: DataFrame, queries: DataFrame, keys: list[str], fn: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply ``fn`` to the rows and queries of each cell; cells without queries cost nothing."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        return fn(key, left, right)

    return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, schema)
