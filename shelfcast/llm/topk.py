"""Exact top-k inner products by a three-phase uniform threshold.

A score is the sum of two partial scores, one for each half of the components. Rows and
queries meet in cells of bounded size.

1. Each cell gathers, for each query, the entries that lead its two local lists of
   partial scores, and their whole scores.
2. The k-th best of these is a safe cutoff: it goes with its query to all cells. An entry
   that can reach it has a partial score of at least half of it in one of the lists (the
   uniform threshold), so those entries suffice.
3. Their scores are resolved exactly, and each cell reports at most k of them.

Equal vectors are interchangeable: of each only the k + 1 smallest ids can be among a
best k, the others are left out before the cells; equal query vectors are searched once.

Null vectors, vectors holding null or non-finite components and null ids take no part
(for other lengths, see ``blocks.vectors``). Ties go to the smaller id; a query never
finds its own id. Rows that repeat an id are candidates of their own, except to queries
of that id. Scores beyond a long are cut to its range. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.blocks import BLOCK_QUERIES, best_of, per_cell
from shelfcast.session import cut_lineage

BLOCK_ROWS = 4096
STEP = 256


def quantised(vec: Column, scale: int = 256) -> Column:
    return F.transform(vec, lambda x: F.floor(x * scale).cast("long"))


def thinned(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of smallest id of each vector; Spark cuts hot vectors before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def in_blocks(rows: DataFrame, queries: DataFrame, block_rows: int, block_queries: int) -> tuple[DataFrame, DataFrame]:
    """Rows and queries with the cells (``rb``, ``qb``) in which each pair of them meets once."""
    n_rows, n_queries = (max(1, -(-t.count() // n)) for t, n in ((rows, block_rows), (queries, block_queries)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return (
        rows.withColumn("rb", block("vec_id", n_rows)).select("*", every(n_queries).alias("qb")),
        queries.withColumn("qb", block("query_id", n_queries)).select("*", every(n_rows).alias("rb")),
    )


def exact_matrix(column: pd.Series, bound: list[int]) -> np.ndarray:
    """Integers as doubles while sums stay exact, else as Python integers."""
    whole = np.stack(column.to_numpy()).astype(np.int64)
    return whole.astype(np.float64) if bound[0] < 1 << 53 else whole.astype(object)


def sum_bound(rows: pd.Series, queries: pd.Series) -> list[int]:
    most = [max(abs(int(f(np.stack(c.to_numpy())))) for f in (np.min, np.max)) for c in (rows, queries)]
    return [most[0] * most[1] * len(rows.iloc[0])]


def as_long(score: np.ndarray) -> np.ndarray:
    if score.dtype == object:
        return np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in score], dtype=np.int64)
    return np.rint(score).astype(np.int64)


def local_search(k: int, with_cutoff: bool):
    """Phase 1, or phases 2 and 3, for one cell."""

    def run(_: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if not len(rows) or not len(queries):
            return none
        bound = sum_bound(rows["vec"], queries["vec"])
        x, q = exact_matrix(rows["vec"], bound), exact_matrix(queries["vec"], bound)
        ids, names, half = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy(), x.shape[1] // 2
        out = []
        for at in range(0, len(q), STEP):
            own = q[at : at + STEP]
            lists = own[:, :half] @ x[:, :half].T, own[:, half:] @ x[:, half:].T
            if with_cutoff:
                cutoff = queries["cutoff"].to_numpy(dtype="float64", na_value=-np.inf)[at : at + STEP, None]
                cutoff = cutoff - np.abs(cutoff) * 2.0**-50  # safe where a long is rounded to a double
                enough = (lists[0] >= cutoff / 2) | (lists[1] >= cutoff / 2)
            else:
                enough = np.zeros(lists[0].shape, dtype=bool)
                for partial in lists:
                    lead = np.argsort(-partial, axis=1, kind="stable")[:, :k] if partial.dtype == object or partial.shape[1] <= k else np.argpartition(-partial, k - 1, axis=1)[:, :k]
                    np.put_along_axis(enough, lead, True, axis=1)
            row, col = np.nonzero(enough)
            total = lists[0][row, col] + lists[1][row, col]
            if with_cutoff:
                fine = total >= cutoff[row, 0]
                row, col, total = row[fine], col[fine], total[fine]
            score = as_long(total)
            best = best_of(row, ids[col], ~score, k)  # descending, without overflow
            out.append(pd.DataFrame({"query_id": names[at : at + STEP][row[best]], "vec_id": ids[col[best]], "score": score[best]}))
        return pd.concat(out, ignore_index=True)

    return run


def ranked(found: DataFrame, k: int, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def to_members(found: DataFrame, queries: DataFrame, classes: DataFrame, k: int, *order: Column) -> DataFrame:
    """From the results of each distinct query vector to those of each query, without its own id."""
    members = queries.join(classes, "vec").select(F.col("vec_id").alias("own"), "query_id").distinct()
    pairs = found.join(members, "query_id").filter("vec_id <> own")
    return ranked(pairs.select(F.col("own").alias("query_id"), "vec_id", "score"), k, *order).select("query_id", "rank", "vec_id", "score")


def query_classes(queries: DataFrame) -> DataFrame:
    """Distinct query vectors, named by the smallest id among them."""
    return queries.groupBy("vec").agg(F.min("vec_id").alias("query_id"))


def top_k(rows: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (long) of each query's best ``k`` rows.

    Both tables have ``vec_id`` and ``vec``, an array of longs of one length.
    """
    need = k + 1  # one more, as the query's own row may be among them
    classes = cut_lineage(query_classes(queries))
    left, right = in_blocks(cut_lineage(thinned(rows, need)), classes, block_rows, block_queries)
    schema = "query_id long, vec_id long, score long"
    gathered = per_cell(left, right, ["rb", "qb"], local_search(need, False), schema)
    cutoffs = ranked(gathered, need, F.desc("score")).groupBy("query_id").agg(
        F.min(F.when(F.col("rank") == need, F.col("score"))).alias("cutoff")
    )
    asked = right.join(cut_lineage(cutoffs), "query_id", "left")
    collected = per_cell(left, asked, ["rb", "qb"], local_search(need, True), schema)
    order = (F.desc("score"), F.asc("vec_id"))
    return to_members(ranked(collected, need, *order).drop("rank"), queries, classes, k, *order)
