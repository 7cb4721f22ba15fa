"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage


def star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Join every node's neighbours to the least of them and itself.

    ``larger_only`` moves the larger neighbours of each node (``edges`` in both
    directions), else all neighbours and the node itself (``edges`` from the larger to the
    smaller end). Least neighbours are combined before the shuffle, so a node with very
    many edges is a split join at most.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if larger_only:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for every node that is not a root itself.

    ``edges`` has long columns ``a`` and ``b``. Each round is a table in the shared
    folder; rounds grow with the logarithm of the longest path.
    """
    ends = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut_lineage(edges.filter("a <> b").select(*ends).distinct())
    seen = None
    while True:
        # Two 32-bit halves of a hash, so that the sums cannot overflow.
        h = F.xxhash64("a", "b")
        mark = now.agg(
            F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))
        ).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = cut_lineage(star(star(both, True), False))
