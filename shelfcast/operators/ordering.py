"""Global order without a single sorting task: ranks, medians, label codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.fixed_values import ENCODED_COLUMNS
from shelfcast.session import broadcast_if_small, cut_lineage


def running_total(df: DataFrame, order_cols: list[str], weight: str, name: str) -> DataFrame:
    """Add the running sum of ``weight`` in the global order of ``order_cols``.

    A range-partitioned sort spreads the rows; each partition then only needs
    the sum of the partitions before it. The sort is materialised first, so
    both passes see the same split. The table of partition sums has one row
    per shuffle partition.
    """
    ordered = cut_lineage(df.orderBy(*order_cols).withColumn("_part", F.spark_partition_id()))
    sums = ordered.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.sum(weight).over(inside))
        .drop("_part", "_before")
    )


def exact_median(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """One row with the exact median of a column of any size.

    A row counts ``weight`` times. Equal values are counted first; the middle
    one or two are then found by their running counts.
    """
    times = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(times.alias("n"))
    placed = running_total(counts, [column], "n", "upto")
    total = placed.agg(F.sum("n")).scalar()
    low, high = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    first = F.col("upto") - F.col("n") + 1
    in_middle = lambda k: (first <= k) & (k <= F.col("upto"))
    middle = placed.filter(in_middle(low) | in_middle(high))
    return middle.agg(F.avg(column).alias("median"))


def fit_encoders(df: DataFrame, columns: list[str] = ENCODED_COLUMNS) -> DataFrame:
    """Lookup (col, code, label): labels of a column in sorted order from 0."""
    present = [c for c in columns if c in df.columns]
    combinations = df.select(*present).distinct()
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("label")) for c in present])
    )
    labels = (
        combinations.select(pairs.alias("p"))
        .select("p.col", "p.label")
        .filter(F.col("label").isNotNull())
        .distinct()
        .withColumn("one", F.lit(1))
    )
    placed = cut_lineage(running_total(labels, ["col", "label"], "one", "place"))
    starts = placed.groupBy("col").agg(F.min("place").alias("start"))
    return placed.join(F.broadcast(starts), "col").select(
        "col", (F.col("place") - F.col("start")).cast("int").alias("code"), "label"
    )


def encode_labels(df: DataFrame, encoders: DataFrame, columns: list[str] = ENCODED_COLUMNS) -> DataFrame:
    """Replace labels by codes; null and unknown labels become -1.

    The counted size of each lookup decides whether it is broadcast.
    """
    sizes = {r["col"]: r["n"] for r in encoders.groupBy("col").agg(F.count("*").alias("n")).collect()}
    for c in [c for c in columns if c in df.columns]:
        lookup = encoders.filter(F.col("col") == c).select(
            F.col("label").alias("_label"), F.col("code").alias("_code")
        )
        joined = df.join(
            broadcast_if_small(lookup, sizes.get(c, 0)), df[c].cast("string") == F.col("_label"), "left"
        )
        df = joined.withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_label", "_code")
    return df


def decode_labels(df: DataFrame, encoders: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """Code back to label; a code without a label is kept as text."""
    lookup = encoders.filter(F.col("col") == column).select(
        F.col("code").alias("_code"), F.col("label").alias("_label")
    )
    joined = df.join(broadcast_if_small(lookup, lookup.count()), df[column] == F.col("_code"), "left")
    label = F.coalesce("_label", df[column].cast("string"))
    return joined.withColumn(into or column, label).drop("_code", "_label")
