"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words. A source's documents stand in a fixed
pseudo-random order; reading that order as often as the target asks, word by word,
gives each copy of a document an interval of the source's tokens. The source's weight
schedule over training time, integrated, is its cumulative demand; inverting it at the
start of an interval gives the copy's training position in [0, 1). Sorting by
position (a range sort) gives the training order.

Prefix sums never pass one task: documents are spread over hash buckets of their
source, bucket totals are summed first, and a window runs inside one bucket only. Only
one row for each source reaches the driver.

Null and empty texts have size 0 and are not taken; a null source is a source of its
own, ordered last; a null ``doc_id`` is a value like another; repeated rows are rows of
their own, told apart by their place in the order; an empty table gives an empty one;
only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD
from shelfcast.session import broadcast_if_small, cut_lineage

BUCKETS = 4096
Knots = Sequence[tuple[float, float]]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weight(rank: int) -> float:
    """1, 2, 3, repeating."""
    return float(rank % 3 + 1)


def cyclic_schedule(rank: int) -> Knots:
    """Weight over time: the first of three sources fades, the second is even, the third grows."""
    return [((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))][rank % 3]


def capped_targets(sizes: Sequence[float], weights: Sequence[float], cap: float = 3.0) -> list[float]:
    """Share the sum of ``sizes`` by weight; what exceeds ``cap`` times a size is shared again."""
    left, targets = float(sum(sizes)), [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        share = left / sum(weights[i] for i in free)
        over = [i for i in free if share * weights[i] > cap * sizes[i]]
        for i in over or free:
            targets[i] = cap * sizes[i] if over else share * weights[i]
            left -= targets[i]
        free = [i for i in free if share * weights[i] <= cap * sizes[i]] if over else []
    return targets


def segments(knots: Knots) -> list[tuple[float, float, float, float, float, float]]:
    """Pieces (y0, y1, t0, t1, w0, w1) of a schedule; y is the integral, 1 at the end."""
    if len(knots) < 2 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs rising times and weights of 0 or more")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole = sum(areas)
    if whole <= 0:
        raise ValueError("a schedule needs some weight")
    out, y = [], 0.0
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        out.append((y, y + area / whole, t0, t1, w0 / whole, w1 / whole))
        y += area / whole
    return out


def training_position(part: Column, pieces: Column) -> Column:
    """Time at which the integrated schedule reaches ``part`` of the demand."""
    inside = F.filter(pieces, lambda s: (s.y0 <= part) & (s.y1 > s.y0))
    s = F.element_at(inside, -1)
    slope = (s.w1 - s.w0) / (s.t1 - s.t0)
    need = part - s.y0
    root = F.sqrt(F.greatest(s.w0 * s.w0 + 2 * slope * need, F.lit(0.0)))
    # The stable form of the quadratic's root: no difference of close numbers.
    return s.t0 + F.coalesce(F.try_divide(2 * need, s.w0 + root), F.lit(0.0))


@dataclass(frozen=True)
class Plan:
    """One row for each source: size, target, whole passes, rest in words, schedule."""

    rows: list[tuple]
    schema: str = (
        "source string, source_size long, target double, passes long, rest long, "
        "pieces array<struct<y0:double,y1:double,t0:double,t1:double,w0:double,w1:double>>"
    )


def plan_sources(
    sizes: dict[str | None, int], weight: Callable[[int], float] = cyclic_weight, schedule: Callable[[int], Knots] = cyclic_schedule, cap: float = 3.0
) -> Plan:
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    targets = capped_targets([sizes[s] for s in names], [weight(i) for i in range(len(names))], cap)
    rows = []
    for i, (name, target) in enumerate(zip(names, targets, strict=True)):
        size = sizes[name]
        words = min(round(target), int(cap * size))
        rows.append((name, size, target, words // size if size else 0, words % size if size else 0, segments(schedule(i))))
    return Plan(rows)


def assign(
    docs: DataFrame,
    keep: Sequence[str] = (),
    weight: Callable[[int], float] = cyclic_weight,
    schedule: Callable[[int], Knots] = cyclic_schedule,
    cap: float = 3.0,
) -> DataFrame:
    """``doc_id``, ``size``, its source's figures, ``taken`` words and ``copies``.

    ``copies`` lists (words, position) of each copy, whole ones first. ``keep`` names
    further columns to carry.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")), F.col("source"))
    base = docs.select("doc_id", "source", *keep, word_count(F.col("text")).alias("size"), order.alias("_order"))
    base = base.withColumn("_bucket", F.pmod("_order", F.lit(BUCKETS)).cast("int"))
    if not keep:
        base = cut_lineage(base)
    sums = cut_lineage(base.groupBy("source", "_bucket").agg(F.sum("size").alias("words")))
    sizes = {r["source"]: r["words"] for r in sums.groupBy("source").agg(F.sum("words").alias("words")).collect()}
    plan = plan_sources(sizes, weight, schedule, cap)
    sources = spark.createDataFrame(plan.rows, plan.schema)
    before = F.sum("words").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("source", "_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    marked = offsets.alias("o").join(F.broadcast(sources).alias("s") if len(plan.rows) < 10_000 else sources.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source")))
    offsets = marked.select("o.*", "s.source_size", "s.target", "s.passes", "s.rest", "s.pieces")
    offsets = broadcast_if_small(offsets, len(plan.rows) * BUCKETS * 4)
    joined = base.alias("d").join(
        offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d._bucket") == F.col("o._bucket"))
    )
    columns = ["doc_id", "source", *keep, "size", "_order", "_bucket"]
    joined = joined.select(*[f"d.{c}" for c in columns], "o._offset", "o.source_size", "o.target", "o.passes", "o.rest", "o.pieces")
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    partly = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("_start"))).cast("long")
    words = F.col("passes") * F.col("source_size") + F.col("rest")
    at = lambda i: training_position((i * F.col("source_size") + F.col("_start")) / words, F.col("pieces"))
    whole = F.transform(
        F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda i: F.struct(F.col("size").alias("words"), at(i).alias("position")),
    )
    rest = F.when(F.col("_partly") > 0, F.array(F.struct(F.col("_partly").alias("words"), at(F.col("passes")).alias("position"))))
    none = F.array().cast("array<struct<words:bigint,position:double>>")
    copies = F.when(F.col("size") > 0, F.concat(whole, F.coalesce(rest, none))).otherwise(none)
    return (
        joined.withColumn("_start", start)
        .withColumn("_partly", partly)
        .withColumn("copies", copies)
        .select(
            "doc_id", "source", *keep, "size", "source_size", "target",
            (F.col("passes") * F.col("size") + F.col("_partly")).alias("taken"), "copies",
        )
    )


def in_training_order(taken: DataFrame) -> DataFrame:
    """The rows of ``assign`` by the ``first_position`` of their copies (a range sort); what is not taken comes last."""
    first = F.try_element_at("copies", F.lit(1)).getField("position")
    return taken.withColumn("first_position", first).orderBy(F.asc_nulls_last("first_position"), "doc_id")


def mixed_documents(docs: DataFrame, weight: Callable[[int], float] = cyclic_weight, schedule: Callable[[int], Knots] = cyclic_schedule, cap: float = 3.0) -> DataFrame:
    """The mix itself in training order: a row for each copy, the last one cut to its words."""
    taken = assign(docs, ["text", "lang", "n_chars"], weight, schedule, cap)
    copies = taken.select("*", F.explode("copies").alias("copy"))
    words = F.col("copy.words")
    # Pieces of one word and the white space behind it.
    pieces = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    text = F.when(words >= F.col("size"), F.col("text")).otherwise(cut)
    return (
        copies.withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("long"))
        .orderBy("copy.position", "doc_id")
        .select("doc_id", "text", "lang", "source", "n_chars")
    )
