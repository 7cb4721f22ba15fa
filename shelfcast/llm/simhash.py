"""SimHash near-duplicate detection with BK-trees.

A fingerprint has a bit set if more than half of the hashes of a text's word shingles
have it. Texts whose fingerprints differ in at most ``radius`` = 2 bits are linked; a
group is what links reach.

Distinct fingerprints are sharded so that every pair within the radius shares a shard:
of four 16-bit blocks such a pair has two in common, so each fingerprint goes to the
six shards that its pairs of blocks name. A shard's BK-tree (children keyed by integer
Hamming distance to the parent) is grown where its fingerprints meet; a search follows
only edges whose key is within the radius of its own distance. A shard that holds too
many fingerprints is cut again by the remaining bits, which leaves 65,536 fingerprints
at most. Broadcasting the trees to all executors, as the method has it, would grow with
the corpus; they are sent to the searches that can reach them instead. A shard reports at
most one link for each fingerprint, so groups of any size stay linear.

A null or empty text, or one without words, has fingerprint 0 and is linked like any
other. Texts of fewer words than a shingle are one shingle. Rows that repeat a
``doc_id`` are rows of their own; a null ``doc_id`` counts only if a group has no
other, and then the group's id is null. An empty table gives an empty one; other columns
are not read unless named in ``keep``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import slices, utf8
from shelfcast.llm.components import components
from shelfcast.session import cut_lineage

SEED = 42
RADIUS = 2
SHARD_ROWS = 1 << 16
BATCH_ROWS = 1 << 18
FRONTIER = 1 << 18


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Unsigned XXH64 of every word shingle, repeats included; none for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    last = max(1, len(words) - width + 1)
    starts = [0, *ends[: last - 1]]
    stops = [e - 1 for e in ends[width - 1 :]] or [len(joined)]
    hash64 = xxhash.xxh64_intdigest
    return np.fromiter((hash64(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=last)


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if more than half of the hashes have it."""
    set_in = np.zeros(64, dtype=np.int64)
    for at in range(0, hashes.size, 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > hashes.size, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned 64-bit fingerprint of UTF-8 bytes."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    names = ["doc_id", *keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in utf8(batch.column(0))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found.view(np.int64))], [*names, "fp"])

    return docs.select(F.col("text").alias("_text"), *names).mapInArrow(run, f"{kinds}, fp long")


def block(column: str, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(column, at * bits).bitwiseAND((1 << bits) - 1)


def shards(classes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard``, ``part`` and ``fp``: every fingerprint in each shard that it belongs to.

    ``shard`` names two equal 16-bit blocks. Where a shard is too large, ``part`` names two
    equal 8-bit blocks of the other four, so that at most 16 bits are left to differ.
    """
    pairs = list(itertools.combinations(range(4), 2))
    named = [
        F.struct(F.lit(n).alias("c"), (block("fp", i, 16) * 65536 + block("fp", j, 16) + F.lit(n << 32)).alias("shard"))
        for n, (i, j) in enumerate(pairs)
    ]
    rows = classes.select("fp", F.explode(F.array(*named)).alias("s")).select("fp", "s.c", "s.shard")
    large = rows.groupBy("shard").count().filter(F.col("count") > shard_rows).select("shard", F.lit(True).alias("large"))
    rows = rows.join(large, "shard", "left")
    cuts = F.lit(None).cast("array<bigint>")
    for n, pair in enumerate(pairs):
        bytes_left = [2 * i + k for i in range(4) if i not in pair for k in (0, 1)]
        parts = [
            block("fp", i, 8) * 256 + block("fp", j, 8) + F.lit((m + 1) << 16)
            for m, (i, j) in enumerate(itertools.combinations(bytes_left, 2))
        ]
        cuts = F.when(F.col("c") == n, F.array(*parts)).otherwise(cuts)
    part = F.when(F.col("large"), cuts).otherwise(F.array(F.lit(0).cast("long")))
    return rows.select("shard", F.explode(part).alias("part"), "fp")


class Forest:
    """A BK-tree for each group of fingerprints, grown and searched level by level.

    Each level of the growth gives every waiting fingerprint its distance to the node
    it stands at; the first of each distance becomes that node's child under this key, the
    others go down to it. That is what inserting one after the other would give.
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        """``group`` is ascending; fingerprints have one 64-bit word or a row of several."""
        self.fps = fps.reshape(len(fps), -1)
        self.keys = 64 * self.fps.shape[1] + 1
        first = np.concatenate(([True], group[1:] != group[:-1]))
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        parents, children = [], []
        waiting = np.flatnonzero(~first)
        at = self.root[waiting]
        while waiting.size:
            code = at * self.keys + self.distance(waiting, at)
            order = np.argsort(code, kind="stable")
            waiting, code = waiting[order], code[order]
            new = np.concatenate(([True], code[1:] != code[:-1]))
            child = waiting[new]
            parents.append(code[new])
            children.append(child)
            at = child[np.cumsum(new) - 1][~new]
            waiting = waiting[~new]
        code = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        child = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.codes, self.children = code[order], child[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.fps[a] ^ self.fps[b]).sum(axis=1, dtype=np.int64)

    def near(self, query: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, smaller node, distance) of fingerprint indexes within the radius, in bounded blocks."""
        stack = [(query, self.root[query])]
        while stack:
            query, node = stack.pop()
            if query.size > FRONTIER:
                half = query.size // 2
                stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            distance = self.distance(query, node)
            hit = (distance <= radius) & (node < query)
            if hit.any():
                yield query[hit], node[hit], distance[hit]
            low = np.searchsorted(self.codes, node * self.keys + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.codes, node * self.keys + np.minimum(distance + radius, self.keys - 1), "right")
            many = high - low
            total = int(many.sum())
            if total:
                offset = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
                stack.append((np.repeat(query, many), self.children[np.repeat(low, many) + offset]))


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of ``a`` and ``b``; a label is the index of the least member found so far."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            down = label[label]
            if (down == label).all():
                break
            label[:] = down


def linked(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For every fingerprint that some smaller one of its group reaches: itself and that one."""
    forest = Forest(fps, group)
    label = np.arange(fps.size)
    for start in range(0, fps.size, FRONTIER):
        for a, b, _ in forest.near(np.arange(start, min(fps.size, start + FRONTIER)), radius):
            join_labels(label, a, b)
    moved = np.flatnonzero(label != np.arange(fps.size))
    return fps[moved], fps[label[moved]]


def shard_links(radius: int):
    """Read rows sorted by shard, whole shards at a time, and emit the links found in them."""

    def links(fps: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        change = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
        group = np.cumsum(change) - 1
        several = np.bincount(group)[group] > 1
        a, b = linked(fps[several], group[several], radius) if several.any() else (fps[:0], fps[:0])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            held.append((batch.column(2).to_numpy().view(np.uint64), keys))
            if sum(f.size for f, _ in held) < BATCH_ROWS:
                continue
            fps, keys = np.concatenate([f for f, _ in held]), np.concatenate([k for _, k in held])
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield links(fps[:last], keys[:last])
            held = [(fps[last:], keys[last:])]
        if held:
            yield links(np.concatenate([f for f, _ in held]), np.concatenate([k for _, k in held]))

    return run


def groups(marked: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``fp``, ``root`` (the group's least fingerprint) and ``component_id`` of each distinct fingerprint of a stored table of (doc_id, fp)."""
    if radius > 2:
        raise ValueError("shards hold every pair only up to a radius of 2")
    classes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    placed = shards(classes, shard_rows).repartition("shard", "part").sortWithinPartitions("shard", "part", "fp")
    links = placed.mapInArrow(shard_links(radius), "a long, b long")
    roots = components(links)
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row."""
    marked = cut_lineage(fingerprints(docs, width))
    found = marked.join(groups(marked, radius), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")



def one_of_each(docs: DataFrame, width: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with the columns of ``docs``.

    It is the row with the smallest ``doc_id``, null ids last; of texts that share an id the one of the least
    hash, of equal rows any.
    """
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = cut_lineage(fingerprints(docs.select("doc_id", "text", tie.alias("tie")), width, ("tie",)))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie")
    stays = marked.join(groups(marked, radius), "fp").groupBy("root").agg(F.min(place).alias("stay"))
    stays = stays.select(F.col("stay.doc_id").alias("_stay_id"), F.col("stay.tie").alias("_stay_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("_stay_id")) & (F.col("_row_tie") == F.col("_stay_tie"))
    kept = docs.withColumn("_row_tie", tie).join(stays, same, "left_semi")
    one = F.row_number().over(Window.partitionBy("doc_id", "_row_tie").orderBy("_row_tie"))
    return kept.withColumn("_one", one).filter("_one = 1").select(*docs.columns)
