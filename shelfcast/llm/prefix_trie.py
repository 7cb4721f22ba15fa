"""Prefix trie of conversations from padded turn-id matrices.

Every conversation becomes a row of turn ids (128 bits of role and text each) and text lengths; texts
themselves are not shuffled. Rows are dealt to range shards by (ids, conv_id), so that a node's members
stand together and even equal conversations can be split. In a shard, ids are laid out as padded matrices of
``WIDTH`` turns at a time and sorted by numpy's lexsort; the accumulated OR of the columns' change masks marks where
the nodes of every depth start, and reduceat sums them up. Longer conversations take part in further
matrices, so memory follows the rows that are still that long.

Only the nodes of a shard's first and last row can have members elsewhere. These boundary nodes carry a
key (a hash of their path) and sums over the other nodes below them. They are added up by key; what a boundary
node itself adds to its ancestors is counted in the one path that owns it, as a running sum from the deepest node up.

The members that end at a node are hashed in order: range shards hold them in rising conv_id, so a boundary
node's are streamed shard by shard, in pieces, and no list of them is held whole.

Rows of a null ``conv_id`` take no part. Null turns come first; turns of equal number are ordered by role,
then by turn id, so reruns agree. A null role or text is an empty one, a repeated row another turn. An empty table has
no nodes, not even a root. Other columns are not read. Texts count whole, by their hash and UTF-8 length.
A conversation's turns have to fit in one task, at some 20 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh_folder
from shelfcast.session import cut_lineage

WIDTH = 16
SHARD_TURNS = 500_000
PIECE = 512
PAD = np.iinfo(np.int64).min
NOTHING = hashlib.sha256().hexdigest()
KIND = "shard int, path int, key binary, parent binary, counted boolean, piece long, conv_id long, depth long, parent_conv_id long, "
KIND += "n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, ends string, kind string"
COUNTS = ("n_children", "n_leaves", "saved_tokens")
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def own_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its turns in order: id (two longs) and UTF-8 length of each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    # The pad is the least long; no id may equal it.
    name = lambda *seed: F.greatest(F.xxhash64(*seed, role, text), F.lit(PAD + 1))
    turn = F.struct(F.col("turn"), role.alias("role"), name().alias("a"), name(F.lit("second")).alias("b"), F.octet_length(text).alias("n"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("turns"))


def rebuilt(own: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % ``family`` and goes on with its own after h; h = crc32(c) % ``heads``."""
    base = F.col("conv_id") - F.col("conv_id") % family
    first = own.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = own.withColumn("base", base).join(first, "base", "left").withColumn("h", h)
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def sorted_order(ids: np.ndarray, offset: np.ndarray, length: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows by their sequences, shorter ones first, ties by ``conv``."""
    order = np.argsort(conv, kind="stable")
    run, at = np.zeros(order.size, np.int64), 0
    while (length > at).any():
        # Rows that end here have only padding in this matrix and so come first in their run.
        place = np.flatnonzero(length[order] >= at)
        cells = padded(ids, offset, length, order[place], at)
        by = np.lexsort((*cells.reshape(place.size, -1).T[::-1], run[place]))
        order[place], cells = order[place][by], cells[by]
        run[place] = np.cumsum(change_mask(cells, np.append(True, run[place][1:] != run[place][:-1]))[:, -1])
        at += WIDTH
    return order


def padded(ids: np.ndarray, offset: np.ndarray, length: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """Turn ids ``at`` to ``at + WIDTH`` of the rows as a (rows, WIDTH, 2) matrix."""
    column = at + np.arange(WIDTH)
    there = column < length[rows, None]
    cells = np.full((rows.size, WIDTH, 2), PAD, np.int64)
    cells[there] = ids[(offset[rows, None] + column)[there]]
    return cells


def change_mask(cells: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether a row and the one above it differ up to and with each column; ``new``: they do before the first one."""
    differs = np.ones(cells.shape[:2], bool)
    differs[1:] = (cells[1:] != cells[:-1]).any(axis=2)
    differs[:, 0] |= new
    return np.logical_or.accumulate(differs, axis=1)


class Level:
    """The nodes of one depth, in order: first position, position behind the last member, and what they count."""

    def __init__(self, start: np.ndarray, stop: np.ndarray, conv: np.ndarray, ends: np.ndarray, n_bytes: np.ndarray, rows: int) -> None:
        self.start, self.n, self.conv, self.ends, self.bytes = start, stop - start, conv, ends, n_bytes
        self.boundary = (start == 0) | (stop == rows)
        self.children, self.leaves, self.saved, self.parent = (np.zeros(start.size, np.int64) for _ in range(4))


def levels_of(ids: np.ndarray, n_bytes: np.ndarray, offset: np.ndarray, length: np.ndarray, conv: np.ndarray) -> list[Level]:
    """Nodes of every depth over rows in sorted order; sums of boundary nodes leave out boundary nodes."""
    rows = conv.size
    levels = [Level(np.zeros(1, np.int64), np.array([rows]), conv.min(keepdims=True), np.array([(length == 0).sum()]), np.zeros(1, np.int64), rows)]
    new, at = np.zeros(rows, bool), 0
    new[0] = True
    while (length > at).any():
        place = np.flatnonzero(length > at)
        apart = np.append(True, np.diff(place) > 1)
        mask = change_mask(padded(ids, offset, length, place, at), new[place] | apart)
        for j in range(WIDTH):
            here = np.flatnonzero(length[place] > at + j)
            if not here.size:
                break
            first = np.flatnonzero(mask[here, j])
            members = place[here]
            start = members[first]
            stop = members[np.append(first[1:], here.size) - 1] + 1
            low = np.minimum.reduceat(conv[members], first)
            ends = np.add.reduceat((length[members] == at + j + 1).astype(np.int64), first)
            levels.append(Level(start, stop, low, ends, n_bytes[offset[start] + at + j], rows))
        new[place] = mask[:, -1]
        at += WIDTH
    for above, level in zip(levels[-2::-1], levels[:0:-1]):
        close(level)
        level.parent = np.searchsorted(above.start, level.start, "right") - 1
        np.add.at(above.children, level.parent, ~level.boundary)
        np.add.at(above.leaves, level.parent, level.leaves)
        np.add.at(above.saved, level.parent, level.saved)
    return levels


def close(level: Level) -> None:
    """Add what the nodes themselves count; boundary nodes do so only when their parts are together."""
    inner = ~level.boundary
    level.leaves[inner & (level.children == 0)] = 1
    level.saved[inner] += (level.n[inner] - 1) * level.bytes[inner]


def path_keys(ids: np.ndarray) -> list[bytes]:
    """Names of the nodes on a row's path, from the root."""
    state, keys = hashlib.blake2b(digest_size=16), []
    keys.append(state.digest())
    for turn in ids:
        state.update(turn.tobytes())
        keys.append(state.digest())
    return keys


def joined_ids(conv: np.ndarray) -> str:
    return ",".join(map(str, conv.tolist()))


def shard_nodes(shard: int, conv: np.ndarray, length: np.ndarray, ids: np.ndarray, n_bytes: np.ndarray) -> Iterator[dict[str, list]]:
    """Rows of one shard's result: inner nodes, boundary nodes and pieces of the latter's ends."""
    offset = np.cumsum(length) - length
    order = sorted_order(ids, offset, length, conv)
    conv, length, offset = conv[order], length[order], offset[order]
    levels = levels_of(ids, n_bytes, offset, length, conv)
    paths = [path_keys(ids[offset[i] : offset[i] + length[i]]) for i in (0, -1)]

    def path_at(depth: int, node: int) -> int:
        return 0 if length[0] >= depth and node == 0 else 1

    for depth, level in enumerate(levels):
        inner = np.flatnonzero(~level.boundary)
        if inner.size:
            above = levels[depth - 1]
            up = level.parent[inner]
            open_ = above.boundary[up]
            own = [hashlib.sha256(joined_ids(conv[s : s + e]).encode()).hexdigest() if e else NOTHING for s, e in zip(level.start[inner].tolist(), level.ends[inner].tolist())]
            yield {
                "kind": ["inner"] * inner.size, "shard": [shard] * inner.size, "conv_id": level.conv[inner], "depth": [depth] * inner.size,
                "parent": [paths[path_at(depth - 1, p)][depth - 1] if o else None for p, o in zip(up.tolist(), open_.tolist())],
                "parent_conv_id": [None if o else c for o, c in zip(open_.tolist(), above.conv[up].tolist())],
                "n_convs": level.n[inner], "n_children": level.children[inner], "n_leaves": level.leaves[inner],
                "saved_tokens": level.saved[inner], "ends": own,
            }
        for path, row in ((0, 0), (1, -1)):
            if length[row] < depth:
                continue
            node = 0 if path == 0 else level.start.size - 1
            key, counted = paths[path][depth], path == path_at(depth, node)
            yield {
                "kind": ["boundary"], "shard": [shard], "path": [path], "key": [key], "parent": [paths[path][depth - 1] if depth else None],
                "counted": [counted], "conv_id": level.conv[[node]], "depth": [depth], "n_convs": level.n[[node]], "n_children": level.children[[node]],
                "n_leaves": level.leaves[[node]], "saved_tokens": level.saved[[node]], "bytes": level.bytes[[node]],
            }
            if counted and level.ends[node]:
                ended = conv[level.start[node] : level.start[node] + level.ends[node]]
                pieces = [joined_ids(ended[i : i + PIECE]) for i in range(0, ended.size, PIECE)]
                yield {"kind": ["ends"] * len(pieces), "shard": [shard] * len(pieces), "piece": list(range(len(pieces))), "key": [key] * len(pieces), "ends": pieces}


def sharded(rows: DataFrame, shard_turns: int) -> DataFrame:
    """Nodes and boundary parts of range shards of (conv_id, turns), stored once so that all readers see the same shards."""
    spark = rows.sparkSession
    ids = F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"])))
    rows = cut_lineage(rows.select("conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["n"]).alias("sizes")))
    turns = rows.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    dealt = rows.repartitionByRange(parts, "ids", "conv_id").withColumn("shard", F.spark_partition_id())
    names = [f.split()[0] for f in KIND.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in KIND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        flat = lambda name: np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table[name].chunks]).astype(np.int64)
        length = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in table["sizes"].chunks]).astype(np.int64)
        found = shard_nodes(table["shard"][0].as_py(), table["conv_id"].to_numpy(), length, flat("ids").reshape(-1, 2), flat("sizes"))
        for part in found:
            n = len(part["kind"])
            yield pa.RecordBatch.from_arrays([pa.array(part[c], schema.field(c).type) if c in part else pa.nulls(n, schema.field(c).type) for c in names], schema=schema)

    path = fresh_folder(spark, "trie")
    dealt.mapInArrow(run, KIND).write.partitionBy("kind").parquet(path)
    return spark.read.schema(KIND).parquet(path)


def hashed_ends(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each key's pieces in order, comma-joined; a key's pieces flow through one hash and are not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        done = lambda: pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [state.hexdigest()]})
        for batch in batches:
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        yield done()
                    key, state = k, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
        if key is not None:
            yield done()

    dealt = pieces.repartition("key").sortWithinPartitions("key", "shard", "piece")
    return dealt.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def joined_boundary(parts: DataFrame) -> DataFrame:
    """One row for each boundary node, by its key, over all shards."""
    counted = parts.filter("counted")
    sums = [F.sum(c).alias(c) for c in ("n_convs", *COUNTS)]
    owner = F.min(F.struct("shard", "path")).alias("owner")
    nodes = counted.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("bytes").alias("bytes"), owner, *sums)
    kids = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("kids"))
    nodes = nodes.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    return cut_lineage(nodes.drop("kids"))


def with_own_parts(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves and saved bytes of boundary nodes, with those of the boundary nodes at and below them."""
    here = F.struct("shard", "path") == F.col("owner")
    own = lambda value: F.when(here, value).otherwise(F.lit(0))
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    known = nodes.select("key", "owner", "n_convs", "n_children", "bytes")
    steps = parts.select("shard", "path", "key", "depth").join(known, "key").select(
        "shard", "path", "key", "depth", own((F.col("n_children") == 0).cast("long")).alias("leaf"), own(saved).alias("saved")
    )
    below = Window.partitionBy("shard", "path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("key", F.sum("leaf").over(below).alias("leaf"), F.sum("saved").over(below).alias("saved"))
    sums = steps.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    joined = nodes.join(sums, "key")
    return joined.withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("saved")})


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie over (conv_id, turns); see ``RESULT`` for the columns."""
    stored = sharded(rows, shard_turns)
    parts = stored.filter(F.col("kind") == "boundary")
    nodes = joined_boundary(parts)
    names = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("named"))
    # Inner nodes look up a boundary parent by shard and key, so no key has more rows than a shard.
    by_shard = parts.filter("counted").select("shard", "key").join(nodes.select("key", F.col("conv_id").alias("named")), "key")
    by_shard = by_shard.select("shard", F.col("key").alias("parent"), "named")
    inner = stored.filter(F.col("kind") == "inner")
    columns: list[str | Column] = ["conv_id", "depth", F.coalesce("parent_conv_id", "named").alias("parent_conv_id"), "n_convs", *COUNTS]
    inner = inner.join(by_shard, ["shard", "parent"], "left").select(*columns, F.col("ends").alias("ends_sha256"))
    ends = hashed_ends(stored.filter(F.col("kind") == "ends").select("key", "shard", "piece", "ends"))
    outer = with_own_parts(parts, nodes).join(names, "parent", "left").join(ends, "key", "left")
    outer = outer.select("conv_id", "depth", F.col("named").alias("parent_conv_id"), "n_convs", *COUNTS, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    return inner.unionByName(outer).select(*RESULT)


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie over conversations that share the heads of their families."""
    return trie(rebuilt(cut_lineage(own_turns(conversations))), shard_turns)
