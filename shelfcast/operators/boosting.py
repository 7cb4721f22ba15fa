"""Global Tweedie model: Newton boosting over binned features.

Scores F are logarithms of the mean. The inputs are binned once, into a stored table of one byte for each feature
of a row. A record of that table holds the columns of up to ``BLOCK_ROWS`` rows as bytes, so that a pass hands
arrays to Python and not rows. Every level of a tree is one grouped sum: tasks add up first and second derivatives of
the Tweedie deviance by (node, feature, bin), the parts of a node and feature meet in one task, which returns their best
split. So what leaves a task depends on the size of the tree and not on the rows, and the driver sees one row for
each node and feature. A leaf is worth -sum(g) / (sum(h) + l2).

Finished trees are flat arrays of nodes. Scores are brought up to date in the stored table every ``CUT_EVERY`` rounds, and
in between each pass adds the newest trees. Validation errors of these rounds come from one pass too. With a
``log`` folder the rounds so far are kept there, and a later fit with the same inputs goes on from them.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.fixed_values import BOOSTING_DEFAULTS, FEATURES, TWEEDIE_POWER
from shelfcast.session import shared_folder

MISSING = -1.0
CUT_EVERY = 10
MAX_BINS = 256
BLOCK_ROWS = 10_000
PASS_ROWS = 1 << 16  # rows that a task adds up at a time
KEYS_A_TASK = 64  # sums of a node and feature, 6 KB each, that meet in one task
QUANTILE_ERROR = 0.002


def gradient(sales: Column, score: Column, power: float = TWEEDIE_POWER) -> Column:
    return F.exp((2 - power) * score) - sales * F.exp((1 - power) * score)


def hessian(sales: Column, score: Column, power: float = TWEEDIE_POWER) -> Column:
    return (2 - power) * F.exp((2 - power) * score) + (power - 1) * sales * F.exp((1 - power) * score)


def deviance(sales: Column, score: Column, power: float = TWEEDIE_POWER) -> Column:
    """Mean Tweedie loss up to a constant of the data."""
    fit = F.exp((2 - power) * score) / (2 - power)
    return F.avg(fit - sales * F.exp((1 - power) * score) / (1 - power))


def derivatives(sales: np.ndarray, score: np.ndarray, power: float = TWEEDIE_POWER) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the deviance by the score."""
    up, down = np.exp((2 - power) * score), sales * np.exp((1 - power) * score)
    return up - down, (2 - power) * up + (power - 1) * down


@dataclass
class Tree:
    """Nodes as flat arrays; node i has the children ``left[i]`` and ``left[i] + 1``, a leaf has -1 there.

    ``feature`` counts all inputs of the model. A row goes right where its value is above ``threshold``, and so
    where its bin is above ``bin``.
    """

    feature: list[int]
    bin: list[int]
    threshold: list[float]
    left: list[int]
    value: list[float]
    gain: list[float]

    def leaf_of(self, inputs: np.ndarray, binned: bool) -> np.ndarray:
        """Node in which each column of the (features, rows) matrix ends."""
        if binned and len(self.left) <= 256:
            # Children come after their parents: one sweep of byte operations over the nodes moves every row to its leaf.
            node = np.zeros(inputs.shape[1], np.uint8)
            for i, (f, cut, left) in enumerate(zip(self.feature, self.bin, self.left)):
                if left >= 0:
                    here = (node == i).view(np.uint8)
                    node += here * np.uint8(left - i) + (here & (inputs[f] > cut).view(np.uint8))
            return node
        feature, left = np.array(self.feature), np.array(self.left)
        cut = np.where(left < 0, np.inf, np.array(self.bin if binned else self.threshold, float))
        # A leaf leads to itself: nothing lies above its cut.
        left = np.where(left < 0, np.arange(left.size), left)
        node, rows = np.zeros(inputs.shape[1], np.int64), np.arange(inputs.shape[1])
        while True:
            following = left[node] + (inputs[feature[node], rows] > cut[node])
            if (following == node).all():
                return node
            node = following

    def scores(self, inputs: np.ndarray, binned: bool) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(inputs, binned)]


@dataclass
class TweedieModel:
    params: dict
    feature_cols: list[str]
    start: float
    trees: list[Tree] = field(default_factory=list)
    history: list[dict] = field(default_factory=list)

    def inputs(self, df: DataFrame) -> Column:
        """The inputs as an array of numbers; missing inputs and values become -1."""
        value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) if c in df.columns else F.lit(MISSING)
        return F.array(*[value(c) for c in self.feature_cols])

    def score(self, df: DataFrame, trees: int | None = None) -> DataFrame:
        """The rows with a ``score`` by the first trees, or all; one pass of one function, however many trees there are."""
        start, used, width = self.start, self.trees[:trees], len(self.feature_cols)

        @F.pandas_udf("double")
        def scored(rows: pd.Series) -> pd.Series:
            inputs = np.array(rows.to_list(), float).reshape(-1, width).T
            total = np.full(inputs.shape[1], start)
            for tree in used:
                total += tree.scores(inputs, False)
            return pd.Series(total)

        return df.withColumn("score", scored(self.inputs(df)))

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with a ``forecast``, in one pass without a shuffle."""
        return self.score(df).withColumn("forecast", F.exp("score")).drop("score")

    def importance(self) -> dict[str, float]:
        """Total gain of each feature over all splits."""
        totals = dict.fromkeys(self.feature_cols, 0.0)
        for tree in self.trees:
            for feature, left, gain in zip(tree.feature, tree.left, tree.gain):
                if left >= 0:
                    totals[self.feature_cols[feature]] += gain
        return totals

    def importance_table(self, spark: SparkSession) -> DataFrame:
        rows = list(self.importance().items())
        table = spark.createDataFrame(rows, "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature")

    def spec(self) -> dict:
        return {c: getattr(self, c) for c in ("params", "feature_cols", "start", "history")} | {"trees": [vars(t) for t in self.trees]}

    @classmethod
    def of_spec(cls, spec: dict) -> "TweedieModel":
        return cls(**spec | {"trees": [Tree(**t) for t in spec["trees"]]})

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees and parameters in one committed write: a reader sees the whole model or the one before."""
        write_note(spark, path, self.spec())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TweedieModel":
        return cls.of_spec(read_note(spark, path))


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """Append a note to a folder; the newest one counts, and older ones stay readable until it is complete."""
    rows = [(next_number(spark, path), json.dumps(note))]
    spark.createDataFrame(rows, "number long, note string").coalesce(1).write.mode("append").parquet(path)


def notes(spark: SparkSession, path: str) -> DataFrame | None:
    """All notes of a folder; None where there is no folder yet."""
    try:
        return spark.read.schema("number long, note string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def next_number(spark: SparkSession, path: str) -> int:
    found = notes(spark, path)
    return 0 if found is None else (found.agg(F.max("number")).first()[0] or 0) + 1


def read_note(spark: SparkSession, path: str) -> dict | None:
    found = notes(spark, path)
    newest = None if found is None else found.orderBy(F.desc("number")).select("note").first()
    return json.loads(newest[0]) if newest else None


def bin_edges(df: DataFrame, model: TweedieModel, max_bins: int) -> list[list[float]]:
    """Ascending cuts of each feature between its quantiles; a value's bin is the number of cuts below it."""
    wide = df.select(model.inputs(df).alias("x")).select(*[F.col("x")[i].alias(f"f{i}") for i in range(len(model.feature_cols))])
    marks = [i / max_bins for i in range(1, max_bins)]
    quantiles = wide.approxQuantile(wide.columns, marks, QUANTILE_ERROR)
    return [sorted(set(own)) for own in quantiles]


BINNED = "n int, row binary, sales binary, score binary, bins binary"


def stored(blocks: DataFrame) -> DataFrame:
    """The blocks as a table in the shared folder.

    It is not compressed, so that a split has in memory the size that it has on disk, whatever the values are, and
    small row groups let several tasks read one file.
    """
    spark = blocks.sparkSession
    path = f"{shared_folder(spark)}/blocks-{uuid.uuid4().hex}"
    blocks.write.options(**{"compression": "none", "parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}).parquet(path)
    return spark.read.schema(BINNED).parquet(path)


def binned(df: DataFrame, model: TweedieModel, edges: list[list[float]]) -> DataFrame:
    """Stored blocks of row numbers, sales, scores and a (features, rows) matrix of one byte each."""
    cuts, start = [np.array(e) for e in edges], model.start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in larger(batches, BLOCK_ROWS):
            values = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            row, sales = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cells = np.stack([np.searchsorted(own, values[:, f], "left").astype(np.uint8) for f, own in enumerate(cuts)])
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = slice(at, at + BLOCK_ROWS)
                yield block(row[part], sales[part], np.full(row[part].size, start), cells[:, part])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col("sales").cast("double").alias("sales"), model.inputs(df).alias("x"))
    return stored(rows.mapInArrow(run, BINNED))


def block(*columns: np.ndarray) -> pa.RecordBatch:
    """One record with the bytes of the columns of some rows."""
    data = [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([columns[0].size], pa.int32()), *data], [c.split()[0] for c in BINNED.split(", ")])


def larger(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least ``rows``, so that what is done once for each of them weighs less."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """Row numbers, sales, scores and (features, rows) matrix of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column(0)[i].as_py()
            row, sales, score, bins = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in ((1, np.int64), (2, float), (3, float), (4, np.uint8)))
            yield row, sales, score, bins.reshape(-1, n)


def unpacked(batches: Iterator[pa.RecordBatch], trees: list[Tree]) -> Iterator[Rows]:
    """Some blocks at a time as one, with the scores of ``trees`` added."""

    def joined(held: list[Rows]) -> Rows:
        row, sales, score, cells = (np.concatenate(c, axis=-1) for c in zip(*held))
        for tree in trees:
            score += tree.scores(cells, True)
        return row, sales, score, cells

    held: list[Rows] = []
    for own in blocks_of(batches):
        held.append(own)
        if sum(h[0].size for h in held) >= PASS_ROWS:
            yield joined(held)
            held = []
    if held:
        yield joined(held)


def drawn(row: np.ndarray, seed: int, fraction: float) -> np.ndarray:
    """Whether a row is in the bag of a round; it depends on the row number only, so a repeated task draws the same."""
    h = row.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(11) < fraction * (1 << 53)


def histograms(rows: DataFrame, trees: list[Tree], growing: Tree, open_nodes: list[int], columns: list[int], edges: list[list[float]], seed: int, params: dict) -> DataFrame:
    """Sums of g, h and rows by (node, feature, bin) of each task, as the bytes of a (3, bins) matrix."""
    place = np.full(len(growing.left), -1)
    place[open_nodes] = np.arange(len(open_nodes))
    fraction, n_bins = params["bagging_fraction"], [len(edges[f]) + 1 for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((3, len(open_nodes) * n)) for n in n_bins]
        for row, sales, score, cells in unpacked(batches, trees):
            node = place[growing.leaf_of(cells, True)]
            used = np.flatnonzero((node >= 0) if fraction >= 1 else (node >= 0) & drawn(row, seed, fraction))
            g, h = derivatives(sales[used], score[used])
            node = node[used]
            for own, f, n in zip(total, columns, n_bins):
                at = node * n + cells[f][used]
                own[0] += np.bincount(at, g, minlength=own.shape[1])
                own[1] += np.bincount(at, h, minlength=own.shape[1])
                own[2] += np.bincount(at, minlength=own.shape[1])
        split = [own.reshape(3, len(open_nodes), -1).transpose(1, 0, 2) for own in total]
        node, column = np.divmod(np.arange(len(open_nodes) * len(columns)), len(columns))
        sums = pa.array([np.ascontiguousarray(split[c][k]).tobytes() for k, c in zip(node, column)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(column, pa.int32()), sums], ["node", "column", "sums"])

    return rows.mapInArrow(run, "node int, column int, sums binary")


SPLIT = "node int, column int, cut int, gain double, g double, h double, left_g double, left_h double"


def best_splits(parts: DataFrame, params: dict, tasks: int) -> DataFrame:
    """The best cut of each node and feature; ``gain`` is null where none keeps enough rows on both sides."""
    l2, least = params["l2"], params["min_rows_per_leaf"]
    worth = lambda g, h: g**2 / (h + l2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for node, column, part in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(part).reshape(3, -1)
                sums[node, column] = sums[node, column] + own if (node, column) in sums else own
        if not sums:
            return
        found = []
        for key, own in sums.items():
            g, h, n = np.cumsum(own, axis=1)
            gain = worth(g, h) + worth(g[-1] - g, h[-1] - h) - worth(g[-1], h[-1])
            gain[(n < least) | (n[-1] - n < least)] = -np.inf
            cut = int(gain.argmax())
            found.append((*key, cut, float(gain[cut]) if np.isfinite(gain[cut]) else None, g[-1], h[-1], g[cut], h[cut]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), [pa.int32()] * 3 + [pa.float64()] * 5)], [c.split()[0] for c in SPLIT.split(", ")])

    return parts.repartition(tasks, "node", "column").mapInArrow(run, SPLIT)


def grow_tree(rows: DataFrame, trees: list[Tree], edges: list[list[float]], columns: list[int], params: dict, seed: int) -> Tree:
    """One tree, a level at a time; every level is one pass over the rows."""
    tree = Tree([0], [0], [0.0], [-1], [0.0], [0.0])
    value = lambda g, h: -params["learning_rate"] * g / (h + params["l2"])
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_nodes = [0]
    for depth in range(params["max_depth"]):
        parts = histograms(rows, trees, tree, open_nodes, columns, edges, seed, params)
        best: dict[int, tuple] = {}
        for r in best_splits(parts, params, min(tasks, math.ceil(len(open_nodes) * len(columns) / KEYS_A_TASK))).collect():
            if depth == 0:
                tree.value[0] = value(r["g"], r["h"])
            # A cut behind the last edge separates nothing; equal gains go to the first feature.
            if r["gain"] is not None and r["gain"] > 1e-12 and r["cut"] < len(edges[columns[r["column"]]]):
                best[r["node"]] = max(best.get(r["node"], (0.0,)), (r["gain"], -r["column"], r["cut"], r["g"], r["h"], r["left_g"], r["left_h"]))
        fresh = []
        for i, (gain, column, cut, g, h, left_g, left_h) in sorted(best.items()):
            node, feature = open_nodes[i], columns[-column]
            tree.feature[node], tree.bin[node], tree.threshold[node] = feature, cut, edges[feature][cut]
            tree.left[node], tree.gain[node] = len(tree.left), gain
            for own_g, own_h in ((left_g, left_h), (g - left_g, h - left_h)):
                fresh.append(len(tree.left))
                for own, v in ((tree.feature, 0), (tree.bin, 0), (tree.threshold, 0.0), (tree.left, -1), (tree.value, value(own_g, own_h)), (tree.gain, 0.0)):
                    own.append(v)
        open_nodes = fresh
        if not open_nodes:
            break
    return tree


def brought_up(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """The stored table with the scores of further trees added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, sales, score, cells in blocks_of(batches):
            score = score.copy()
            for tree in trees:
                score += tree.scores(cells, True)
            yield block(row, sales, score, cells)

    return stored(rows.mapInArrow(run, BINNED))


def round_errors(rows: DataFrame, trees: list[Tree]) -> list[tuple[float, float]]:
    """(mean deviance, root mean squared error) after each of the trees, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(trees), 3))
        for _, sales, score, cells in unpacked(batches, []):
            for i, tree in enumerate(trees):
                score += tree.scores(cells, True)
                up, down = np.exp((2 - TWEEDIE_POWER) * score), np.exp((1 - TWEEDIE_POWER) * score)
                loss = up / (2 - TWEEDIE_POWER) - sales * down / (1 - TWEEDIE_POWER)
                total[i] += loss.sum(), ((sales - np.exp(score)) ** 2).sum(), sales.size
        yield pa.RecordBatch.from_arrays([pa.array(range(len(trees)), pa.int32()), *(pa.array(c.copy()) for c in total.T)], ["tree", "loss", "squares", "n"])

    parts = rows.mapInArrow(run, "tree int, loss double, squares double, n double")
    found = parts.groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("loss", "squares", "n")]).orderBy("tree").collect()
    return [(r["loss"] / max(r["n"], 1), math.sqrt(r["squares"] / max(r["n"], 1))) for r in found]


def stopping_round(errors: list[float], patience: int) -> int | None:
    """The round after which training stops: the best one plus ``patience``, if that has been reached."""
    best, best_round = math.inf, 0
    for i, error in enumerate(errors, 1):
        if error < best:
            best, best_round = error, i
        elif i - best_round >= patience:
            return i
    return None


@dataclass
class Progress:
    """What a later fit needs to go on: the model so far, the cuts and the stored tables."""

    model: TweedieModel
    edges: list[list[float]]
    train: DataFrame
    val: DataFrame | None

    def write(self, spark: SparkSession, path: str, key: str) -> None:
        files = {n: list(t.inputFiles()) for n, t in (("train", self.train), ("val", self.val)) if t is not None}
        write_note(spark, path, {"model": self.model.spec(), "edges": self.edges, "files": files, "key": key})

    @classmethod
    def read(cls, spark: SparkSession, path: str, key: str) -> "Progress | None":
        note = read_note(spark, path)
        if note is None or note["key"] != key:
            return None
        table = lambda n: spark.read.schema(BINNED).parquet(*note["files"][n]) if n in note["files"] else None
        return cls(TweedieModel.of_spec(note["model"]), note["edges"], table("train"), table("val"))


def started(train: DataFrame, val: DataFrame | None, columns: list[str], params: dict) -> Progress:
    mean = train.agg(F.avg(F.col("sales").cast("double"))).first()[0]
    model = TweedieModel(params, columns, math.log(max(mean or 0.0, 1e-9)))
    needed = lambda df: df.select("sales", *[c for c in columns if c in df.columns]).filter(F.col("sales").isNotNull())
    edges = bin_edges(needed(train), model, params["max_bins"])
    return Progress(model, edges, binned(needed(train), model, edges), None if val is None else binned(needed(val), model, edges))


def fit_tweedie(
    train: DataFrame,
    val: DataFrame | None = None,
    feature_cols: list[str] | None = None,
    early_stopping_rounds: int = 50,
    seed: int = 42,
    log: str | None = None,
    **params,
) -> TweedieModel:
    """Train on prepared features; stop when the validation RMSE no longer falls.

    ``history`` has the training loss and the validation RMSE of every round up to the one that stops;
    the model keeps the trees up to the best round. Rows without sales take no part. With a ``log`` folder,
    the rounds are written there every ``CUT_EVERY`` rounds, and a fit with equal parameters goes on from them.
    """
    spark = train.sparkSession
    params = BOOSTING_DEFAULTS | {"max_bins": MAX_BINS} | params
    columns = feature_cols or [c for c in FEATURES if c in train.columns]
    key = json.dumps([params, columns, early_stopping_rounds, seed], sort_keys=True)
    now = (Progress.read(spark, log, key) if log else None) or started(train, val, columns, params)
    model, width = now.model, len(columns)
    kept = max(1, round(params["feature_fraction"] * width))
    stop = None
    while stop is None and len(model.trees) < params["rounds"]:
        done = len(model.trees)
        for i in range(done, min(done + CUT_EVERY, params["rounds"])):
            chosen = sorted(int(c) for c in np.random.default_rng((seed, i)).choice(width, kept, replace=False))
            model.trees.append(grow_tree(now.train, model.trees[done:], now.edges, chosen, params, seed + i))
        fresh = model.trees[done:]
        losses = round_errors(now.train, fresh)
        errors = round_errors(now.val, fresh) if now.val is not None else [(None, None)] * len(fresh)
        model.history += [{"round": done + i + 1, "train_loss": a[0], "val_rmse": b[1]} for i, (a, b) in enumerate(zip(losses, errors))]
        if now.val is not None:
            stop = stopping_round([h["val_rmse"] for h in model.history], early_stopping_rounds)
        if stop is None and len(model.trees) < params["rounds"]:
            now.train = brought_up(now.train, fresh)
            now.val = None if now.val is None else brought_up(now.val, fresh)
            if log:
                now.write(spark, log, key)
    if stop is not None:
        model.history = model.history[:stop]
    if now.val is not None and model.history:
        model.trees = model.trees[: min(model.history, key=lambda h: h["val_rmse"])["round"]]
    return model


def history_table(model: TweedieModel, spark: SparkSession) -> DataFrame:
    rows = [(h["round"], h["train_loss"], h["val_rmse"]) for h in model.history]
    return spark.createDataFrame(rows, "round int, train_loss double, val_rmse double")


def top_features(importance: DataFrame, n: int = 25) -> DataFrame:
    """The features with the largest gain; names break ties."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
