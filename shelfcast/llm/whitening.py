"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(scale * c) + offset. With the exact sums S of the n rows, a centred row is
(n x - S) / n, taken from whole numbers, so the large offset costs no digits. The bidiagonalisation alternates
Xv and X'u: a step is one pass over the rows, in which a task multiplies each centred row by a direction and adds up
the rows times these products, so only sums of one entry for each dimension leave it. The left vectors, one entry for each
row, are never stored: each is X times a short vector that follows the same recurrence. The right vectors are
orthogonalised against all earlier ones, twice. Steps end when the wanted singular values of the small bidiagonal matrix have
settled, or when all dimensions are used; where a product vanishes, a new direction is taken. The SVD of the
bidiagonal matrix gives the components and deviations.

Left out are rows whose vector is null or holds null or non-finite entries. Null and repeated ids are rows like any
other. Vectors of different lengths are fitted apart, each length with its own n; a vector without entries has no components.
Entries beyond 2^52 after scaling are taken as 2^52. Components without variance (eigenvalue 0 up to rounding) cannot be
scaled to 1 and are not returned, so equal rows or a single row give none. A ``deviation`` beyond a long is null.
An empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 52)
ROWS = 4096
TOLERANCE = 1e-13
RANK = 1e-12
SEED = 7


def whole_vectors(rows: DataFrame, name: str = "embedding") -> DataFrame:
    """``vec_id``, ``length`` and floor(scale * c) of the rows that take part; the offset is left to the centring."""
    vec = F.col(name).cast("array<double>")
    fine = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = rows.select("vec_id", vec.alias("vec")).filter(F.col("vec").isNotNull() & fine)
    bounded = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    whole = F.transform("vec", lambda c: F.floor(bounded(c)).cast("long"))
    return kept.select("vec_id", F.size("vec").alias("length"), whole.alias("x"))


def blocks(batches: Iterator[pa.RecordBatch], at: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Few rows at a time, with their vectors as a matrix."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, part.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def column_sums(rows: DataFrame, width: int, products: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the vector that ``products`` makes of a block; tasks add up first, then Spark by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, x in blocks(batches, 0, width):
            total += products(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["entry", "value"])

    parts = rows.select("x").mapInArrow(run, "entry long, value double")
    out = np.zeros(size)
    for entry, value in parts.groupBy("entry").agg(F.sum("value")).collect():
        out[entry] = value
    return out


@dataclass
class Fit:
    """Number of rows, sums of the entries without the offset, components (one a row), eigenvalues and trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def exact_sums(rows: DataFrame, width: int) -> np.ndarray:
    sums = rows.select(F.posexplode("x").alias("entry", "value")).groupBy("entry").agg(F.sum("value"))
    out = np.zeros(width, np.int64)
    for entry, value in sums.collect():
        out[entry] = value
    return out


def bidiagonalise(
    product: Callable[[np.ndarray], tuple[np.ndarray, float]], width: int, wanted: int
) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (one a row) and the upper bidiagonal matrix of X = U B V'.

    ``product`` gives X'Xq and |Xq|^2 for a direction q, in one pass over the rows.
    """
    rng = np.random.default_rng(SEED)

    def orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for b in basis:
                vector = vector - (vector @ b) * b
        return vector

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        vector = orthogonal(rng.standard_normal(width), basis)
        return vector / np.linalg.norm(vector)

    right, diagonal, above = [fresh([])], [], []
    left, beta, largest = np.zeros(width), 0.0, 0.0
    while True:
        # u_j = X p_j, with p_j = (v_j - beta_(j-1) p_(j-1)) / alpha_j.
        direction = right[-1] - beta * left
        image, square = product(direction)
        alpha = float(np.sqrt(max(square, 0.0)))
        largest = max(largest, alpha)
        gone = alpha <= RANK * largest or alpha == 0.0
        diagonal.append(0.0 if gone else alpha)
        left = np.zeros(width) if gone else direction / alpha
        if len(right) == width:
            break
        rest = np.zeros(width) if gone else orthogonal(image / alpha - alpha * right[-1], right)
        beta = float(np.linalg.norm(rest))
        largest = max(largest, beta)
        if len(right) >= wanted:
            u, s, _ = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1))
            if (beta * np.abs(u[-1, :wanted]) <= TOLERANCE * s[0]).all() and beta > RANK * largest:
                break
        if beta <= RANK * largest:
            beta, rest = 0.0, fresh(right)
            right.append(rest)
        else:
            right.append(rest / beta)
        above.append(beta)
    return np.array(right), np.diag(diagonal) + np.diag(above, 1)


def fit(rows: DataFrame, width: int, wanted: int = 32) -> Fit | None:
    """Components and eigenvalues of the covariance of the rows' vectors, all of ``width`` entries."""
    n = rows.count()
    if not n or not width:
        return None
    whole = Fit(n, exact_sums(rows, width), np.zeros((0, width)), np.zeros(0), 0.0)

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        def both(x: np.ndarray) -> np.ndarray:
            centred = whole.centred(x)
            along = centred @ q
            return np.append(along @ centred, along @ along)

        sums = column_sums(rows, width, both, width + 1)
        return sums[:-1], float(sums[-1])

    trace = column_sums(rows, width, lambda x: (whole.centred(x) ** 2).sum(axis=0), width).sum() / n
    if trace == 0:
        return None
    right, small = bidiagonalise(product, width, min(wanted, width))
    _, singular, turn = np.linalg.svd(small)
    eigenvalues = singular**2 / n
    kept = np.flatnonzero(eigenvalues > RANK * eigenvalues[0])[:wanted]
    components = (turn @ right)[kept]
    components /= np.linalg.norm(components, axis=1)[:, None]
    return Fit(n, whole.sums, components, eigenvalues[kept], float(trace))


def identity_error(rows: DataFrame, width: int, model: Fit) -> float:
    """Largest entry by which the covariance of the whitened rows differs from the identity."""
    k = len(model.eigenvalues)
    mean = column_sums(rows, width, lambda x: model.whitened(x).sum(axis=0), k) / model.n

    def outer(x: np.ndarray) -> np.ndarray:
        white = model.whitened(x) - mean
        return (white.T @ white).ravel()

    covariance = column_sums(rows, width, outer, k * k).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def exact_deviation(n: int, sums: np.ndarray, x: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; null beyond a long."""
    apart = n * x - sums
    rough = (apart.astype(np.float64) ** 2).sum(axis=1)
    if (rough < 2.0**62).all() and n * float(np.abs(x).max(initial=0)) < 2.0**62:
        return (apart * apart).sum(axis=1).tolist()
    whole = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return [d if d < 1 << 63 else None for d in whole]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, wanted: int = 32, name: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component; see ``SCHEMA``."""
    spark = embeddings.sparkSession
    # Every step of the fit reads these rows again, so they are stored, as short whole numbers.
    stored = cut_lineage(whole_vectors(embeddings, name))
    lengths = [r[0] for r in stored.select("length").distinct().orderBy("length").collect()]
    out = spark.createDataFrame([], SCHEMA)
    for width in lengths:
        rows = stored.filter(F.col("length") == width)
        model = fit(rows, width, wanted)
        if model is not None:
            out = out.unionByName(projected(rows, width, model, identity_error(rows, width, model)))
    return out


def projected(rows: DataFrame, width: int, model: Fit, error: float) -> DataFrame:
    k = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, 1, width):
            m = part.num_rows
            deviations = pa.array(exact_deviation(model.n, model.sums, x), pa.int64())
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()),
                    deviations.take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, SCHEMA)
