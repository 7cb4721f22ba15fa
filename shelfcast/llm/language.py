"""Language identification with error-correcting output codes.

Every learned language has a binary codeword. For each bit of the code, a binary n-gram
classifier says on which side a text lies: its weights are the log odds of hashed 1-,
2- and 3-grams of letters between the languages whose bit is 1 and those whose bit is 0.
Decoding adds up, over the bits, each bit's weight times the logistic loss of the
margin against the codeword, and takes the nearest codeword. A text whose two nearest
codewords are about equally far is flagged as ambiguous.

The classifiers are fitted on at most ``per_language`` documents of each language (a
pseudo-random choice by ``doc_id``), so what reaches the driver is one table of n-gram
counts. Prediction reads whole texts, in pieces.

A null text, or one without letters, is ``und`` with score 0, and so is every text if
nothing was learned. Rows with a null ``doc_id`` or ``lang`` are predicted but not learned
from. Ties go to the language that comes first in code point order. Repeated rows get
equal answers. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import slices

GRAMS = 1 << 14
PER_LANGUAGE = 4000
PIECE = 1 << 16
UNKNOWN = "und"
FOLDS = 3


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """One row of -1 and 1 for each of ``n`` languages.

    Up to seven languages get every split once (the exhaustive code); more get the
    best of some seeded random codes, about 15 bits for each doubling.
    """
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 7:
        bits = [(1, *rest) for rest in itertools.product((1, 0), repeat=n - 1)][1:]
        return np.array(bits, dtype=np.int8).T * 2 - 1
    rng, best, apart = random.Random(seed), None, -1
    width = math.ceil(15 * math.log2(n))
    for _ in range(50):
        columns = set()
        while len(columns) < width:
            c = tuple(rng.choice((-1, 1)) for _ in range(n))
            if len(set(c)) == 2 and tuple(-x for x in c) not in columns:
                columns.add(c)
        code = np.array(sorted(columns), dtype=np.int8).T
        distance = min(int((code[i] != code[j]).sum()) for i in range(min(n, 200)) for j in range(i))
        if distance > apart:
            best, apart = code, distance
    return best


def grams(text: str, n_grams: int = GRAMS) -> np.ndarray:
    """Buckets of the 1-, 2- and 3-grams of a text; every run of non-letters counts as one blank."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    keep = LETTERS[np.minimum(chars, LETTERS.size - 1)]
    chars = np.where(keep, chars, 32).astype(np.uint64)
    chars = chars[np.concatenate(([True], keep[1:] | keep[:-1]))] if chars.size else chars
    one = chars * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (chars[1:] + np.uint64(0x1F123BB5))) * np.uint64(0xC2B2AE3D27D4EB4F)
    three = (two[:-1] ^ (chars[2:] + np.uint64(0x5851F42D))) * np.uint64(0x165667B19E3779F9)
    return (np.concatenate((one, two, three)) >> np.uint64(40)).astype(np.int64) & (n_grams - 1)


# Whether a code point is a letter; what lies beyond the table is looked up in its last entry.
LETTERS = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x32400)] + [False])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def text_pieces(text: str) -> Iterator[str]:
    """Pieces of a long text that overlap by two characters, so no n-gram is lost."""
    for start in range(0, max(1, len(text)), PIECE):
        yield text[max(0, start - 2) : start + PIECE]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-grams x bits
    bias: np.ndarray  # bits
    trust: np.ndarray  # bits
    ambiguous: float

    def margins(self, text: str) -> np.ndarray:
        total, n = np.zeros(self.code.shape[1]), 0
        for piece in text_pieces(text):
            at = grams(piece, self.weights.shape[0])
            total += np.bincount(at, minlength=self.weights.shape[0]) @ self.weights if at.size > 4096 else self.weights[at].sum(axis=0)
            n += at.size
        return total / math.sqrt(max(1, n)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the two nearest codewords are about equally near."""
        if not self.languages or text is None or not has_letter(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = np.logaddexp(0, -self.code * self.margins(text)) @ self.trust
        best = int(np.argmin(loss))
        near = np.exp(-(loss - loss[best]) / self.trust.sum() * 2)
        score = float(1 / near.sum())
        second = np.partition(loss, 1)[1]
        return self.languages[best], score, bool(second - loss[best] < self.ambiguous * max(second, 1e-12))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, n_grams: int = GRAMS, ambiguous: float = 0.02) -> Model:
    """Fit on at most about ``per_language`` rows of each non-null ``lang``."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("lang", "text", "doc_id")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), codewords(0), np.zeros((n_grams, 1)), np.zeros(1), np.ones(1), ambiguous)
    # A row is chosen if its hash is in the lowest part that its language needs.
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, per_language / sizes[lang])).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(n_grams, dtype=np.int64))
                for piece in text_pieces(text):
                    own += np.bincount(grams(piece, n_grams), minlength=n_grams)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size), pa.array(at), pa.array(own[at])], ["lang", "gram", "n"])

    rows = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    found = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), n_grams))
    counts[found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int), found["gram"].to_numpy(dtype=int)] = found["n"]
    return fit(languages, counts, ambiguous)


def fit(languages: tuple[str, ...], counts: np.ndarray, ambiguous: float) -> Model:
    """Weights of each bit from n-gram counts by language; each language weighs the same."""
    code = codewords(len(languages))
    shares = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    logs = [np.log(shares[code[:, b] > 0].mean(axis=0)) - np.log(shares[code[:, b] <= 0].mean(axis=0)) if (code[:, b] <= 0).any() else np.zeros(counts.shape[1]) for b in range(code.shape[1])]
    weights = np.stack(logs, axis=1).astype(np.float64)
    # The middle between the nearest languages of both sides is the bit's zero; the gap is its trust.
    means = shares @ weights
    bias, trust = np.zeros(code.shape[1]), np.ones(code.shape[1])
    for b in range(code.shape[1]):
        if (code[:, b] <= 0).any():
            low, high = means[code[:, b] <= 0, b].max(), means[code[:, b] > 0, b].min()
            weights[:, b] -= (low + high) / 2
            trust[b] = max(high - low, 1e-3)
    return Model(languages, code, weights, bias, trust / trust.sum(), ambiguous)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` of each row, with the columns ``keep``."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: n-grams x bits
    names = ["doc_id", *keep]
    source = docs.select(F.col("text").alias("_text"), *names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = broadcast.value
        for batch in slices(batches):
            lang, score, unsure = zip(*map(own.predict, batch.column(0).to_pylist()), strict=True)
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], [*names, "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")
