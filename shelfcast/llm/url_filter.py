"""URL filter by a Bloom filter cascade, in DataFrame functions only.

Every listed key and every key of the corpus is known when the filter is built.
Level 1 holds the listed keys; the corpus keys it wrongly accepts make level 2, the
listed keys that level 2 wrongly accepts make level 3, and so on until no key is
wrong. A look-up is then exact for every key of the corpus and needs no join: the
levels travel as literals of a few bits for each listed key.

Null, empty and malformed urls have an empty host and path and fit no rule; equal
rows get equal answers; an empty table gives an empty one; other columns of the
input are not touched, and columns of it named like a result column are replaced.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

# A level may hold at most so many bits (8 MB); longer lists have to be split by the caller.
MAX_BITS = 1 << 26


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        """Labels of the host and length of the path."""
        return self.host.count(".") + 1, len(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty where it has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def shaped_key(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The key a rule of this shape would need to fit; null where the url is shorter."""
    labels, length = shape
    long_enough = (F.size(F.split(host, "\\.")) >= labels) & (F.length(path) >= length)
    return F.when(long_enough, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)))


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    bits: int
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        return bit_positions(key, self.bits, self.hashes, self.seed)

    def accepts(self, key: Column) -> Column:
        # A constant that Spark folds once into an array literal.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for at in self.positions(key):
            word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
            found = found & (F.getbit(word, at.bitwiseAND(63).cast("int")) == 1)
        return found


def bit_positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(bits).cast("long")) for i in range(hashes)]


def build_level(keys: DataFrame, count: int, miss: float, seed: int, min_bits: int) -> Level:
    """A Bloom filter over column ``key``; only its words reach the driver."""
    hashes = max(1, round(-math.log2(miss)))
    bits = max(min_bits, math.ceil(-1.45 * count * math.log2(miss)))
    if bits > MAX_BITS:
        raise ValueError(f"{count} listed keys need {bits} bits, over {MAX_BITS}: split the list")
    at = keys.select(F.explode(F.array(*bit_positions(F.col("key"), bits, hashes, seed))).alias("at"))
    word = F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))")
    rows = at.groupBy(F.shiftright("at", 6).alias("place")).agg(word.alias("word")).collect()
    words = [0] * (bits // 64 + 1)
    for r in rows:
        words[r["place"]] = r["word"]
    return Level(tuple(words), bits, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether a key of the corpus is listed. Passing the last level settles it."""
        if not self.levels:
            return F.lit(False)
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].accepts(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, first_seed: int = 0, min_bits: int = 64) -> Cascade:
    """``listed`` and ``universe`` have a column ``key``; ``universe`` holds each key once."""
    inside = listed.select("key").filter("key IS NOT NULL").distinct()
    outside = universe.select("key").join(inside, "key", "left_anti")
    n_in, n_out = inside.count(), outside.count()
    miss = min(0.5, math.sqrt(0.5) * n_in / max(1, n_out))
    levels: list[Level] = []
    while n_in:
        levels.append(build_level(inside, n_in, miss, first_seed + len(levels), min_bits))
        wrong = cut_lineage(outside.filter(levels[-1].accepts(F.col("key"))))
        n_in, n_out, miss = wrong.count(), n_in, 0.5
        inside, outside = wrong, inside
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url", min_bits: int = 64) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``; the longest fitting rule wins."""
    spark: SparkSession = pages.sparkSession
    host, path = host_and_path(F.col(url))
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    verdicts = sorted({r.verdict for r in rules})
    cascades = {}
    shapes = sorted({r.shape for r in rules})
    keys = [shaped_key(F.col("host"), F.col("path"), s) for s in shapes]
    if rules:
        found = pages.select("host", "path").select(F.explode(F.array(*keys)).alias("key"))
        universe = cut_lineage(found.filter("key IS NOT NULL").distinct())
    for i, verdict in enumerate(verdicts):
        listed = spark.createDataFrame([(r.key,) for r in rules if r.verdict == verdict], "key string")
        cascades[verdict] = build_cascade(listed, universe, 100 * i, min_bits)
    fits = [
        F.when(key.isNotNull() & cascades[v].contains(key), F.struct(F.length(key).alias("n"), key.alias("rule"), F.lit(v).alias("verdict")))
        for v in verdicts
        for key, shape in zip(keys, shapes, strict=True)
        if any(r.verdict == v and r.shape == shape for r in rules)
    ]
    if not fits:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    best = F.array_max(F.array(*fits))
    judged = pages.withColumn("_best", best)
    return judged.withColumns(
        {"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}
    ).drop("_best")
