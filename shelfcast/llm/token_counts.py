"""Token counts by rank-synchronous merging of ragged arrays.

Texts become pre-tokens: runs of spaces with the visible characters behind them, which no
piece of the vocabulary reaches across. The distinct pre-tokens of a batch lie one behind
the other in one array of symbols. In a round every sequence looks up the rank of each pair of
neighbours, and those of its lowest rank merge at once; sequences without a known pair leave,
and the symbols that they still hold are their tokens.

One merge after the other, from the left, is what the vocabulary means. It makes a difference
only where a new symbol forms a pair of the same or a lower rank with a neighbour, which
then comes before the next merge of the rank. So a sequence takes its merges of a round up to the first one
of that kind; merges further from each other than twice the longest piece do not meet and
go on apart. Pre-tokens of more than ``LONG`` symbols may take as many rounds as they have
symbols (a long run of blanks does); they merge by a heap, one pair at a time, with equal results.

A null text is an empty one and has no tokens. Repeated rows get equal counts, an empty table
gives an empty one, columns other than ``doc_id`` and ``text`` are not read. Texts are read whole.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcast.llm.common import slices

ROWS = 128
LONG = 4096
MEMO = 1 << 17
SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.iinfo(np.int64).max
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where the value changes; the first place always counts."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.zeros(0, np.int64)


@dataclass
class Vocabulary:
    """Pieces of a sentence-piece BPE model with byte fallback, as arrays."""

    path: str
    memo: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(self.path, "rb") as f:
            spec.ParseFromString(f.read())
        kind = spec.SentencePiece
        if (
            spec.trainer_spec.model_type != spec.trainer_spec.BPE
            or not spec.trainer_spec.byte_fallback
            or spec.trainer_spec.treat_whitespace_as_suffix
            or spec.normalizer_spec.precompiled_charsmap
            or spec.normalizer_spec.remove_extra_whitespaces
            or not spec.normalizer_spec.escape_whitespaces
            or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in spec.pieces)
        ):
            raise ValueError("not a plain BPE model with byte fallback")
        self.prefix = SPACE if spec.normalizer_spec.add_dummy_prefix else ""
        pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces reach across blanks")
        # Equal scores have equal ranks: the further left then comes first.
        scores = {spec.pieces[i].score for i in pieces.values()}
        rank_of = {score: rank for rank, score in enumerate(sorted(scores, reverse=True))}
        pairs = [
            (pieces[p[:k]], pieces[p[k:]], rank_of[spec.pieces[i].score], i)
            for p, i in pieces.items()
            for k in range(1, len(p))
            if p[:k] in pieces and p[k:] in pieces
        ]
        self.width = len(spec.pieces)
        self.longest = max(map(len, pieces))
        self.ranks = np.array([r for _, _, r, _ in pairs] + [NONE], np.int64)
        self.made = np.array([i for _, _, _, i in pairs] + [0], np.int64)
        self.place(np.array([a * self.width + b for a, b, _, _ in pairs], np.int64))
        self.symbols = np.full(0x110000, -1, np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        self.pairs = {(a, b): (r, i) for a, b, r, i in pairs}

    def place(self, keys: np.ndarray) -> None:
        """A hash table of the pairs; ``probes`` is how far the furthest pair lies from its own slot."""
        self.bits = max(keys.size * 8, 2).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.entry = np.full(1 << self.bits, keys.size, np.int32)
        self.probes, waiting = 0, np.arange(keys.size)
        while waiting.size:
            slot = (self.home(keys[waiting]) + self.probes) & ((1 << self.bits) - 1)
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.slots[slot[put]], self.entry[slot[put]] = keys[waiting[put]], waiting[put]
            waiting = np.delete(waiting, put)
            self.probes += 1

    def home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * GOLDEN >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of each pair; ``NONE`` where the pair is no piece."""
        # A character without a piece is -1 and makes a pair that no slot holds.
        key = np.where((left >= 0) & (right >= 0), left * self.width + right, -2)
        slot = self.home(key)
        found = np.full(key.size, self.ranks.size - 1)
        open_ = np.arange(key.size)
        for _ in range(self.probes):
            held = self.slots[slot[open_]]
            hit = held == key[open_]
            found[open_[hit]] = self.entry[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
            if not open_.size:
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return self.ranks[found], self.made[found]

    def merged_sizes(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Symbols left of each of ``n`` sequences; ``owner`` names each symbol's sequence, rising."""
        left = np.bincount(owner, minlength=n)
        while symbols.size > 1:
            inside = owner[1:] == owner[:-1]
            rank, made = self.look_up(symbols[:-1], symbols[1:])
            rank = np.append(np.where(inside, rank, NONE), NONE)
            starts = run_starts(owner)
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, owner.size)))
            busy = lowest < NONE
            at = np.flatnonzero((rank == lowest) & busy)
            if not at.size:
                break
            chosen = self.first_merges(at, symbols, owner, made, rank)
            symbols[chosen] = made[chosen]
            keep = busy
            keep[chosen + 1] = False
            left -= np.bincount(owner[chosen], minlength=n)
            symbols, owner = symbols[keep], owner[keep]
        return left

    def first_merges(self, at: np.ndarray, symbols: np.ndarray, owner: np.ndarray, made: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Those of the lowest-ranked pairs ``at`` that merging from the left takes before any pair that they create."""
        near = np.append(False, np.diff(at) == 1)
        start = np.maximum.accumulate(np.where(near, 0, np.arange(at.size)))
        at = at[(np.arange(at.size) - start) % 2 == 0]
        # The left neighbour has merged already if the merge before this one is next to it.
        new, after = made[at], np.minimum(at + 2, symbols.size - 1)
        before = np.maximum(at - 1, 0)
        left = symbols[before]
        touching = np.append(False, np.diff(at) == 2)
        left = np.where(touching, np.append(0, new[:-1]), left)
        rank_left, _ = self.look_up(left, new)
        rank_right, _ = self.look_up(new, symbols[after])
        rank_left[(at == 0) | (owner[before] != owner[at])] = NONE
        rank_right[(at + 2 >= symbols.size) | (owner[after] != owner[at])] = NONE
        stops = np.minimum(rank_left, rank_right) <= rank[at]
        apart = np.append(True, (np.diff(at) > 2 * self.longest) | (owner[at[1:]] != owner[at[:-1]]))
        stopped = np.cumsum(stops) - stops
        return at[stopped == np.maximum.accumulate(np.where(apart, stopped, 0))]

    def merged_size(self, symbols: list[int]) -> int:
        """Symbols left of one sequence, merged by a heap of (rank, place)."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(symbols)
            found = self.pairs.get((symbols[i], symbols[j])) if j < len(symbols) else None
            if found:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(len(symbols) - 1):
            offer(i)
        left = len(symbols)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= len(symbols) or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = new, -2, after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            left -= 1
            offer(before[i])
            offer(i)
        return left

    def sizes(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        chars = code_points("".join(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        symbols = self.symbols[chars].astype(np.int64)
        # A character without a piece becomes its bytes.
        bytes_of = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        extra = np.bincount(owner, np.where(symbols < 0, bytes_of - 1, 0), len(words)).astype(np.int64)
        short = (lengths <= LONG)[owner]
        out = self.merged_sizes(symbols[short], owner[short], len(words))
        ends = np.cumsum(lengths)
        for i in np.flatnonzero(lengths > LONG):
            out[i] = self.merged_size(symbols[ends[i] - lengths[i] : ends[i]].tolist())
        return out + extra

    def count_batch(self, texts: list[str]) -> list[int]:
        split = [PRE_TOKEN.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        words = set().union(*split)
        known = {w: self.memo[w] for w in words if w in self.memo}
        new = [w for w in words if w not in known]
        if new:
            sizes = self.sizes(new).tolist()
            known.update(zip(new, sizes, strict=True))
            # Long pre-tokens rarely come again; the memo holds short ones and so stays small.
            self.memo.update((w, n) for w, n in zip(new, sizes, strict=True) if len(w) <= 32)
        return [sum(map(known.__getitem__, own)) for own in split]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each Python worker, kept between its tasks."""
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id``, UTF-8 bytes, tokens of the whole text, and whether they exceed ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for rows in slices(batches, ROWS):
            texts = [t or "" for t in rows.column(1).to_pylist()]
            counts = np.array(own.count_batch(texts), np.int64)
            n_bytes = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n_bytes), pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
