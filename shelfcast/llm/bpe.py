"""Byte-level BPE with content-defined chunk reuse.

A rolling hash over characters cuts texts into chunks, so documents that share a passage
share the chunks inside it. A chunk is encoded once in a task and reused from a bounded
store. Joins are kept apart: a part around each cut reaches from the last position before
the cut to the first one behind it at which the pre-tokenizer surely starts anew (a blank
or line feed behind a visible character: no pattern of the pre-tokenizer reaches across
it). Ids on both sides of such a position do not depend on what lies beyond it, so the
ids of chunks and joins add up exactly to those of the whole text.

A part that is new is put together from its words, the pieces between all its sure
positions, which have a bounded store of their own. The library encodes the words that no
store holds, many of them in one text.

Decoding joins the bytes of the tokens and reads them as UTF-8.

A null text is an empty one: no ids, an empty text. Texts without any sure position are
encoded whole. Repeated rows get equal answers; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfcast.llm.common import slices

ROLL = 8
ROWS = 128
STORE_BYTES = 24 << 20
WORD_BYTES = 64 << 20
# Longer words, such as unspaced texts, are not kept.
LONGEST_WORD = 256
# Characters of new parts that are split into words at once.
SPAN = 1 << 18
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in (1, 2, 4)]

# Characters that are, or were in some version of Unicode, white space or invisible; all others are visible.
UNSEEN = [
    (0, 0x20), (0x7F, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x206F),
    (0x3000, 0x3000), (0xFEFF, 0xFEFF),
]
VISIBLE = np.ones(0x110000, dtype=bool)
for a, b in UNSEEN:
    VISIBLE[a : b + 1] = False
NOT = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in UNSEEN)
# A word ends with a visible character before a blank or line feed, or with its part.
WORD = re.compile(rf"[{NOT}]*[^{NOT}]+(?:(?![ \n])[{NOT}]+[^{NOT}]*)*+|[{NOT}]+")


def characters_of_bytes() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Codec:
    """A tokenizer file with its chunk store; ``reuse`` is off where joins cannot be proved."""

    path: str
    chunk_bits: int = 7
    store: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    held: int = 0
    words: dict[str, bytes] = field(default_factory=dict)
    older_words: dict[str, bytes] = field(default_factory=dict)
    words_held: int = 0

    def __post_init__(self) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.reuse = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space", True)
            and pre.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c in " \n" for c in t["content"]) for t in added)
        )
        if not self.reuse:
            raise ValueError("the tokenizer is not a byte-level one whose joins can be repaired")
        back = characters_of_bytes()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.special = {t["id"] for t in added}
        self.bytes_of: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = token.encode() if i in self.special else bytes(back[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)

    def cuts(self, chars: np.ndarray) -> np.ndarray:
        """Content-defined cuts: where a hash of the last characters has its high bits 0."""
        if chars.size < 2 * ROLL:
            return np.zeros(0, dtype=np.int64)
        # The hash of 2, 4 and 8 characters, each from two of the one before.
        rolling = chars.astype(np.uint64)
        for half, factor in zip((1, 2, 4), FACTORS, strict=True):
            rolling = rolling[:-half] * factor + rolling[half:]
        rolling ^= rolling >> np.uint64(29)
        rolling *= np.uint64(0xBF58476D1CE4E5B9)
        return np.flatnonzero(rolling >> np.uint64(64 - self.chunk_bits) == 0) + ROLL

    def parts(self, text: str) -> list[str]:
        """The text as insides of chunks and repaired joins, in turn; they add up to the text."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        blank = np.flatnonzero((chars[1:] == 0x20) | (chars[1:] == 0x0A))
        sure = blank[VISIBLE[chars[blank]]] + 1
        cuts = self.cuts(chars)
        if not sure.size or not cuts.size:
            return [text]
        # The last sure position before a cut, its visible character in the left chunk, and the first one behind it.
        left = np.searchsorted(sure, cuts, "right") - 1
        right = np.searchsorted(sure, cuts + 1)
        starts = np.where(left >= 0, sure[np.maximum(left, 0)], 0)
        ends = np.where(right < sure.size, sure[np.minimum(right, sure.size - 1)], chars.size)
        edges = np.unique(np.concatenate(([0], starts, ends, [chars.size])))
        return [text[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.parts(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for own in parts for p in own if p not in self.store and p not in self.older))
        fresh = self.encode_parts(new)
        # Every part has a byte, and so an id.
        find = lambda p: fresh.get(p) or self.store.get(p) or self.older[p]
        out = [np.frombuffer(b"".join(map(find, own)), dtype="<u4") for own in parts]
        size = sum(2 * len(p) + len(v) + 200 for p, v in fresh.items())
        # A full store stays readable until the next one is full.
        if self.held + size > STORE_BYTES:
            self.older, self.store, self.held = self.store, {}, 0
        if size <= STORE_BYTES:
            self.store |= fresh
            self.held += size
        return out

    def encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part, from those of its words."""
        out: dict[str, bytes] = {}
        at = 0
        while at < len(parts):
            split, size = {}, 0
            while at < len(parts) and size < SPAN:
                split[parts[at]] = WORD.findall(parts[at])
                size += len(parts[at])
                at += 1
            used = set().union(*split.values())
            absent = used.difference(self.words)
            # Words in use move on to the newer store.
            found = {w: self.older_words[w] for w in absent if w in self.older_words}
            found |= self.encode_words(list(absent.difference(found)))
            ids_of = {w: self.words[w] for w in used.difference(absent)} | found
            out |= {p: b"".join(map(ids_of.__getitem__, own)) for p, own in split.items()}
            kept = {w: v for w, v in found.items() if len(w) <= LONGEST_WORD}
            self.words |= kept
            self.words_held += sum(2 * len(w) + len(v) + 200 for w, v in kept.items())
            if self.words_held > WORD_BYTES:
                self.older_words, self.words, self.words_held = self.words, {}, 0
        return out

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word; those between sure positions are encoded in one text, then told apart by their bytes."""
        inner = [w for w in words if w[0] in " \n" and VISIBLE[ord(w[-1])]]
        out: dict[str, bytes] = {}
        if inner:
            ids = self.encode_each(["".join(inner)])[0]
            ends = np.cumsum(self.lengths[ids])
            wanted = np.cumsum([len(w.encode()) for w in inner])
            # A vocabulary without some byte leaves it out; such words are encoded one by one.
            if ends.size and ends[-1] == wanted[-1]:
                data, edges = ids.tobytes(), (4 * np.searchsorted(ends, wanted) + 4).tolist()
                out = {w: data[a:b] for w, a, b in zip(inner, [0, *edges], edges, strict=False)}
        rest = [w for w in words if w not in out]
        return out | {w: x.tobytes() for w, x in zip(rest, self.encode_each(rest), strict=True)}

    def encode_each(self, texts: list[str]) -> list[np.ndarray]:
        # The fast call leaves out the offsets, which nothing here reads.
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        # The place of each byte of the text among the bytes of all tokens.
        places = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if ends.size else 0)
        return self.all_bytes[places].tobytes().decode("utf-8", "replace")


@functools.cache
def codec(path: str, chunk_bits: int = 7) -> Codec:
    """One codec for each Python worker, kept between its tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Codec(path, chunk_bits)


def encode(docs: DataFrame, path: str, chunk_bits: int = 7) -> DataFrame:
    """``doc_id``, the ids of the whole text and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, chunk_bits)
        for rows in slices(batches, ROWS):
            ids = own.encode_batch([t or "" for t in rows.column(1).to_pylist()])
            texts = [own.decode(x) for x in ids]
            flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([rows.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, chunk_bits: int = 7) -> DataFrame:
    """Number of tokens and SHA-256 of ids (little-endian, 32 bits) and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, chunk_bits)
        for rows in slices(batches, ROWS):
            ids = own.encode_batch([t or "" for t in rows.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([x.size for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
