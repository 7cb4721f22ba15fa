"""Removal of repeated byte strings by a sparse suffix sort.

Every byte that a 100-byte string covers which also starts earlier in the corpus is
found, without sorting every suffix. Each 100-byte window names the least hashed 24-byte
gram inside it; equal windows name the same one, at the same place. Neighbouring windows
with the same anchor form one record: the leading bytes of the suffix at the anchor,
the hash of its gram, and a digest of all bytes of those windows. Sampled splitters
range-partition the records by leading bytes (then by the other fields, so a hot
suffix is spread over buckets), each bucket is sorted by a multikey quicksort, and
neighbours are compared:

* a record that equals its neighbour repeats it entirely;
* records with equal grams and different digests may share some windows, and so may
  those at the two ends of a bucket. These are cut into cells of eight windows, at fixed
  places from the anchor. All windows of a cell share its core; a second sort, by
  the cores, brings together those that may be equal, and the seven bytes on either side
  of the core tell which windows are;
* cells whose core stands at an end of a bucket go on as single windows to a third sort,
  where buckets are compared across their boundaries by first and last key, one row of
  each bucket.

Records tell rows apart by ``doc_id`` and a 64-bit hash of the text, which also orders the texts of one id. Equal rows count
as one document and get the same result; a null ``doc_id`` comes before all others; null
and empty texts have no bytes, texts under 100 bytes nothing to remove. An empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import utf8
from shelfcast.session import cut_lineage

GRAM = 24
BLOCK = 1 << 18
BUCKET_BYTES = 32 << 20
NO_ID = -(1 << 63)
BASE = 0x9E3779B97F4A7C15
LOW = np.uint64(0xFFFFF)

CELL = 8

REPEATED, OPEN, FIRST, LAST = 1, 0, 2, 3
RECORD = ["lead", "gram", "digest", "doc", "tie", "place"]
CELLS = ["lead", "core", "left", "right", "doc", "tie", "place"]


def longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def pack(start: np.ndarray, count: np.ndarray, anchor: np.ndarray | int = 0) -> np.ndarray:
    """First window, way to the anchor and number of windows in one ascending long."""
    return (start.astype(np.int64) << 14) | (np.int64(anchor) << 7 if np.isscalar(anchor) else anchor.astype(np.int64) << 7) | count.astype(np.int64)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, way to the anchor, number of windows."""
    return place >> 14, (place >> 7) & 127, place & 127


def tie_of(text: Column) -> Column:
    """Tells apart the texts of one ``doc_id``: a hash of 64 bits."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        tie_of(F.col("text")).alias("tie"),
        F.coalesce("text", F.lit("")).cast("binary").alias("bytes"),
    )


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hashes of all 24-byte grams; each doubling joins two neighbours."""
    h = data.astype(np.uint64) + np.uint64(1)
    by_size = {}
    for size in (1, 2, 4, 8):
        h = h[:-size] * power(size) + h[size:]
        by_size[2 * size] = h
    eight, sixteen = by_size[8], by_size[16]
    h = sixteen[: eight.size - 16] * power(8) + eight[16:]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size, least = 1, values
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: values.size - width + 1], least[width - size :][: values.size - width + 1])


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a long."""
    lead = np.zeros(at.size, dtype=np.uint64)
    for i in range(8):
        lead = (lead << np.uint64(8)) | data[at + i].astype(np.uint64)
    return lead.view(np.int64)


def records_of(buffer: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in a buffer of texts: text, start, count, anchor, lead, gram, digest."""
    data = np.frombuffer(buffer, dtype=np.uint8)
    if data.size < length:
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    hashes = gram_hashes(data)
    least = window_least((hashes & ~LOW) | np.arange(hashes.size, dtype=np.uint64), length - GRAM + 1)
    anchor = (least & LOW).astype(np.int64)
    at = np.arange(anchor.size)
    text = np.searchsorted(ends, at, "right")
    at = at[at + length <= ends[text]]
    if not at.size:
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    new = np.concatenate(([True], (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    start, count = at[first], np.diff(np.append(first, at.size))
    view, digest = memoryview(buffer), xxhash.xxh3_64_intdigest
    stops = start + count + (length - 1)
    digests = np.fromiter((digest(view[a:b]) for a, b in zip(start.tolist(), stops.tolist())), np.uint64, start.size)
    on = anchor[start]
    return text[start], start, count, on - start, leading(data, on), hashes[on].view(np.int64), digests.view(np.int64)


def blocks(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to buffers of bounded size: buffer, ends, row and offset of each part.

    Long texts are cut into parts that overlap by a window less one byte.
    """
    parts, rows, offsets, held = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[at : at + BLOCK + length - 1]
            if len(part) < length:
                continue
            parts.append(part)
            rows.append(row)
            offsets.append(at)
            held += len(part)
            if held >= BLOCK:
                yield b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(offsets)
                parts, rows, offsets, held = [], [], [], 0
    if parts:
        yield b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(offsets)


def batch_of(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def suffix_records(length: int):
    """Records of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for buffer, ends, rows, offsets in blocks(utf8(batch.column(2)), length):
                text, start, count, anchor, lead, gram, digest = records_of(buffer, ends, length)
                begins = np.concatenate(([0], ends[:-1]))
                place = pack(start - begins[text] + offsets[text], count, anchor)
                yield batch_of(RECORD, [lead, gram, digest, doc[rows[text]], tie[rows[text]], place])

    return run


def beside(data: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """Seven bytes from ``at`` on in one direction, the nearest lowest; their number on top."""
    out = np.zeros(at.size, dtype=np.uint64)
    there = np.zeros(at.size, dtype=np.uint64)
    for i in range(CELL - 1):
        place = at + i * step
        inside = (place >= 0) & (place < data.size)
        value = data[np.clip(place, 0, data.size - 1)].astype(np.uint64)
        out |= np.where(inside, value << np.uint64(8 * i), np.uint64(0))
        there += inside
    return (out | (there << np.uint64(56))).view(np.int64)


def cell_records(length: int, rows: int = 1 << 16):
    """The cells of the listed runs of windows of a row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, core = xxhash.xxh3_64_intdigest, length - CELL + 1
        for batch in batches:
            held, n = [], 0
            for doc, tie, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, view = np.frombuffer(text, dtype=np.uint8), memoryview(text)
                start, anchor, count = unpack(np.unique(np.array(places, dtype=np.int64)))
                low, high = (anchor - count + 1) // CELL, anchor // CELL
                many = high - low + 1
                cell = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = np.unique(np.repeat(start + anchor, many) - CELL * cell)
                for first in range(0, at.size, rows):
                    own = at[first : first + rows]
                    found = np.fromiter((digest(view[a : a + core]) for a in own.tolist()), np.uint64, own.size).view(np.int64)
                    place, row = pack(own, np.zeros(own.size)), [np.full(own.size, doc), np.full(own.size, tie)]
                    held.append([leading(data, own), found, beside(data, own - 1, -1), beside(data, own + core, 1), *row, place])
                    n += own.size
                    if n >= rows:
                        yield batch_of(CELLS, [np.concatenate(c) for c in zip(*held, strict=True)])
                        held, n = [], 0
            if held:
                yield batch_of(CELLS, [np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def cell_windows(left: np.ndarray, right: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The window that reaches ``j`` bytes over a core's left side: its bytes beside the core, and whether it exists."""
    low = lambda side, n: side & np.int64((1 << (8 * n)) - 1)
    fits = ((left >> 56) >= j) & ((right >> 56) >= CELL - 1 - j)
    return low(left, j), low(right, CELL - 1 - j), fits


def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record for each window of a cell; no text is needed, the digest is made of core and sides."""
    for batch in batches:
        lead, core, left, right, doc, tie, place = (c.to_numpy() for c in batch.columns)
        start, _, _ = unpack(place)
        for j in range(CELL):
            a, b, fits = cell_windows(left, right, j)
            key = np.stack([core, a, b, np.full(core.size, j)], axis=1)[fits]
            found = np.fromiter((xxhash.xxh3_64_intdigest(k.tobytes()) for k in key), np.uint64, len(key)).view(np.int64)
            own = pack(start[fits] - j, np.ones(len(key)))
            yield batch_of(RECORD, [lead[fits], core[fits], found, doc[fits], tie[fits], own])


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the columns: a quicksort by the first, then by the next inside equal runs only."""
    order = np.argsort(columns[0], kind="quicksort")
    run = np.zeros(order.size, dtype=np.int64)
    for this, following in zip(columns, columns[1:]):
        value = this[order]
        run = np.cumsum(np.concatenate(([0], (run[1:] != run[:-1]) | (value[1:] != value[:-1]))))
        tied = np.flatnonzero((np.bincount(run) > 1)[run])
        if not tied.size:
            break
        inside = np.lexsort((following[order[tied]], run[tied]))
        order[tied] = order[tied[inside]]
    return order


def whole_bucket(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The sorted columns of a bucket, whose size the number of buckets bounds."""
    held = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    if not held:
        return []
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    del held
    order = multikey_order(columns)
    return [c[order] for c in columns]


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(columns[0].size, dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def repeats_of_first(new: np.ndarray, doc: np.ndarray, tie: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows behind the first of their group; the same place of the same row (from an equal row) is no repeat."""
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return ~new & ((doc != doc[first]) | (tie != tie[first]) | (place != place[first]))


def open_groups(group_new: np.ndarray, new: np.ndarray) -> np.ndarray:
    """First rows of their value whose group has several values or stands at an end of the bucket."""
    group = np.cumsum(group_new) - 1
    several = np.bincount(group[new]) > 1
    several[[0, -1]] = True
    return new & several[group]


def reported(names: list[str], kind: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    bucket = TaskContext.get().partitionId()
    for low in range(0, kind.size, 1 << 16):
        own = kind[low : low + (1 << 16)]
        arrays = [pa.array(own, pa.int32()), pa.array(np.full(own.size, bucket, np.int32))]
        arrays += [pa.array(c[low : low + (1 << 16)], pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "bucket", *names])


def sort_bucket(single: bool):
    """Sort a bucket of records and compare neighbours.

    Repeats are reported; with ``single`` also the first and last key, else every first
    record whose gram has several digests or stands at an end of the bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = whole_bucket(batches)
        if not columns:
            return
        lead, gram, digest, doc, tie, place = columns
        new = changes([lead, gram, digest])
        kind = np.full(new.size, -1, dtype=np.int32)
        kind[repeats_of_first(new, doc, tie, place)] = REPEATED
        if single:
            kind[0] = FIRST
        else:
            kind[open_groups(changes([lead, gram]), new)] = OPEN
        out = np.flatnonzero(kind >= 0)
        yield from reported(RECORD, kind[out], [c[out] for c in columns])
        if single:
            yield from reported(RECORD, np.array([LAST], np.int32), [c[-1:] for c in columns])

    return run


def sort_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket of cells and report the windows that repeat an earlier one, as runs.

    Cells with equal cores and sides are settled by their first; the firsts of one core are
    compared window by window. Firsts whose core stands at an end of the bucket are left open.
    """
    columns = whole_bucket(batches)
    if not columns:
        return
    lead, core, left, right, doc, tie, place = columns
    core_new, new = changes([lead, core]), changes([lead, core, left, right])
    settled = repeats_of_first(new, doc, tie, place)
    group = np.cumsum(core_new) - 1
    firsts = np.flatnonzero(new & (np.bincount(group[new]) > 1)[group])
    again = np.zeros((new.size, CELL), dtype=bool)
    for j in range(CELL):
        a, b, fits = cell_windows(left, right, j)
        again[settled, j] = fits[settled]
        own = firsts[fits[firsts]]
        if own.size:
            order = own[np.lexsort((place[own], tie[own], doc[own], b[own], a[own], group[own]))]
            again[order[repeats_of_first(changes([group[order], a[order], b[order]]), doc[order], tie[order], place[order])], j] = True
    # Neighbouring windows of a cell become one run: column j starts j bytes before the core.
    edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    start, _, _ = unpack(place[row])
    runs = pack(start - (high - 1), high - low)
    zero = np.zeros(row.size, np.int64)
    yield from reported(CELLS, np.full(row.size, REPEATED, np.int32), [zero, zero, zero, zero, doc[row], tie[row], runs])
    at_end = np.flatnonzero(new & ((group == 0) | (group == group[-1])))
    yield from reported(CELLS, np.full(at_end.size, OPEN, np.int32), [c[at_end] for c in columns])


def in_buckets(records: DataFrame, buckets: int, names: list[str], fn) -> DataFrame:
    """Range-partition by sampled splitters, sort the buckets, store what they report."""
    spread = records.repartitionByRange(buckets, *names)
    return cut_lineage(spread.mapInArrow(fn, f"kind int, bucket int, {longs(names)}"))


def across_boundaries(found: DataFrame) -> list[tuple[int, int, int]]:
    """(doc, tie, place) of each bucket's first window that repeats the last key of a bucket before it."""
    ends = found.filter(F.col("kind").isin(FIRST, LAST)).collect()  # two rows of each bucket
    firsts = {r["bucket"]: r for r in ends if r["kind"] == FIRST}
    lasts = {r["bucket"]: r for r in ends if r["kind"] == LAST}
    key = lambda r: (r["lead"], r["gram"], r["digest"])
    own = lambda r: (r["doc"], r["tie"], r["place"])
    out, before = [], None
    for bucket in sorted(firsts):
        first, last = firsts[bucket], lasts[bucket]
        if before is not None and key(first) == key(before) and own(first) != own(before):
            out.append(own(first))
        before = last
    return out


def repeated_windows(docs: DataFrame, length: int = 100, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc``, ``tie`` and ``places``: the runs of windows of a row that start earlier elsewhere."""
    if not GRAM + CELL <= length <= GRAM + 127:
        raise ValueError(f"the length has to be from {GRAM + CELL} to {GRAM + 127}")
    spark, rows = docs.sparkSession, keyed(docs)
    several = lambda n: max(1, -(-n // bucket_bytes))
    size = rows.agg(F.sum(F.length("bytes"))).first()[0] or 0
    found = in_buckets(rows.mapInArrow(suffix_records(length), longs(RECORD)), several(size), RECORD, sort_bucket(False))
    owner = ("doc", "tie", "place")
    left_open = found.filter(F.col("kind") == OPEN)
    n_cells = (left_open.count() * 7) * 50  # about 50 bytes for each of some seven cells
    undecided = left_open.select(*owner).groupBy("doc", "tie").agg(F.collect_list("place").alias("places"))
    cells = rows.join(undecided, ["doc", "tie"]).select("doc", "tie", "bytes", "places").mapInArrow(cell_records(length), longs(CELLS))
    cells = in_buckets(cells, several(n_cells), CELLS, sort_cells)
    at_ends = cells.filter(F.col("kind") == OPEN).select(*CELLS)
    single = at_ends.mapInArrow(single_windows, longs(RECORD))
    single = in_buckets(single, several(at_ends.count() * CELL * 50), RECORD, sort_bucket(True))
    late = spark.createDataFrame(across_boundaries(single), "doc long, tie long, place long")
    for table in (found, cells, single):
        late = late.union(table.filter(F.col("kind") == REPEATED).select(*owner))
    return late.groupBy("doc", "tie").agg(F.collect_list("place").alias("places"))


def removed_runs(places: list[int] | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the windows cover."""
    start, _, count = unpack(np.sort(np.array(places or [], dtype=np.int64)))
    end = start + count - 1 + length
    if not start.size:
        return start, end
    end = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, start.size - 1)]


def remove_repeats(docs: DataFrame, length: int = 100, bucket_bytes: int = BUCKET_BYTES, kept: bool = True) -> DataFrame:
    """``doc_id``, byte counts, removed spans and the kept bytes (or only their digest) of each row."""
    spans = repeated_windows(docs, length, bucket_bytes)
    rows = keyed(docs).join(spans, ["doc", "tie"], "left").select("doc", "bytes", "places")
    kind = "kept binary" if kept else "kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start, end = removed_runs(places, length)
                edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((None if doc == NO_ID else doc, len(text), int((end - start).sum()), start.size, rest if kept else hashlib.sha256(rest).hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.binary() if kept else pa.string()]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", kind.split()[0]])

    return rows.mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {kind}")
