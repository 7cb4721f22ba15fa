"""WARC archives: monolithic gzip files are normalised to one member for each record.

``write_archives`` makes one gzip stream of each partition. ``normalise`` inflates such
a stream once, in pieces of a megabyte, rewrites every record as a gzip member of its
own and writes a sidecar with the offset and length of each member. ``read_archives``
reads single members through the sidecar.

A task writes files under new names and reports them in its result row, which is stored
before the next step; files of a lost attempt are never referred to. Only one record is
held in memory at a time. Null payloads are empty ones; a null page id is written as
``null`` and read back as null; a null url has no target header; of rows with equal
payloads, all rows with the smallest page id are responses (repeated rows included),
and null page ids never are what others refer to unless the group has no other. An empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh_folder
from shelfcast.session import cut_lineage

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PIECE = 1 << 20
MANIFEST = "path string, records long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def mark_revisits(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Add digest, length and, for a repeated payload, the page it repeats.

    Only digests cross the first shuffle; the second join meets only digests that
    occur twice, and a hot digest is split at run time.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(
        "page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.length(payload).cast("long").alias("n_bytes")
    )
    firsts = (
        pages.filter(F.col("n_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
        .filter((F.col("times") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", "n_bytes", refers.alias("refers_to"))


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def record_bytes(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to) -> bytes:
    block = HTTP_HEAD + payload if refers_to is None else HTTP_HEAD
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {n_bytes}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {urn(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def manifest(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["path", "records"]
    )


def write_archives(marked: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """One monolithic gzip file for each partition; returns their paths, stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, path = None, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for page_id, url, html, digest, n_bytes, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs, place = FileSystem.from_uri(path)
                    fs.create_dir(place.rpartition("/")[0], recursive=True)
                    out, packer = fs.open_output_stream(place, compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(packer.compress(record_bytes(page_id, url, (html or "").encode(), digest, n_bytes, refers_to)))
                done += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield manifest([(path, done)])

    columns = ["page_id", "url", "html", "digest", "n_bytes", "refers_to"]
    return cut_lineage(marked.select(columns).mapInArrow(write, MANIFEST))


def inflated(source) -> Iterator[bytes]:
    """The plain bytes of a gzip file, member after member, in bounded pieces."""
    unpacker = zlib.decompressobj(31)
    started = False
    while piece := source.read(PIECE):
        while piece:
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
            started = True
            data = unpacker.decompress(piece, PIECE)
            if data:
                yield data
            piece = unpacker.unconsumed_tail or unpacker.unused_data
    if started and not unpacker.eof:
        raise ValueError("the gzip stream ends early")


def records_of(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and raw bytes of each record of a plain WARC stream."""
    held, need, fields = bytearray(), 0, {}
    for data in stream:
        held += data
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields = header_fields(bytes(held[:end]))
                need = end + 4 + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield fields, bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the last record is cut off")


def normalise(archives: DataFrame, level: int = 3) -> DataFrame:
    """Rewrite each archive with one member for each record, beside a sidecar index."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = FileSystem.from_uri(path)
                name = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex}.members.warc.gz"
                target = FileSystem.from_uri(name)[1]
                offset = done = 0
                with (
                    fs.open_input_stream(place, compression=None) as source,
                    fs.open_output_stream(target, compression=None) as out,
                    fs.open_output_stream(target + ".idx", compression=None) as index,
                ):
                    for fields, raw in records_of(inflated(source)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        entry = {"offset": offset, "length": len(member), "id": fields["warc-record-id"], "type": fields["warc-type"]}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset += len(member)
                        done += 1
                yield manifest([(name, done)])

    return cut_lineage(spread(archives).mapInArrow(rewrite, MANIFEST))


def spread(archives: DataFrame) -> DataFrame:
    """One archive for each task; the list is a stored table of a few bytes for each file."""
    return archives.select("path").repartition(max(1, archives.count()), "path")


def read_member(raw: bytes) -> dict:
    """The result row of one record; a response's digest comes from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields["content-length"])]
    refers_to, n_bytes, digest = None, int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        n_bytes, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
    else:
        refers_to = page_of(fields["warc-refers-to"])
    return {
        "page_id": page_of(fields["warc-record-id"]), "payload_bytes": n_bytes, "payload_digest": digest,
        "record_type": fields["warc-type"], "refers_to": refers_to,
    }


def read_archives(archives: DataFrame, rows: int = 500) -> DataFrame:
    """Every record of normalised archives, each member read at its offset."""
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = FileSystem.from_uri(path)
                found: list[dict] = []
                with fs.open_input_stream(place + ".idx", compression=None) as index, fs.open_input_file(place) as file:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        file.seek(entry["offset"])
                        found.append(read_member(zlib.decompress(file.read(entry["length"]), 31)))
                        if len(found) == rows:
                            yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))
                            found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))

    return spread(archives).mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read every record back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read_archives(normalise(write_archives(mark_revisits(pages, min_bytes), folder)))


