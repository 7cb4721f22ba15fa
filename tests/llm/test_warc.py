import gzip
import hashlib
import json
import os
import random
import zlib

import pytest

from shelfcast.llm import warc as W
from shelfcast.session import cut_lineage

SCHEMA = "page_id long, url string, html string, digest string, first long, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p") for r in rows], SCHEMA)


def awkward_pages():
    rng = random.Random(1)
    big = "".join(rng.choice("ab<>é \r\n") for _ in range(300_000))
    same = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\n</p>"
    return [
        (1, "http://a/", None), (2, None, ""), (3, "http://b/\r\nX: y", "short"), (4, "http://b/é?q=ü", "short"), (9, "u", same), (7, "u", same),
        (8, None, same), (7, "u", same), (10, "u", big), (11, "u", big), (None, "u", "n" * 150), (None, "u", same), (12, "u", "é" * 50), (13, "u", "é" * 50),
        (14, "u", "e" * 99), (15, "u", "e" * 99),
    ]


def plain(rows, least=100):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        payload = (h or "").encode()
        refers = first.get(h) if first.get(h) != i else None
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return out


def by_text(rows):
    return sorted(map(str, map(tuple, rows)))


def test_awkward_pages(spark):
    rows = awkward_pages()
    # A null page id whose payload nobody else has refers to nothing.
    assert by_text(W.round_trip(frame(spark, rows)).collect()) == by_text(plain(rows))


def test_pages(spark, tables):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert by_text(W.round_trip(pages.unionAll(pages.selectExpr("page_id + 100000", "url", "html"))).collect()) == by_text(
        plain(rows + [(i + 100000, u, h) for i, u, h in rows])
    )


def test_empty_table(spark):
    assert W.round_trip(frame(spark, [])).collect() == []


def test_members_and_index(spark, tmp_path):
    archives = W.write_archives(W.mark_revisits(frame(spark, awkward_pages())).coalesce(1), str(tmp_path))
    (mono,) = [r["path"] for r in archives.collect()]
    raw = open(mono, "rb").read()
    one = zlib.decompressobj(31)
    plain_stream = one.decompress(raw)
    assert one.eof and not one.unused_data  # a single member
    (path,) = [r["path"] for r in W.normalise(archives).collect()]
    members = open(path, "rb").read()
    assert gzip.decompress(members) == plain_stream
    entries = [json.loads(x) for x in open(path + ".idx")]
    assert len(entries) == len(awkward_pages()) and os.path.getsize(path) == sum(e["length"] for e in entries)
    for e in entries:
        own = zlib.decompressobj(31)
        record = own.decompress(members[e["offset"] : e["offset"] + e["length"]])
        assert own.eof and not own.unused_data and record.startswith(b"WARC/1.1\r\n") and e["id"].encode() in record
        assert b"\r\nX: y" not in record.partition(b"\r\n\r\n")[0]


def test_broken_archives_are_reported(spark, tmp_path):
    whole = gzip.compress(W.record_bytes(1, "u", b"x" * 5000, hashlib.sha256(b"x" * 5000).hexdigest(), 5000, None))
    for name, data in (("cut", whole[:-20]), ("half", gzip.compress(gzip.decompress(whole)[:-300])), ("other", gzip.compress(b"no warc\r\n\r\n"))):
        path = tmp_path / f"{name}.warc.gz"
        path.write_bytes(data)
        with pytest.raises(Exception, match="early|cut off|no WARC"):
            W.normalise(cut_lineage(spark.createDataFrame([(str(path), 1)], W.MANIFEST))).collect()
