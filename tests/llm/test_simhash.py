import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from shelfcast.llm import components as C
from shelfcast.llm import simhash as S


def plain_fingerprint(text, width=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    """rows: (doc_id, fingerprint); smallest id that links reach from each fingerprint."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {f: least.get(find(f)) for f in fps}


def check(docs):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    group = plain_components(rows)
    got = S.near_duplicates(docs).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got], key=key) == sorted([(i, f"{f:016x}", group[f]) for i, f in rows], key=key)


def test_documents_equal_brute_force(documents):
    check(documents.limit(80))


def test_awkward_rows(awkward):
    check(awkward.filter("coalesce(length(text), 0) < 10000"))


def test_empty_table(no_docs):
    got = S.near_duplicates(no_docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


def near_fingerprints(n=3000, seed=1):
    rng = random.Random(seed)
    fps = {rng.getrandbits(64) for _ in range(n // 3)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    chain = 5
    for _ in range(60):
        chain ^= 1 << rng.randrange(64)
        fps.add(chain)
    return sorted(fps)[:n]


@pytest.mark.parametrize("shard_rows", [1 << 16, 1])
def test_planted_links(spark, shard_rows):
    fps = near_fingerprints()
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    marked = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r["fp"] & (2**64 - 1): r["component_id"] for r in S.groups(marked, 2, shard_rows).collect()}
    assert got == plain_components(list(enumerate(fps)))


def test_forest_finds_every_pair():
    rng = np.random.default_rng(0)
    group = np.sort(rng.integers(0, 5, 400))
    fps = rng.permutation(1 << 12)[:400].astype(np.uint64)
    forest = S.Forest(fps, group)
    got = {(int(a), int(b)) for q, n, _ in forest.near(np.arange(400), 2) for a, b in zip(q, n)}
    want = {(a, b) for a in range(400) for b in range(a) if group[a] == group[b] and int(fps[a] ^ fps[b]).bit_count() <= 2}
    assert got == want


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 2000 + i) for i in range(300)]
    loops = [(7000, 7000)]
    got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(path + star + loops, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {2000 + i: 1000 for i in range(300)}


def test_larger_radius_is_refused(spark):
    with pytest.raises(ValueError):
        S.groups(spark.createDataFrame([(1, 2)], "doc_id long, fp long"), 3)


def plain_stays(rows):
    """The row that stays of each group that links of at most two bits reach, by comparing all texts."""
    texts = sorted({t or "" for _, t in rows})
    fps = [S.fingerprint(t.encode(), 3) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    place = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for i, t in rows:
        g, key = place[t or ""], (i is None, i or 0)
        least[g] = min(least.get(g, key), key)
    return sorted(least.values())


def check_stays(docs):
    got = S.one_of_each(docs)
    assert got.columns == docs.columns
    want = plain_stays([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == want


def test_one_of_each_given_document(documents):
    check_stays(documents)


def test_one_of_each_awkward_row(awkward, no_docs):
    check_stays(awkward.filter("coalesce(length(text), 0) < 100000"))
    assert S.one_of_each(no_docs).count() == 0


def test_one_of_each_hot_group(spark):
    rows = [(i, "the same words again and again in all of these rows") for i in range(200)] + [(500 + i, f"other {i} words {i * i} here {i} and there {i + 7}") for i in range(50)]
    rows += [(None, rows[0][1]), (7, rows[0][1]), (7, "two texts have one id"), (7, "two texts have one id")]
    check_stays(spark.createDataFrame(rows, "doc_id long, text string"))
