import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import neighbours as N
from shelfcast.llm import topk as T
from shelfcast.llm.blocks import vectors

VEC = "vec_id long, embedding array<float>, label int, rank int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, 5, "x") for i, v in rows], VEC)


def clustered(n, d=16, centres=40, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, d))
    return [(i, (c[rng.integers(centres)] + 0.3 * rng.standard_normal(d)).astype(np.float32).tolist()) for i in range(n)]


def nearest_by_force(rows, queries, k):
    out = {}
    for qi, q in queries:
        d = [(float(np.sqrt(((np.float64(v) - np.float64(q)) ** 2).sum())), i) for i, v in rows if i != qi]
        out[qi] = sorted(d)[:k]
    return out


def top_by_force(rows, queries, k):
    whole = lambda v: [int(np.floor(256 * float(np.float32(x)))) for x in v]
    rows = [(i, whole(v)) for i, v in rows]
    out = {}
    for qi, q in queries:
        q = whole(q)
        out[qi] = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qi)[:k]
    return out


def by_query(df, score=float):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((score(r["score"]), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_with_several_parts(spark):
    rows = clustered(3000)
    df = vectors(frame(spark, rows), nonzero=True)
    asked = df.filter(F.col("vec_id") % 20 == 0)
    got = by_query(N.nearest(df, asked, 10, block_rows=150, block_queries=40))
    want = nearest_by_force(rows, [r for r in rows if r[0] % 20 == 0], 10)
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want]
    assert np.mean(hits) / 10 > 0.9 and all(len(v) == 10 for v in got.values())
    exact = {i: np.float64(np.float32(v)) for i, v in rows}
    for q, found in got.items():
        assert [s for s, _ in found] == pytest.approx([np.sqrt(((exact[q] - exact[i]) ** 2).sum()) for _, i in found], abs=1e-12)


def test_one_part_is_exact(spark):
    rows = clustered(120, 8)
    df = vectors(frame(spark, rows), nonzero=True)
    got = by_query(N.nearest(df, df.filter("vec_id < 7"), 10, parts=1))
    want = nearest_by_force(rows, rows[:7], 10)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_parts_follow_the_rows():
    assert [N.parts_for(n) for n in (0, 10, 200, 500, 2000, 51_282, 10**9)] == [1, 2, 8, 8, 16, 128, 4096]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_tables(spark, sf, monkeypatch):
    """Several parts are learned on small tables too and recall stays above 0.9; 500 vectors give no part away, 2000 do."""
    learned, learn = [], N.learn_router
    monkeypatch.setattr(N, "learn_router", lambda *a: learned.append(learn(*a)) or learned[-1])
    df = vectors(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"), nonzero=True)
    got = by_query(N.nearest(df, df.filter("vec_id % 20 = 0"), 10))
    assert learned[0].parts >= 4 and (sf == "sf0.01" or learned[0].probes < learned[0].parts)
    rows = [(r["vec_id"], r["vec"]) for r in df.collect()]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    hits = []
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        hits.append(len({i for _, i in found} & set(ids[np.lexsort((ids, d))[:10]].tolist())))
    assert np.mean(hits) / 10 >= 0.9


def test_parts_are_balanced():
    x = np.array([v for _, v in clustered(1024, 8)])
    part = N.balanced_parts(N.neighbour_graph(x, 8), 8, np.random.default_rng(0))
    assert np.bincount(part).tolist() == [128] * 8
    graph = N.neighbour_graph(x, 8)
    assert (part[graph] == part[:, None]).mean() > 0.5


AWKWARD = [
    (0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 2.0, 3.0]), (4, None), (5, [1.0, None, 2.0]),
    (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 0.0, 0.0]), (8, [0.0, 0.0, 0.0]), (9, [1.0, 2.0]), (10, []), (11, [-1.0, 2.0, 0.5]),
    (12, [2.0, 2.0, 3.0]), (12, [2.0, 2.0, 3.0]), (12, [0.0, 2.0, 3.0]), (13, [0.5, 0.5, 0.5]), (None, [1.0, 1.0, 1.0]),
]


def test_awkward_vectors(spark):
    df = vectors(frame(spark, AWKWARD), nonzero=True)
    fine = [(i, v) for i, v in AWKWARD if i in (0, 1, 2, 3, 11, 12, 13)]
    got = by_query(N.nearest(df, df.filter("vec_id IN (0, 3, 13)"), 4))
    want = nearest_by_force(fine, [r for r in fine if r[0] in (0, 3, 13)], 4)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    zero = vectors(frame(spark, AWKWARD))
    fine = [(i, v) for i, v in AWKWARD if i in (0, 1, 2, 3, 8, 11, 12, 13)]
    df = zero.withColumn("vec", T.quantised(F.col("vec")))
    got = by_query(T.top_k(df, df.filter("vec_id IN (0, 3, 8)"), 3), int)
    assert got == {q: [(-s, i) for s, i in v] for q, v in top_by_force(fine, [r for r in fine if r[0] in (0, 3, 8)], 3).items()}


def test_few_candidates(spark):
    df = vectors(frame(spark, clustered(4, 4)), nonzero=True)
    assert {len(v) for v in by_query(N.nearest(df, df, 10)).values()} == {3}
    assert {len(v) for v in by_query(T.top_k(df.withColumn("vec", T.quantised(F.col("vec"))), df.withColumn("vec", T.quantised(F.col("vec"))), 5)).values()} == {3}


def test_empty_tables(spark):
    df = vectors(frame(spark, []), nonzero=True)
    assert N.nearest(df, df, 10).count() == 0
    whole = df.withColumn("vec", T.quantised(F.col("vec")))
    assert T.top_k(whole, whole, 5).count() == 0


@pytest.mark.parametrize("block_rows", [50, 4096])
def test_top_k_equals_brute_force(spark, block_rows):
    rows = clustered(600, 8)
    df = vectors(frame(spark, rows)).withColumn("vec", T.quantised(F.col("vec")))
    got = by_query(T.top_k(df, df.filter("vec_id % 30 = 0"), 5, block_rows, 7), int)
    assert got == {q: [(-s, i) for s, i in v] for q, v in top_by_force(rows, [r for r in rows if r[0] % 30 == 0], 5).items()}


def test_a_hot_vector(spark):
    rows = [(i, [1.0, -2.0, 0.25]) for i in range(400)] + [(400 + i, v) for i, v in clustered(200, 3)]
    df = vectors(frame(spark, rows)).withColumn("vec", T.quantised(F.col("vec")))
    got = by_query(T.top_k(df, df.filter("vec_id % 50 = 0"), 5, 64, 4), int)
    assert got == {q: [(-s, i) for s, i in v] for q, v in top_by_force(rows, [r for r in rows if r[0] % 50 == 0], 5).items()}


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**30 + i, -(2.0**31), 3.5 * i]) for i in range(30)]
    df = spark.createDataFrame([(i, [int(256 * x) for x in v]) for i, v in rows], "vec_id long, vec array<long>")
    got = by_query(T.top_k(df, df.filter("vec_id < 3"), 4), int)
    cut = lambda n: max(-(2**63), min(2**63 - 1, n))
    for q in range(3):
        score = sorted((-cut(sum(int(256 * a) * int(256 * b) for a, b in zip(rows[q][1], v))), i) for i, v in rows if i != q)
        assert [(s, i) for s, i in got[q]] == [(-s, i) for s, i in score[:4]]
