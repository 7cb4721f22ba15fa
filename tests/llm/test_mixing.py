import re
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import mixing as M
from shelfcast.llm import queries


def plain_targets(sizes, cap=3.0):
    """By repeated sharing, in exact steps."""
    w = [i % 3 + 1 for i in range(len(sizes))]
    capped = set()
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in capped)
        rest = sum(w[i] for i in range(len(sizes)) if i not in capped)
        t = [cap * sizes[i] if i in capped else left * w[i] / rest for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in capped and t[i] > cap * sizes[i]}
        if not over:
            return t
        capped |= over


def check(docs):
    rows = docs.collect()
    got = M.assign(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    target = dict(zip(names, plain_targets([sizes[s] for s in names])))
    taken = Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and sum(c["words"] for c in r["copies"]) == r["taken"]
        assert all(0 <= c["position"] <= 1 for c in r["copies"])
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= 1
    same = lambda t: sorted(str(tuple(r)) for r in t)
    assert same(got) == same(M.assign(docs.repartition(5)).collect())
    return got


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward):
    check(awkward)


def test_empty_table(no_docs):
    assert M.assign(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("sizes", [[10], [10, 0, 0], [1, 1, 100], [1, 2, 3, 4, 1000], [0, 0], [5, 1, 1, 1, 1, 1, 900, 3]])
def test_targets(sizes):
    got = M.capped_targets(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert got == pytest.approx(plain_targets(sizes) if sum(sizes) else [0] * len(sizes))
    assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))


def test_positions_invert_the_schedule(spark):
    knots = [(0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 3.0)]
    grid = np.linspace(0, 1, 200_001)
    rate = np.interp(grid, [k[0] for k in knots], [k[1] for k in knots])
    total = np.concatenate(([0], np.cumsum((rate[1:] + rate[:-1]) / 2)))
    total /= total[-1]
    parts = [0.01 * i for i in range(100)]
    pieces = spark.createDataFrame([(M.segments(knots),)], "p array<struct<y0:double,y1:double,t0:double,t1:double,w0:double,w1:double>>")
    df = spark.createDataFrame([(p,) for p in parts], "part double").join(pieces)
    got = {r["part"]: r["at"] for r in df.select("part", M.training_position(df["part"], df["p"]).alias("at")).collect()}
    for p in parts[1:]:
        assert np.interp(got[p], grid, total) == pytest.approx(p, abs=1e-4)


def test_sources_change_over_time(documents):
    """The first source of three leads at the start, the third at the end."""
    got = M.assign(documents).collect()
    names = sorted({r["source"] for r in got})
    mean = {k: np.average([c["position"] for r in got if names.index(r["source"]) % 3 == k for c in r["copies"]]) for k in range(3)}
    assert mean[0] < mean[1] < mean[2]


def test_mixed_documents(documents):
    taken = {r["doc_id"]: r["taken"] for r in M.assign(documents).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = M.mixed_documents(documents).collect()
    count = Counter()
    for r in got:
        assert texts[r["doc_id"]].lstrip().startswith(r["text"].lstrip()) and r["n_chars"] == len(r["text"])
        count[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert count == Counter({i: n for i, n in taken.items() if n})
    where = {}
    for r in M.assign(documents).collect():
        where.setdefault(r["doc_id"], []).extend(c["position"] for c in r["copies"])
    order = [min(where[r["doc_id"]]) if len(where[r["doc_id"]]) == 1 else None for r in got]
    single = [p for p in order if p is not None]
    assert single == sorted(single)


def test_the_query_stands_in_training_order(spark, tmp_path, awkward, documents):
    awkward.unionByName(documents, allowMissingColumns=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op10_curriculum_mix(spark, str(tmp_path)).collect()
    order = [(r["first_position"] is None, r["first_position"] or 0.0) for r in got]
    assert order == sorted(order) and order[0] < order[-1] and len(got) == awkward.count() + documents.count()
    assert all((r["taken"] == 0) == (r["first_position"] is None) for r in got)


def test_bad_schedules():
    for knots in ([(0.0, 1.0)], [(0.0, 0.0), (1.0, 0.0)], [(0.0, 1.0), (0.0, 2.0)], [(0.0, -1.0), (1.0, 3.0)]):
        with pytest.raises(ValueError):
            M.segments(knots)
