import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfcast.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, n_convs long, key string, shard int"


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    """Nodes of the trie by dictionaries of prefixes."""
    whole, members, kids = rebuild(rows), defaultdict(list), defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if whole[c] == p).encode()).hexdigest()
    return sorted(
        str((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], sha(p))) for p, m in members.items()
    )


def check(spark, rows, shard_turns=T.SHARD_TURNS, parts=7):
    df = spark.createDataFrame([(*r, 9, "k", 4) for r in rows], SCHEMA).repartition(parts)
    got = T.conversation_trie(df, shard_turns)
    assert got.columns == list(T.RESULT)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def some_rows(seed, convs=150, lengths=(0, 1, 2, 3, 9, 16, 17, 40), family=1):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        shared = random.Random(rng.randint(0, 5))
        rows += [(c * family, t, shared.choice(["u", "m", None]), shared.choice(["a", "b", "éé", None, "x" * 50])) for t in range(rng.choice(lengths))]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    # Each conversation and turn has one text, so the order of ties does not matter.
    check(spark, some_rows(seed, family=[1, 5, -1][seed]))


def test_many_small_shards(spark):
    check(spark, some_rows(11, convs=120, family=5), shard_turns=20)


def test_one_conversation_many_times(spark):
    rows = [(5 * k, t, "u", f"turn {t}") for k in range(300) for t in range(3)]
    check(spark, rows + [(c + 20_000, *r) for c, *r in some_rows(4, convs=30)], shard_turns=40)


def test_long_conversations(spark):
    rows = [(c, t, "u", "same" if t < 150 else f"{c}") for c in (0, 5, 10, 15) for t in range(100 * (c // 5) + 30)]
    check(spark, rows, shard_turns=60)


def test_nulls_repeated_rows_and_turnless(spark):
    rows = [(None, 1, "u", "lost"), (3, None, None, None), (3, 0, "u", ""), (3, 0, "u", ""), (4, 0, None, "a"), (4, 1, "b", None), (0, 0, "u", "t"), (-3, 0, "u", "t"), (21, 0, "u", "head")]
    check(spark, rows)


def test_empty_table(spark):
    assert T.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ties_of_a_turn_number_have_one_order(spark):
    rows = [(5, 1, "u", f"text {k}", 0, "", 0) for k in range(20)]
    runs = [sorted(map(str, T.conversation_trie(spark.createDataFrame(random.Random(s).sample(rows, 20), SCHEMA)).collect())) for s in (1, 2)]
    assert runs[0] == runs[1] and len(runs[0]) == 21


def test_given_table(spark, tables):
    df = spark.read.parquet(f"{tables}/conversations.parquet")
    got = T.conversation_trie(df, shard_turns=100)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute([tuple(r) for r in df.collect()])


def test_matrices_sort_like_tuples():
    rng = np.random.default_rng(2)
    length = rng.choice([0, 1, 5, 16, 17, 33, 50], 200)
    ids = rng.integers(0, 2, (length.sum(), 2))
    offset, conv = np.cumsum(length) - length, rng.permutation(200)
    order = T.sorted_order(ids, offset, length, conv)
    want = sorted(range(200), key=lambda i: ([tuple(x) for x in ids[offset[i] : offset[i] + length[i]]], conv[i]))
    assert order.tolist() == want
