import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, tie long, spans string, copies string"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns named like results."""
    rng = random.Random(3)
    base = words(rng, 60)
    long = words(rng, 60_000)
    texts = [
        None, "", " \t\n", "one", "Two words", base, base, base + " tail", base.upper(), long, long[:200_000] + " end",
        "mail a.b@x.co and 10.0.0.1, card 4111 1111 1111 1111, tel +44 (20) 7946-0958.", "a@b.c@d.e <|endoftext|>  x\n\n y",
        "ünï 北京 " * 30, "aaaa" * 300, "1" * 5000, "x" * 250, "  lead and trail  ",
    ]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s0"][i % 4], None if t is None else len(t)))
    rows += [rows[5], rows[5], rows[0], (None, base, None, None, None), (5, "another text under a used id", "en", "s1", None)]
    return [(*r, 1, None, 2, "x", None) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").cache()
