import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learn(docs.filter(L.fold(F.col("doc_id")) != 1))
    got = L.identify(docs, model, ("lang",)).toPandas()
    held = got[[zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]]
    assert len(held) > 200 and (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 30])
def test_codewords_are_apart(n):
    code = L.codewords(n)
    distance = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert set(np.unique(code)) == {-1, 1} and distance >= max(1, code.shape[1] // 4)
    assert all(len(set(column)) == 2 for column in code.T)


def test_wrong_bits_are_corrected():
    """One lying classifier of the seven does not change the decoded language."""
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (4, L.GRAMS)).astype(float)
    text = "abc abd abe"
    counts[2, L.grams(text)] += 500
    model = L.fit(("de", "en", "es", "fr"), counts, 0.02)
    assert model.predict(text)[0] == "es"
    for b in range(7):
        weights = model.weights.copy()
        weights[:, b] *= -1
        assert L.Model(model.languages, model.code, weights, model.bias, np.ones(7) / 7, 0.02).predict(text)[0] == "es"


def test_a_text_between_languages_is_ambiguous():
    counts = np.ones((2, L.GRAMS))
    counts[0, L.grams("aaaa")] += 50
    counts[1, L.grams("bbbb")] += 50
    model = L.fit(("x", "y"), counts, 0.05)
    assert model.predict("aaaaaaaa")[0] == "x" and model.predict("bbbbbbb")[0] == "y"
    assert not model.predict("aaaaaaaaaaaa")[2] and model.predict("aaaa bbbb")[2]


def test_awkward_rows(awkward):
    got = L.identify(awkward, L.learn(awkward), ("text", "spans")).collect()
    assert len(got) == awkward.count()
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1
    answers = {}
    for r in got:
        assert answers.setdefault(r["text"], r["lang_pred"]) == r["lang_pred"]


def test_nothing_learned(awkward, no_docs):
    model = L.learn(no_docs)
    assert {r["lang_pred"] for r in L.identify(awkward, model).collect()} == {"und"}
    assert L.identify(no_docs, model).count() == 0


def test_one_language_is_always_it(awkward):
    model = L.learn(awkward.filter("lang = 'en'"))
    assert {r["lang_pred"] for r in L.identify(awkward, model).collect()} == {"und", "en"}


def test_pieces_of_long_texts_hold_every_gram():
    text = "abcdefg hij klm " * 9000
    whole = np.sort(L.grams(text))
    assert len(list(L.text_pieces(text))) > 2
    parts = np.concatenate([L.grams(p) for p in L.text_pieces(text)])
    assert set(whole) <= set(parts) and parts.size - whole.size < 30


def test_the_sample_is_bounded(documents):
    counts = []
    original = L.fit
    try:
        L.fit = lambda langs, c, a: counts.append(c.sum()) or original(langs, c, a)
        L.learn(documents, per_language=5)
        L.learn(documents, per_language=100_000)
    finally:
        L.fit = original
    assert counts[0] < counts[1] / 3
