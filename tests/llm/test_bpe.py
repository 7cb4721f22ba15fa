import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from shelfcast.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    ids = PLAIN.encode(text, add_special_tokens=False).ids
    return ids, PLAIN.decode(ids, skip_special_tokens=False)


def check(docs):
    rows = docs.collect()
    want = []
    for r in rows:
        ids, text = plain(r["text"] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append(str((r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))))
    assert sorted(str(tuple(r)) for r in B.digests(docs, PATH).collect()) == sorted(want)


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward):
    check(awkward)


def test_empty_table(no_docs):
    assert B.digests(no_docs, PATH).count() == 0 and B.encode(no_docs, PATH).count() == 0


def test_round_trip(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = B.encode(documents, PATH).collect()
    assert {r["doc_id"]: r["decoded"] for r in got} == texts
    assert all(r["ids"] == plain(texts[r["doc_id"]])[0] for r in got[:50])


PIECES = st.sampled_from(["a", "b c", " ", "  ", "\n", "\t", "'s", "'", "1", "23 4", "é", "北京", " ", " ", "\u0085", "<|endoftext|>", "<|end", "!?", " \n x", "\U0001f600", "don't "])


MANY_CUTS = B.Codec(PATH, chunk_bits=2)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=120).map("".join))
def test_repaired_ids_agree(text):
    (ids,) = MANY_CUTS.encode_batch([text])
    want, decoded = plain(text)
    assert ids.tolist() == want and MANY_CUTS.decode(ids) == decoded
    assert "".join(MANY_CUTS.parts(text)) == text


def test_shared_passages_are_encoded_once(documents):
    long = max((r["text"] for r in documents.collect()), key=len)
    codec = B.Codec(PATH)
    codec.encode_batch([long])
    before = set(codec.store)
    codec.encode_batch(["Some other words come first. " + long + " And others last."])
    new = [p for p in codec.store if p not in before]
    assert len(before) > 20 and sum(map(len, new)) < len(long) / 4


def test_a_full_store_is_emptied(monkeypatch, documents):
    monkeypatch.setattr(B, "STORE_BYTES", 20_000)
    codec = B.Codec(PATH)
    for r in documents.limit(30).collect():
        assert codec.encode_batch([r["text"]])[0].tolist() == plain(r["text"])[0] and codec.held <= 20_000


def test_a_full_store_serves_until_the_next_is_full(monkeypatch):
    codec = B.Codec(PATH)
    first = [f"some passage number {k} " * 20 for k in range(30)]
    want = [x.tolist() for x in codec.encode_batch(first)]
    # The next batch alone does not fit beside the first one.
    monkeypatch.setattr(B, "STORE_BYTES", codec.held)
    codec.encode_batch([f"another text {k} " * 20 for k in range(20)])
    sent = []

    class Counting:
        def __getattr__(self, name):
            encode = getattr(PLAIN, name)
            return lambda given, **options: sent.extend(given) or encode(given, **options)

    codec.tokenizer = Counting()
    assert [x.tolist() for x in codec.encode_batch(first)] == want and not sent


class Recording:
    """The tokenizer, with the texts that it was given."""

    def __init__(self):
        self.sent = []

    def __getattr__(self, name):
        encode = getattr(PLAIN, name)
        return lambda given, **options: self.sent.extend(given) or encode(given, **options)


def shuffled(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices([f" word{k}ish" for k in range(200)], k=n)) for _ in range(4)]


def test_words_of_new_chunks_are_encoded_once():
    codec = B.Codec(PATH)
    codec.encode_batch(shuffled(2000, 1))
    others = shuffled(2000, 2)
    assert any(p not in codec.store for t in others for p in codec.parts(t))
    codec.tokenizer = Recording()
    assert [x.tolist() for x in codec.encode_batch(others)] == [plain(t)[0] for t in others]
    assert not codec.tokenizer.sent


def test_a_full_word_store_is_bounded_and_words_in_use_stay(monkeypatch):
    monkeypatch.setattr(B, "WORD_BYTES", 20_000)
    monkeypatch.setattr(B, "SPAN", 500)
    codec = B.Codec(PATH)
    codec.encode_batch([" constantly"])
    for k in range(100):
        text = f" constantly number{k} and number{k * k} of {k} things" * 3
        codec.tokenizer = Recording()
        assert codec.encode_batch([text])[0].tolist() == plain(text)[0] and codec.words_held <= 20_000
        assert not any("constantly" in t for t in codec.tokenizer.sent)
    assert codec.older_words


def test_long_words_are_not_kept():
    codec = B.Codec(PATH)
    text = "a " + "北京" * 500 + " b"
    assert codec.encode_batch([text])[0].tolist() == plain(text)[0] and max(map(len, codec.words)) < 10


SCRIPTS = ["Привет", " мир", "ελ", "שלום ", "مرحبا", "한국 ", "ß", "\u2009", "\u3000", "\u180e", "\u200b", "\ufeff", "\x1c", "\x7f", "\r\n", "\u2028", "“x”", "–", "½", " Ⅷ", "\u0378", "e\u0301"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(PIECES, st.sampled_from(SCRIPTS)), max_size=60).map("".join))
def test_ids_of_words_add_up(text):
    assert "".join(B.WORD.findall(text)) == text
    ids = b"".join(B.Codec.encode_words(MANY_CUTS, [w])[w] for w in B.WORD.findall(text))
    want, decoded = plain(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    (ids,) = MANY_CUTS.encode_batch([text])
    assert ids.tolist() == want and MANY_CUTS.decode(ids) == decoded


def test_a_vocabulary_without_some_byte(tmp_path):
    letters = [c for c, b in B.characters_of_bytes().items() if chr(b) != "z"]
    small = Tokenizer(models.BPE(vocab={c: k for k, c in enumerate(letters)}, merges=[]))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(str(tmp_path / "small.json"))
    text = "a lazy dog and a lazier zebra " * 20
    assert B.Codec(str(tmp_path / "small.json")).encode_batch([text])[0].tolist() == small.encode(text).ids


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        B.Codec(public_tokenizers.path("word_bpe_49k.json"))
