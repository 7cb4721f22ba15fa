import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = T.Vocabulary(PATH)


def check(docs):
    want = []
    for r in docs.collect():
        text = r["text"] or ""
        n = len(PLAIN.encode(text))
        want.append(str((r["doc_id"], len(text.encode()), n, n > 4096)))
    got = T.token_counts(docs, PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(want)


def test_documents(documents):
    check(documents)


def test_awkward_rows(awkward):
    check(awkward)


def test_empty_table(no_docs):
    assert T.token_counts(no_docs, PATH).count() == 0


PIECES = st.sampled_from(
    ["a", "the", " the", "t", "h", "e", "in", "ing", "th", " ", "  ", "▁", "\n", "\t", "'s", "1", "234", "é", "北", "京", "\u0000", "　", "ﬁ", "\U0001f600", "<s>", "</s>", "<unk>", "<0x41>", "----", "xx"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(PIECES, max_size=90).map("".join))
def test_counts_equal_the_library(text):
    assert OWN.count_batch([text]) == [len(PLAIN.encode(text))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="theinra o", max_size=200))
def test_dense_merges_equal_the_heap(text):
    fresh = T.Vocabulary.__new__(T.Vocabulary)
    fresh.__dict__.update(OWN.__dict__, memo={})
    words = T.PRE_TOKEN.findall(T.SPACE + text.replace(" ", T.SPACE))
    by_heap = [OWN.merged_size(OWN.symbols[T.code_points(w)].tolist()) for w in words]
    assert fresh.sizes(words).tolist() == by_heap


@pytest.mark.parametrize("text", [" " * 3000, " " * 9000, "x" * 200_000, "1" * 5000, "ab" * 30_000, "the" * 1300, "北京" * 3000, "日" * 4097])
def test_very_long_pre_tokens(text):
    assert OWN.count_batch([text]) == [len(PLAIN.encode(text))]


def test_equal_pre_tokens_are_merged_once(monkeypatch):
    own, seen = T.Vocabulary(PATH), []
    sizes = own.sizes
    monkeypatch.setattr(own, "sizes", lambda words: seen.extend(words) or sizes(words))
    own.count_batch(["one two one", "two three"])
    own.count_batch(["three two"])
    assert sorted(seen) == ["▁one", "▁three", "▁two"]


def test_a_full_memo_is_emptied(monkeypatch, documents):
    monkeypatch.setattr(T, "MEMO", 50)
    own = T.Vocabulary(PATH)
    for r in documents.limit(20).collect():
        assert own.count_batch([r["text"]]) == [len(PLAIN.encode(r["text"]))]


def test_other_models_are_refused():
    with pytest.raises(Exception):
        T.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
