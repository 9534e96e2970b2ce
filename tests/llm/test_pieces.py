import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward, docs_of

from tallyho.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return P.Codec(PATH)


TEXTS = st.text(st.sampled_from(list("abcdeé  \t\n日本𝄞ß▁.,thrn0'<s>")), max_size=40) | st.text(max_size=30)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_equals_the_library(codec, text):
    ids = codec.encode(text)
    assert ids == codec.library.encode(text)
    assert codec.decode(ids) == codec.library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=20))
def test_decodes_any_ids_like_the_library(codec, ids):
    assert codec.decode(ids) == codec.library.decode(ids)


def test_unigram_relaxation_finds_the_best_score(codec):
    """As Viterbi (the rule for unigram models) against all ways to cut a word."""
    c = P.Codec(PATH)
    c.bpe = False
    c.words.clear()
    for word in ("▁thereaction", "▁ababa", "▁x日𝄞th", "▁unbelievable"):
        best = {0: 0.0}
        for e in range(1, len(word) + 1):
            options = [best[s] + c.score[c.id_of[word[s:e]]] for s in range(e) if word[s:e] in c.id_of]
            if word[e - 1] not in c.id_of:
                options.append(best[e - 1] + c.worst)
            best[e] = max(options)
        unknown = [ch for ch in word if ch not in c.id_of]
        pieces = sum(c.score[p] for p in c.word(word) if p not in c.byte_of) + c.worst * len(unknown)
        assert pieces == pytest.approx(best[len(word)])


def test_operators_on_awkward_rows(spark, codec):
    docs = docs_of(spark, awkward())
    encoded = P.encode(docs, "doc_id", "text", PATH)
    want = sorted(((r[0], codec.library.encode(r[1] or "")) for r in awkward()), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr) == want
    decoded = P.decode(encoded, "doc_id", "ids", PATH)
    assert sorted(((r.doc_id, r.text) for r in decoded.collect()), key=repr) == sorted(((r[0], r[1] or "") for r in awkward()), key=repr)
    trip = P.round_trip(docs, "doc_id", "text", PATH).collect()
    assert all(r.same for r in trip) and sorted((r.n_pieces for r in trip)) == sorted(len(x) for _, x in want)


def test_empty_table(spark):
    docs = docs_of(spark, [])
    assert P.round_trip(docs, "doc_id", "text", PATH).collect() == []
    assert P.encode(docs, "doc_id", "text", PATH).collect() == []
