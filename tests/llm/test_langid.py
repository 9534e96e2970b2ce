import random
from zlib import crc32

import numpy as np
from llm.helpers import LONG, awkward, docs_of

from tallyho.llm import langid as L
from tallyho.llm.common import held_out

STEMS = {"en": "the of and ing tion er wh th", "de": "der sch ung keit ein ist ich ver", "fr": "eau eux ment que tion lle ou è",
         "es": "ción que ado ñ mente los ar ó"}


def text_of(lang, seed, n=40):
    r, s = random.Random(f"{lang}{seed}"), STEMS[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randint(1, 3))) for _ in range(n))


def corpus(n=240):
    langs = sorted(STEMS)
    return [(i, text_of(langs[i % 4], i, 3 + i % 60), langs[i % 4], "s") for i in range(n)]


def test_held_out_accuracy(spark):
    docs = docs_of(spark, corpus())
    out = L.predict(docs, L.train(docs), keep=["doc_id", "lang"]).withColumn("held", held_out())
    rows = out.collect()
    assert {r.doc_id for r in rows if r.held} == {i for i in range(240) if crc32(str(i).encode()) % 5 == 0}
    held = [r for r in rows if r.held]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_trains_on_nothing_held_out_or_unlabelled(spark):
    docs = docs_of(spark, corpus() + [(None, "aaa", "xx", "s"), (901, None, "en", "s"), (902, "bbb", None, "s")])
    got = {r.text for r in L.training_sample(docs, "doc_id", "text", "lang").collect()}
    assert got and not got & {r[1] for r in corpus() if crc32(str(r[0]).encode()) % 5 == 0} and not got & {"aaa", "bbb"}


def test_the_sample_is_bounded_and_even(spark):
    docs = docs_of(spark, corpus(1200) + [(5000 + i, text_of("de", i), "rare", "s") for i in range(12)])
    rows = L.training_sample(docs, "doc_id", "text", "lang", most=200).collect()
    counts = {k: sum(r.lang == k for r in rows) for k in {r.lang for r in rows}}
    assert 120 <= len(rows) <= 280 and counts["rare"] >= 6


def test_awkward_rows(spark):
    model = L.train(docs_of(spark, corpus()))
    docs = docs_of(spark, awkward())
    out = L.predict(docs, model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    rows = out.collect()
    assert len(rows) == len(awkward())
    for r in rows:
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == none and (r.score == 0) == none


def test_without_or_with_one_language(spark):
    docs = docs_of(spark, [(1, "abc", None), (2, "", None)])
    assert {(r.lang_pred, r.score) for r in L.predict(docs, L.train(docs)).collect()} == {("und", 0.0)}
    docs = docs_of(spark, [(i, "abc", "en") for i in range(10)])
    assert {(r.lang_pred, r.score) for r in L.predict(docs, L.train(docs)).collect()} == {("en", 1.0)}
    empty = docs_of(spark, [])
    assert L.predict(empty, L.train(empty)).collect() == []


def test_codewords_differ_and_correct_errors():
    for n in (2, 3, 4, 6, 9, 30):
        code = L.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n < 4 else 3)
        assert all(abs(code[:, b].sum()) < n for b in range(code.shape[1]))
    # one wrong bit does not change the decoded language
    code = L.codewords(4)
    model = L.Model(list("abcd"), code, np.eye(7, dtype=np.float32), np.zeros(7), np.ones(7))
    for i in range(4):
        for b in range(7):
            wrong = code[i].copy()
            wrong[b] = -wrong[b]
            assert model.decode(wrong[None])[0][0] == "abcd"[i]


def test_long_text_equals_whole(spark):
    x = L.features(LONG)
    assert x.shape == (L.WIDTH,) and abs(np.linalg.norm(x) - 1) < 1e-5
    assert not np.allclose(x, L.features(LONG[: len(LONG) // 3]))


def test_labels_without_a_letter_teach_nothing():
    m = L.fit([("de", "123 456"), ("en", "789 12")])
    assert m.langs == [] and m.decode(np.zeros((1, L.WIDTH), np.float32)) == [(L.UNKNOWN, 0.0, True)]
    m = L.fit([("de", "der und die"), ("en", "789"), ("fr", "le la les et")])
    assert m.langs == ["de", "fr"]
    found = m.decode(np.array([L.features("und der"), L.features("zzz")]))
    assert found[0][0] == "de" and all(0 <= s <= 1 for _, s, _ in found)
