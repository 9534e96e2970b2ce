import random
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import LONG, awkward, docs_of

from tallyho.llm import spelling as S

LETTERS = "abnéz"


def edits(w, letters):
    """All texts one edit from ``w``."""
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return (out | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}) - {w}


def grams_of(words, share):
    cnt = Counter(f"^{w}$"[i:i + q] for w in words for q in range(S.QMIN, S.QMAX + 1) for i in range(len(w) + 3 - q))
    counts = {g: n for g, n in cnt.items() if n > share * sum(len(w) + 1 for w in words)}
    return S.Grams(frozenset(g for g in counts if len(g) < S.QMAX)), counts


WORDS = st.lists(st.text(LETTERS, min_size=6, max_size=12), min_size=1, max_size=30)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.sampled_from([0, 0.01, 0.05, 1]), st.integers(0, 10**6))
def test_an_edit_affects_no_more_grams_than_the_bound(words, share, seed):
    """Grams of a word that its edited text no longer has at the place they must be."""
    grams, _ = grams_of(words, share)
    w = words[0]
    mine = grams.decompose(f"^{w}$")
    most = grams.affected(f"^{w}$", mine)
    for other in random.Random(seed).sample(sorted(edits(w, LETTERS)), 12):
        theirs = set(grams.decompose(f"^{other}$"))
        d = len(other) - len(w)
        lost = sum((p, g) not in theirs and (p + d, g) not in theirs for p, g in mine)
        assert lost <= most


@settings(max_examples=200, deadline=None)
@given(WORDS, st.sampled_from([0, 0.02, 1]), st.integers(0, 10**6))
def test_near_words_meet_in_a_list(words, share, seed):
    grams, counts = grams_of(words, share)
    w = words[0]
    lists = lambda x, probe: {e[:3] for e in S.entries(x, grams, counts) if e[3] == probe}
    for other in random.Random(seed).sample(sorted(edits(w, LETTERS)), 12):
        if len(other) >= S.LEAST_CHARS:
            a, b = sorted((w, other), key=lambda x: (len(x), x))
            assert lists(a, True) & lists(b, False), (a, b)


def brute(docs, damage):
    count = Counter()
    for i, text, *_ in docs:
        run = ""
        for c in (text or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                h = crc32(f"{'' if i is None else i}:{run}".encode())
                if damage and h % damage == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                count[run] += 1
                run = ""
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    letters = sorted({c for w in words for c in w})
    out = {}
    for w, n in words.items():
        near = [x for x in edits(w, letters) if x in words]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if best and words[best] >= 5 * n else None, n, len(near))
    full = set()
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        full.add((w, form, root, n, near, form and out[form][1]))
    return full


def corpus():
    r = random.Random(4)
    bases = ["".join(r.choice("aeinrst") for _ in range(r.randint(5, 9))) for _ in range(25)]
    texts = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = r.choice(bases)
            if r.random() < 0.35:
                w = r.choice(sorted(edits(w, "aeinrst")))
            words.append(w.upper() if r.random() < 0.05 else w)
        texts.append((i, " ".join(words), "en", "s"))
    # a chain of forms: n, 5 n, 25 n
    return texts + [(500, "chainword " * 125 + "chainwords " * 25 + "chainwordss " * 5, "en", "s")]


@pytest.mark.parametrize("share", [1 / 20_000, 0.01, 0.5])
def test_query_equals_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(S, "SHARE", share)
    monkeypatch.setattr(S, "HELD", 50)
    rows = corpus() + awkward() + [(600, LONG + " Ünïvérsité ünïvérsité" * 9, "fr", "u"), (601, "÷×ÀàÿŸ" * 3, None, None)]
    found = S.group_variants(S.count_words(docs_of(spark, rows), "doc_id", "text", 7).where("n >= 5"))
    want = brute(rows, 7)
    assert {tuple(r) for r in found.collect()} == want
    assert len([w for w in want if w[1]]) > 20
    assert ("chainwordss", "chainwords", "chainword") in {tuple(r)[:3] for r in S.group_variants(
        S.count_words(docs_of(spark, rows), "doc_id", "text").where("n >= 5")).collect()}


def test_empty_tables(spark):
    none = S.count_words(docs_of(spark, []), "doc_id", "text")
    assert none.collect() == [] and S.group_variants(none).collect() == []
    assert S.group_variants(S.count_words(docs_of(spark, [(1, None, None, None), (2, "a bc 12", None, None)]), "doc_id", "text")).collect() == []
