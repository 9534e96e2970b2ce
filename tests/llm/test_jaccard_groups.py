import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward, docs_of, prose

from tallyho.llm import jaccard_groups as J


def words(text):
    return (text or "").encode().lower().split()


def grams(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, n, percent):
    """Component of every row, by comparing all pairs."""
    sets = [grams(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    names = {}
    for i, r in enumerate(rows):
        if r[0] is not None and sets[i]:
            names[root(i)] = min(names.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), names.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def found(spark, rows, n, percent):
    out = J.components(docs_of(spark, rows), n=n, percent=percent)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_equals_brute_force_on_near_copies(spark, n, percent):
    rng, rows = random.Random(n), []
    for base in range(12):
        text = prose(base, rng.choice([2, 4, 9, 14, 40, 120, 300])).split()
        for _ in range(rng.randint(1, 14)):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"edit{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(copy)))
    rows += awkward_ids(rows)
    assert found(spark, rows, n, percent) == brute(rows, n, percent)


def awkward_ids(rows):
    return [(5000 + i if r[0] is not None else None, r[1]) for i, r in enumerate(awkward())]


def test_chunks_of_one_group_and_unions(spark, monkeypatch):
    """Groups far smaller than the near copies that share a leader are joined by their unions."""
    monkeypatch.setattr(J, "GROUP", 3)
    text = prose(77, 80).split()
    rows = []
    for i in range(40):
        copy = list(text)
        copy[(7 * i) % 80] = f"x{i}"
        if i % 4 == 0:
            copy[(11 * i + 3) % 80] = f"y{i}"
        rows.append((i, " ".join(copy)))
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_more_buckets_than_signatures(spark):
    text = prose(5, 1500).split()
    rows = []
    for i in range(6):
        copy = list(text)
        for k in range(i * 9):
            copy[(k * 131 + i) % 1500] = f"e{i}x{k}"
        rows.append((i, " ".join(copy)))
    assert found(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_a_common_passage_is_left_out(spark):
    """Documents that share a passage, and near copies of some: signatures of the passage are
    in most nodes and go, those that a linked pair needs stay."""
    passage = prose(77, 30)
    rows = []
    for i in range(60):
        own = prose(1000 + i, 70).split()
        rows.append((2 * i, passage + " " + " ".join(own)))
        own[i] = "changed"
        if i % 3 == 0:
            rows.append((2 * i + 1, passage + " " + " ".join(own)))
    want = brute(rows, 5, 80)
    assert found(spark, rows, 5, 80) == want


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([(3, 90), (5, 80)]), st.integers(20, 900))
def test_linked_sets_share_a_signature_whatever_is_left_out(seed, kind, size):
    """All signatures listed (most=None): whichever may be left out, one in common stays, if
    both leave them out in one order."""
    _, percent = kind
    r = np.random.default_rng(seed)
    classes = J.size_classes(percent)
    a = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
    b = a.copy()
    while True:  # as many tokens replaced as the threshold allows
        c = b.copy()
        c[r.integers(len(c))] = r.integers(0, 2**63, dtype=np.uint64)
        common = len(np.intersect1d(a, c))
        if 100 * common < percent * (len(a) + len(np.unique(c)) - common):
            break
        b = np.unique(c)
    lists = {}
    for name, s in (("a", a), ("b", b)):
        for sig, spare in J.signatures(s, classes, None):
            order = sorted(sig.tolist(), key=lambda x: (hash((x, seed)), x))  # any order that both use
            lists.setdefault(name, set()).update(order[:len(order) - spare])
    assert lists["a"] & lists["b"] or len(a) < classes[0][1]


def test_empty_table(spark):
    assert found(spark, [], 3, 90) == []
    assert J.keep_one(docs_of(spark, [])).collect() == []


def test_keep_one(spark):
    docs = docs_of(spark, awkward())
    kept = J.keep_one(docs.select("doc_id", "text", "lang"), n=3, percent=90)
    got = sorted(((r.doc_id, len(r.text) if r.text else r.text) for r in kept.collect()), key=repr)
    rows = {(r[0], r[1]) for r in awkward()}
    a, long = next(r[1] for r in awkward() if r[0] == 1), next(r[1] for r in awkward() if r[0] == 6)
    want = [(i, len(t) if t else t) for i, t in rows
            if not (t == a and i == 2) and not (t == a + " x") and not (t == long + " end")]
    assert got == sorted(want, key=repr)


def test_sizes_and_buckets():
    lows, buckets = J.size_classes(90)
    for size in (1, 2, 9, 10, 11, 50, 1234):
        level = max(i for i, low in enumerate(lows) if low <= size)
        largest = size * 100 // 90
        partner = max(i for i, low in enumerate(lows) if low <= largest)
        assert partner - level <= 1
        # two linked sets of this class differ in fewer tokens than it has buckets
        assert (size + largest) * 10 // 190 < buckets[partner]


def test_arguments(spark):
    with pytest.raises(ValueError):
        J.components(docs_of(spark, []), percent=50)
