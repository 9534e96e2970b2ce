import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward, docs_of, prose

from tallyho.llm import digest as D


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400) | st.lists(st.sampled_from([0, 65, 66, 255]), max_size=300).map(bytes))
def test_entropy_equals_brute_force(data):
    x = np.frombuffer(data, np.uint8)
    got = D.entropy_steps(x)
    assert len(got) == max(0, len(data) - 63)
    for i, g in enumerate(got):
        c = np.unique(x[i:i + 64], return_counts=True)[1] / 64
        exact = -(c * np.log2(c)).sum() * D.STEPS / 6
        assert abs(g - min(exact, D.STEPS - 1)) <= 1.01


def test_short_and_long_texts_together():
    texts = [b"", b"abc", prose(1, 50).encode(), b"x" * 70, (prose(2, 60_000)).encode(), prose(3, 30).encode()]
    for t, steps in zip(texts, D.each_steps(texts)):
        assert (steps == D.entropy_steps(np.frombuffer(t, np.uint8))).all()


def test_blocks_do_not_show():
    x = np.frombuffer(prose(9, 20_000).encode(), np.uint8)
    assert len(x) > 2 * D._BLOCK
    tail = D.entropy_steps(x[D._BLOCK - 100:D._BLOCK + 200])
    assert (D.entropy_steps(x)[D._BLOCK - 100:D._BLOCK + 200 - 63] == tail).all()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, r in enumerate(order):
        t, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 2
        out[r[0]] = (len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest())
    return out


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(D, "RANGE_ROWS", 7)
    rows = [(i * 3 - 50, prose(i, i % 90) if i % 11 else None) for i in range(100)] + [(None, "null id")]
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in D.fingerprints(docs_of(spark, rows)).collect()}
    assert got == brute(rows)


def test_likeness(spark):
    texts = [prose(i, 400) for i in range(20)]
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, t) for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in D.fingerprints(docs_of(spark, rows)).collect()}
    for i in range(20):
        a, b = out[2 * i], out[2 * i + 1]
        assert a.fingerprint == b.fingerprint and a.near_next == 1.0
        assert a.near_edited > 0.9  # the next document is equal, so only the order of halves changed
        assert 0 <= b.near_next < 0.2 and b.near_edited > 0.25


def test_chain_grows_with_the_text():
    rank = D.precedence(np.ones(D.STEPS, np.int64))
    short, long = D.digests([prose(1, 100).encode(), prose(2, 20_000).encode()], rank)
    assert len(short) == 1 and len(long) > 3 and D.likeness(long, long) == 1.0
    half = D.digests([prose(2, 10_000).encode()], rank)[0]
    assert D.likeness(half, long) > 0.5


def test_awkward_rows(spark):
    rows = D.fingerprints(docs_of(spark, awkward())).collect()
    assert len(rows) == len(awkward())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.n_chars == 0}) == 1


def test_one_document_and_empty_table(spark):
    assert D.fingerprints(docs_of(spark, [])).collect() == []
    (r,) = D.fingerprints(docs_of(spark, [(5, "abcd")])).collect()
    assert (r.n_chars, r.edited_sha256, r.near_next) == (4, hashlib.sha256(b"abab").hexdigest(), 1.0)
