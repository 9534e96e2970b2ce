import math
import random
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward, docs_of, prose

from tallyho.llm import toxicity as X

BAD = "scum idiot loweiung loweiheit lowein".split()


def brute_segments(scores):
    """Maximal segments by definition: split at the best segment (leftmost, longest), again on both sides."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (top is None or total > top[2] or total == top[2] and False):
                    top = (i, j, total)
        return top

    def split(lo, hi):
        b = best(lo, hi)
        return [] if b is None else split(lo, b[0]) + [b] + split(b[1] + 1, hi)

    return split(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-40, 40).map(lambda v: v + random.Random(v).random() / 1000), max_size=25))
def test_segments_equal_brute_force(values):
    # distinct sums, so that the definition leaves no choice between equal segments
    scores = [v + i * 1.37e-6 for i, v in enumerate(values)]
    got = X.maximal_segments(np.array(scores, float))
    want = brute_segments(scores)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], abs_tol=1e-9) for g, w in zip(got, want))


def corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        words, toxic = prose(i, 20 + i % 50).split(), int(i % 5 == 0)
        if toxic:
            for k in range(1 + i % 3):
                words.insert((i * 7 + k) % len(words), BAD[(i + k) % 5])
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, toxic))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_stems(spark):
    docs, labels = corpus()
    table = docs_of(spark, docs)
    model = X.train(table, spark.createDataFrame(labels, LABELS))
    rows = X.score(table, model, keep=["doc_id"]).collect()
    held = [r for r in rows if crc32(str(r.doc_id).encode()) % 5 == 0]
    truth = {i: t for i, _, t in labels}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    # a form never seen is known by its stem; its passage is found where it stands
    m, segments = model.passages("river stone loweixyzq night")
    assert m == 4 and [s[:2] for s in segments] == [(2, 2)]


def test_never_learns_from_held_out(spark):
    docs, labels = corpus(200)
    held = [i for i, *_ in docs if crc32(str(i).encode()) % 5 == 0]
    docs = [(i, t + (" secretword" if i in held else ""), lang, s) for i, t, lang, s in docs]
    sample, _ = X.training_sample(docs_of(spark, docs), spark.createDataFrame(labels, LABELS), "doc_id", "text")
    assert not [r for r in sample.collect() if "secretword" in r._text]


def test_awkward_rows_and_labels(spark):
    docs, labels = corpus(200)
    labels += [(None, 1, 1), (3, 1, None), (7, 1, 1), (7, 1, 0), (99999, 1, 1)]
    model = X.train(docs_of(spark, docs), spark.createDataFrame(labels, LABELS))
    table = docs_of(spark, awkward())
    out = X.score(table, model)
    assert out.columns == [c for c in table.columns if c not in ("score", "predicted")] + ["score", "predicted", "passages"]
    rows = out.collect()
    assert len(rows) == len(awkward())
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert all(r.predicted == 0 for r in rows if not (r.text or "").strip())


def test_degenerate_training(spark):
    docs = docs_of(spark, [(i, "a b c") for i in range(20)])
    none = spark.createDataFrame([], LABELS)
    assert all(r.score < 1e-9 for r in X.score(docs, X.train(docs, none)).collect())
    for toxic in (0, 1):
        one = spark.createDataFrame([(i, 1, toxic) for i in range(20)], LABELS)
        assert {r.predicted for r in X.score(docs, X.train(docs, one)).collect()} == {toxic}
    empty = docs_of(spark, [])
    assert X.score(empty, X.train(empty, none)).collect() == []


def test_lambda_solves_its_equation():
    v, p = np.array([5.0, -0.1]), np.array([0.001, 0.999])
    lam = X.karlin_lambda(v, p)
    assert abs((p * np.exp(lam * v)).sum() - 1) < 1e-6
    assert X.karlin_lambda(np.array([-0.1]), np.array([1.0])) == 1.0
