import random

from tallyho.llm import common as C


def test_components_equal_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5001 + i) for i in range(300)] + [(7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = C.connected_components(spark.createDataFrame(edges, "a long, b long"))
    rows = {r.node: r.component for r in got.collect()}
    loops = {a for a, b in edges if a == b}
    want = {i: root(i) for i in parent}
    assert {k: v for k, v in want.items() if k in rows or k not in loops} == rows
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_memo_keeps_what_is_used():
    made = []
    memo = C.Memo(lambda k: made.append(k) or k, 10)
    for i in range(100):
        assert memo[i] == i and memo["hot"] == "hot"
        assert len(memo) <= 11 and len(memo.old) <= 11
    assert made.count("hot") == 1
