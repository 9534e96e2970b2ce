import hashlib
import zlib

from llm.helpers import awkward, docs_of

from tallyho.llm import shards as S


def brute(rows, n_shards, seed):
    """The same order by sorting everything in one place."""
    count, out, order = {}, [], []
    prepared = []
    for r in rows:
        doc, text, source = r[0], r[1] or "", r[3]
        h = hashlib.md5(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()
        raw = text.encode()
        prepared.append(("n" if source is None else f"s:{source}", (h, (doc is not None, doc or 0), zlib.crc32(raw), len(raw) + 16), doc))
    for stratum in {p[0] for p in prepared}:
        own = sorted((p for p in prepared if p[0] == stratum), key=lambda p: p[1])
        order += [((2 * i + 1) / (2 * len(own)), stratum, p[1], p[2]) for i, p in enumerate(own)]
    order.sort(key=lambda x: x[:3])
    n = len(order)
    for at, (_, stratum, tie, doc) in enumerate(order):
        shard = at * n_shards // n
        out.append((doc, tie[3], tie[2], "rows", shard, at - -(-shard * n // n_shards), None, stratum))
    return sorted(out, key=repr)


def found(spark, rows, n=40):
    return sorted((tuple(r) for r in S.interleave(docs_of(spark, rows), n_shards=n).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = awkward() + [(100 + i, f"text {i}", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(500)]
    for n in (1, 7, 40):
        assert found(spark, rows, n) == brute(rows, n, S.SEED)


def test_law_slots_and_mixture(spark):
    rows = [(i, f"t{i}", None, "hot" if i % 3 == 0 else f"s{i % 10}") for i in range(2000)]
    got = found(spark, rows)
    by = {}
    for r in got:
        by.setdefault(r[4], []).append(r)
    sizes = [len(v) for v in by.values()]
    assert sorted(by) == list(range(40)) and max(sizes) - min(sizes) <= 1
    for v in by.values():
        assert sorted(r[5] for r in v) == list(range(len(v)))
        assert abs(sum(r[7] == "s:hot" for r in v) - len(v) / 3) <= 2


def test_empty_and_fewer_rows_than_shards(spark):
    assert found(spark, []) == []
    assert [r[5] for r in found(spark, [(1, "a", None, "x"), (2, "b", None, "x")])] == [0, 0]


def test_no_python_in_the_plan(spark):
    plan = S.interleave(docs_of(spark, [(1, "a", None, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
