"""Bodies of bounded size."""

import json

import pytest

from tallyho.sinks import bodies as bo


@pytest.mark.parametrize("block", [3, 4096])
def test_bodies_hold_all_rows_in_order_and_keep_their_size(spark, monkeypatch, block):
    monkeypatch.setattr(bo, "BLOCK", block)
    rows = [("ab"[i % 2], f"k{i:04d}", json.dumps({"id": f"k{i:04d}", "x": "é" * (i % 9)}, ensure_ascii=False)) for i in range(600)]
    rows += [("a", "k0100b", json.dumps({"id": "k0100b", "x": "y" * 300})), ("c", "one", json.dumps({"id": "one", "x": "y" * 5000}))]
    df = spark.createDataFrame(rows, "type string, id string, json string").repartition(5)
    out = bo.cut_bodies(df, "type", "id", "json", 1024).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.type, r.first)):
        items = json.loads(r.body)
        assert len(items) == r.n and min(i["id"] for i in items) == r.first
        assert [i["id"] for i in items] == sorted(i["id"] for i in items)
        assert len(r.body.encode()) <= 1024 or r.n == 1
        got.setdefault(r.type, []).extend(i["id"] for i in items)
    assert {g: sorted(i) for g, i in got.items()} == {g: sorted(i for t, i, _ in rows if t == g) for g in "abc"}
    full = [len(r.body.encode()) for r in out if r.n > 1]
    assert len(full) > 20 and sorted(full)[len(full) // 2] > 700  # cut late, not early
    assert bo.cut_bodies(df.limit(0), "type", "id", "json").collect() == []
