"""Fold cases: a store's sequential update rules, as table jobs."""

import random

from pyspark.sql import functions as F

from conftest import rows_of
from tallyho.operators import fold as fo
from tallyho.schema import METRIC


def st(df):
    return {(r["id"], r["mtype"]): (r["delta"], r["value"], r["hash"]) for r in df.collect()}


def test_gauge_single_and_overwrite(updates):
    u = updates([dict(seq=1, id="temp", mtype="gauge", value=36.6),
                 dict(seq=2, id="temp", mtype="gauge", value=100.0)])
    assert st(fo.fold_state(u)) == {("temp", "gauge"): (None, 100.0, "")}


def test_counter_accumulates(updates):
    u = updates([dict(seq=1, id="count", mtype="counter", delta=3),
                 dict(seq=2, id="count", mtype="counter", delta=7)])
    assert st(fo.fold_state(u)) == {("count", "counter"): (10, None, "")}


def test_same_id_two_kinds(updates):
    u = updates([dict(seq=1, id="x", mtype="counter", delta=5),
                 dict(seq=2, id="x", mtype="gauge", value=1.5)])
    assert st(fo.fold_state(u)) == {("x", "counter"): (5, None, ""), ("x", "gauge"): (None, 1.5, "")}


def test_thousand_increments(updates):
    u = updates([dict(seq=i, id="counter", mtype="counter", delta=1) for i in range(1000)])
    assert st(fo.fold_state(u)) == {("counter", "counter"): (1000, None, "")}


def test_counter_value_and_hash_from_last_row(updates):
    u = updates([dict(seq=1, id="c", mtype="counter", delta=1, value=9.0, hash="h1"),
                 dict(seq=2, id="c", mtype="counter", delta=2)])
    assert st(fo.fold_state(u)) == {("c", "counter"): (3, None, "")}
    u = updates([dict(seq=2, id="c", mtype="counter", delta=1, value=9.0, hash="h2"),
                 dict(seq=1, id="c", mtype="counter", delta=2, hash="h1")])
    assert st(fo.fold_state(u)) == {("c", "counter"): (3, 9.0, "h2")}


def test_gauge_last_null_value_wins(updates):
    u = updates([dict(seq=1, id="g", mtype="gauge", value=1.0, delta=4),
                 dict(seq=2, id="g", mtype="gauge", value=None)])
    assert st(fo.fold_state(u)) == {("g", "gauge"): (None, None, "")}


def test_int64_wraps_around(updates):
    big = 2**63 - 1
    u = updates([dict(seq=1, id="c", mtype="counter", delta=big),
                 dict(seq=2, id="c", mtype="counter", delta=1),
                 dict(seq=3, id="n", mtype="counter", delta=-(2**63)),
                 dict(seq=4, id="n", mtype="counter", delta=-1)])
    s = st(fo.fold_state(u))
    assert s[("c", "counter")][0] == -(2**63)
    assert s[("n", "counter")][0] == 2**63 - 1


def _wrap(x):
    return (x + 2**63) % 2**64 - 2**63


def test_random_against_sequential_model(updates):
    rnd = random.Random(7)
    rows, model = [], {}
    for seq in range(3000):
        k = rnd.choice(["a", "b", "c"])
        kind = rnd.choice(["counter", "gauge"])
        if kind == "counter":
            d = rnd.choice([rnd.randint(-10, 10), 2**62, -(2**62)])
            rows.append(dict(seq=seq, id=k, mtype=kind, delta=d, hash=rnd.choice(["", "x", "y"])))
            old = model.get((k, kind), (0, None, ""))[0]
            model[(k, kind)] = (_wrap(old + d), None, rows[-1]["hash"])
        else:
            v = rnd.random()
            rows.append(dict(seq=seq, id=k, mtype=kind, value=v))
            model[(k, kind)] = (None, v, "")
    rnd.shuffle(rows)
    assert st(fo.fold_state(updates(rows).repartition(7))) == model


def test_merge_equals_fold_of_all(updates):
    rows = [dict(seq=i, id=f"k{i % 5}", mtype="counter" if i % 2 else "gauge",
                 delta=i if i % 2 else None, value=None if i % 2 else float(i)) for i in range(100)]
    u = updates(rows)
    whole = st(fo.fold_state(u))
    a, b = u.filter(F.col("seq") < 40), u.filter(F.col("seq") >= 40)
    assert st(fo.merge_state(fo.fold_state(a), fo.fold_state(b))) == whole
    # with last_seq, side order does not matter
    m = fo.merge_state(fo.fold_state(b, keep_seq=True), fo.fold_state(a, keep_seq=True))
    assert st(m.drop("last_seq")) == whole


def test_restore_adds_counters(spark, updates):
    cur = fo.fold_state(updates([dict(seq=1, id="c", mtype="counter", delta=5),
                                 dict(seq=2, id="g", mtype="gauge", value=1.0)]))
    snap = spark.createDataFrame([("c", "counter", 3, None, ""), ("g", "gauge", None, 2.0, "")], METRIC)
    assert st(fo.restore_state(cur, snap)) == {("c", "counter"): (8, None, ""), ("g", "gauge"): (None, 2.0, "")}


def test_restore_aborts_on_bad_row(spark, updates):
    cur = fo.fold_state(updates([dict(seq=1, id="c", mtype="counter", delta=5)]))
    snap = spark.createDataFrame([("c", "counter", None, None, "")], METRIC)
    try:
        fo.restore_state(cur, snap).collect()
    except Exception as e:  # noqa: BLE001
        assert "restore aborted" in str(e)
    else:
        raise AssertionError("restore should fail")


def test_store_check_codes(updates):
    u = updates([dict(seq=1), dict(seq=2, id="x", mtype="unknown", delta=1),
                 dict(seq=3, id="x", mtype="counter"), dict(seq=4, id="x", mtype="gauge"),
                 dict(seq=5, id="", mtype="gauge", value=1.0)])
    assert rows_of(fo.store_check(u), "seq", "reject_code") == sorted(
        [(1, "nil_metric"), (2, "unknown_metric_type"), (3, "nil_delta"), (4, "nil_value"), (5, None)], key=repr)


def test_fold_plan_is_hash_aggregate(updates):
    u = updates([dict(seq=1, id="a", mtype="counter", delta=1)])
    plan = fo.fold_state(u.withColumn("hash", F.lit("")))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_inline_hash_pass_matches_separate(updates):
    rows = [dict(seq=i, id=f"k{i % 4}", mtype="counter" if i % 3 else "gauge", delta=i, value=float(i),
                 hash=["", "a", "b"][i % 3]) for i in range(60)]
    u = updates(rows)
    assert st(fo.fold_state(u, hash_pass="inline")) == st(fo.fold_state(u))


def test_rows_of_equal_order_are_never_mixed(updates):
    rows = [dict(seq=1, id="g", mtype="gauge", value=1.0, hash="x"), dict(seq=1, id="g", mtype="gauge", value=2.0)]
    for first in (rows, rows[::-1]):
        for how in ("separate", "inline"):
            got = st(fo.fold_state(updates(first), hash_pass=how))[("g", "gauge")]
            assert got in ((None, 1.0, "x"), (None, 2.0, ""))


def test_merge_plan_joins_once(spark, updates):
    """Two inputs are read once each and joined on the key they are already folded by."""
    a = updates([dict(seq=1, id="a", mtype="counter", delta=1, hash="h")])
    b = updates([dict(seq=2, id="a", mtype="counter", delta=2)])
    merged = fo.merge_state(fo.fold_state(a, hash_pass="inline"), fo.fold_state(b, hash_pass="inline"))
    assert st(merged) == {("a", "counter"): (3, None, "")}
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1


def test_restore_keeps_hashes(spark, updates):
    cur = fo.fold_state(updates([dict(seq=1, id="c", mtype="counter", delta=5, hash="old"), dict(seq=2, id="k", mtype="gauge", value=1.0, hash="k")]))
    snap = spark.createDataFrame([("c", "counter", 3, None, "new")], METRIC)
    assert st(fo.restore_state(cur, snap)) == {("c", "counter"): (8, None, "new"), ("k", "gauge"): (None, 1.0, "k")}
