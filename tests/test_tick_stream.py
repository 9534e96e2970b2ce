"""Reports by time from a running stream: gaps, restarts, ticks without input."""

import datetime as dt
import os

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows_of
from tallyho.operators.window import tick_snapshot
from tallyho.session import scratch_path
from tallyho.streaming import tick_stream as ts

SCHEMA = "seq long, ts timestamp_ntz, id string, mtype string, delta long, value double, hash string"
DAY = 86400


def day(d, h=0):
    return dt.datetime(2024, 1, d, h)


def drain(spark, src, clock, out, ckpt):
    updates = spark.readStream.schema(SCHEMA).parquet(src)
    ticks = spark.readStream.schema("ts timestamp_ntz").parquet(clock)
    q = ts.start_tick_stream(updates, out, ckpt, DAY, clock=ticks, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_ticks_come_out_as_the_clock_moves(spark):
    src, clock, out, ckpt = (scratch_path(spark, n) for n in ("src", "clock", "ticks", "ckpt"))
    for d in (src, clock):
        os.makedirs(d)

    def add(rows, until):
        if rows:
            spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)
        spark.createDataFrame([(until,)], "ts timestamp_ntz").write.mode("append").parquet(clock)
        drain(spark, src, clock, out, ckpt)  # a restart each time
        got = spark.read.parquet(out)
        return sorted((r.tick.day, r.id, r.mtype, r.delta, r.value, r.hash) for r in got.collect())

    first = [(1, day(1, 3), "c", "counter", 2**62, None, ""), (2, day(1, 9), "c", "counter", 2**62, None, "h"),
             (3, day(2, 1), "g", "gauge", None, 1.5, ""), (9, None, "c", "counter", 1000, None, "")]
    got = add(first, day(3, 1))
    low = -(2**63)
    assert got == [(2, "c", "counter", low, None, "h"), (3, "c", "counter", low, None, "h"), (3, "g", "gauge", None, 1.5, "")]
    # nothing but the time: every key reports
    got = add([], day(5, 1))
    assert got[3:] == [(d, k, t, x, v, h) for d in (4, 5) for k, t, x, v, h in
                       (("c", "counter", low, None, "h"), ("g", "gauge", None, 1.5, ""))]
    second = [(4, day(5, 2), "c", "counter", 5, None, ""), (5, day(7, 2), "new", "counter", 1, None, "")]
    got = add(second, day(8, 1))
    updates = spark.createDataFrame(first + second, SCHEMA)
    want = tick_snapshot(updates, DAY)
    cols = ("tick", "id", "mtype", "delta", "value")
    assert rows_of(spark.read.parquet(out).filter("tick <= TIMESTAMP_NTZ'2024-01-08 00:00:00'"), *cols) == rows_of(want, *cols)
    assert len(got) == len(set(got))  # each report once


def test_clock_runs(spark):
    q = ts.clock_stream(spark).writeStream.format("memory").queryName("clock_test").start()
    try:
        import time
        for _ in range(60):
            if spark.table("clock_test").count():
                break
            time.sleep(0.5)
        assert spark.table("clock_test").first().ts.year >= 2024
    finally:
        q.stop()


FOLDS = st.tuples(st.integers(-2**63, 2**63 - 1) | st.none(), st.none() | st.integers(0, 9).map(float), st.sampled_from(["", "h"]), st.integers(0, 99))


@settings(max_examples=100, deadline=None)
@given(st.lists(FOLDS, min_size=1, max_size=6), st.sampled_from(["counter", "gauge"]))
def test_folds_add_up_like_rows(folds, kind):
    """Counters wrap; everything else is of the largest order, the later on ties."""
    now = None
    for tick, (delta, value, h, seq) in enumerate(folds):
        now = ts.add_fold(kind, now, (tick, delta, value, h, seq))
    newest = max(range(len(folds)), key=lambda i: (folds[i][3], i))
    assert now[2:4] == folds[newest][1:3] and now[4] == folds[newest][3]
    deltas = [f[0] for f in folds if f[0] is not None]
    if kind == "gauge":
        assert now[1] == folds[newest][0]
    else:
        assert now[1] == (ts.wrap(sum(deltas)) if deltas else None)
