"""Running echo totals, tick snapshots, sample reshaping, delivery roll-up."""

import datetime as dt
import random

from conftest import rows_of
from tallyho.operators import delivery as dv
from tallyho.operators import reshape as rs
from tallyho.operators import window as wi
from tallyho.schema import METRIC


def test_echo_running_totals(spark, updates):
    u = updates([dict(seq=1, id="hits", mtype="counter", delta=3), dict(seq=2, id="hits", mtype="counter", delta=7),
                 dict(seq=3, id="t", mtype="gauge", value=1.5)])
    assert rows_of(wi.batch_echo(u), "seq", "delta", "value") == [(1, 3, None), (2, 10, None), (3, None, 1.5)]
    prior = spark.createDataFrame([("hits", "counter", 100, None, "")], METRIC)
    assert rows_of(wi.batch_echo(u, prior), "seq", "delta")[:2] == [(1, 103), (2, 110)]


def test_echo_hot_key_across_ranges(updates):
    rnd = random.Random(3)
    rows = [dict(seq=s, id="hot" if rnd.random() < 0.8 else "cold", mtype="counter", delta=rnd.randint(-5, 9))
            for s in range(2000)]
    want, tot = {}, {}
    for r in rows:
        tot[r["id"]] = tot.get(r["id"], 0) + r["delta"]
        want[r["seq"]] = tot[r["id"]]
    got = {r.seq: r.delta for r in wi.batch_echo(updates(rows), range_size=37).collect()}
    assert got == want


def test_tick_snapshot_repeats_every_key_seen(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, day.replace(hour=1), "c", "counter", 2, None), (2, day.replace(day=3), "c", "counter", 5, None),
         (3, day.replace(day=2, hour=5), "g", "gauge", None, 1.5)],
        "seq long, ts timestamp_ntz, id string, mtype string, delta long, value double")
    got = rows_of(wi.tick_snapshot(df, 86400), "tick", "id", "delta", "value")
    d = lambda n: dt.datetime(2024, 1, n)
    assert got == sorted([(d(2), "c", 2, None), (d(3), "c", 2, None), (d(4), "c", 7, None),
                          (d(3), "g", None, 1.5), (d(4), "g", None, 1.5)], key=repr)


def test_sample_rows_shape(spark):
    gauges = {n: float(i) for i, n in enumerate(rs.RUNTIME_GAUGES)}
    df = spark.createDataFrame([(1, gauges, {rs.POLL_COUNT: 3})],
                               "seq long, gauge map<string,double>, counter map<string,bigint>")
    rows = rs.sample_to_rows(df).collect()
    assert len(rows) == 29
    assert all((r.mtype == "gauge") == (r.value is not None and r.delta is None) for r in rows)
    assert [(r.id, r.delta) for r in rows if r.mtype == "counter"] == [(rs.POLL_COUNT, 3)]
    cpu = spark.createDataFrame([(1, [10.0, 20.0])], "seq long, pct array<double>")
    assert rows_of(rs.indexed_gauges(cpu, "pct"), "id", "value") == [("CPUutilization1", 10.0),
                                                                   ("CPUutilization2", 20.0)]


def test_poll_count(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "seq long, source string")
    assert rows_of(rs.poll_counts(df)) == [("a", 3), ("b", 1)]


def test_delivery_messages(spark):
    rows = [(1, 1, "http", 200, None),
            (2, 1, "network", None, "refused"), (2, 2, "http", 200, None),
            (3, 1, "http", 400, None), (3, 2, "http", 200, None),
            (4, 1, "http", 500, None), (4, 2, "http", 503, None), (4, 3, "network", None, "x"),
            (4, 4, "http", 500, None), (4, 5, "http", 200, None),
            (5, 5, "http", 502, None),
            (6, 1, "network", None, "x"), (6, 2, "cancelled", None, "context canceled"), (6, 3, "http", 200, None),
            (7, 1, "network", None, "x"), (7, 2, "cancelled", None, None)]
    df = spark.createDataFrame(rows, "report_id long, attempt_no int, kind string, http_status int, error string")
    got = {r.report_id: (r.succeeded, r.sends, r.message) for r in dv.delivery_rollup(df).collect()}
    assert got[1] == (True, 1, None)
    assert got[2] == (True, 2, "retry succeeded after 1 attempts: attempt 1: network error: refused")
    assert got[3] == (False, 1, "retry failed after 1 attempts: attempt 1: unexpected response status code 400")
    assert got[4][0:2] == (True, 5)
    assert got[4][2].startswith("retry succeeded after 4 attempts: attempt 1: retriable http status: "
                                "unexpected response status code 500; attempt 2:")
    # attempts are taken as logged, whatever their numbers, and a cancelled one keeps its place
    assert got[5] == (False, 1, "retry failed after 1 attempts: attempt 1: retriable http status: unexpected response status code 502")
    assert got[6] == (False, 2, "retry failed after 2 attempts: attempt 1: network error: x; attempt 2: context canceled")
    assert got[7][2].endswith("attempt 2: cancelled")
    over = {r.report_id: r.over_limit for r in dv.delivery_rollup(df, max_sends=4).collect()}
    assert over[4] and not any(v for k, v in over.items() if k != 4)


def test_echo_keeps_the_hash_and_orders_by_batch_and_position(spark):
    rows = [(2, 0, "c", "counter", 1, None, "b"), (1, 1500, "c", "counter", 10, None, ""), (1, 2, "g", "gauge", None, 1.5, "h")]
    df = spark.createDataFrame(rows, "batch_id long, pos long, id string, mtype string, delta long, value double, hash string")
    got = rows_of(wi.batch_echo(df, range_size=1, order=("batch_id", "pos")), "batch_id", "delta", "value", "hash")
    assert got == [(1, 10, None, ""), (1, None, 1.5, "h"), (2, 11, None, "b")]


def test_a_sample_in_one_pass(spark):
    df = spark.createDataFrame([(1, {"A": 1.0}, {"P": 2}, [0.5, 0.25]), (2, None, None, None)],
                               "seq long, gauge map<string,double>, counter map<string,bigint>, pct array<double>")
    out = rs.sample_to_rows(df, indexed="pct", prefix="cpu")
    assert rows_of(out, "seq", "id", "mtype", "delta", "value") == sorted(
        [(1, "A", "gauge", None, 1.0), (1, "P", "counter", 2, None), (1, "cpu1", "gauge", None, 0.5), (1, "cpu2", "gauge", None, 0.25)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") <= 2 and plan.count("Scan") == 1
