"""The fold on Spark's state store: restarts, order, what a batch writes."""

import os

import pytest

from conftest import rows_of
from tallyho.operators.fold import fold_state
from tallyho.schema import UPDATE
from tallyho.session import scratch_path
from tallyho.sinks import snapshot as sk
from tallyho.streaming import keyed_stream as ks


def update(seq, id_, kind, number, hash_=""):
    return (seq, None, None, id_, kind, number if kind == "counter" else None, number if kind == "gauge" else None, hash_)


def land(spark, path, name, rows, age):
    """One file of updates; the file source takes older files first."""
    tmp = f"{path}/.{name}"
    spark.createDataFrame(rows, UPDATE).coalesce(1).write.parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.startswith("part-"))
    os.makedirs(f"{path}/in", exist_ok=True)
    os.rename(f"{tmp}/{part}", f"{path}/in/{name}.parquet")
    os.utime(f"{path}/in/{name}.parquet", (1_700_000_000 + age, 1_700_000_000 + age))


def drain(spark, path, base, ckpt, **kw):
    stream = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    q = ks.start_keyed_stream(stream, base, ckpt, trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    assert q.exception() is None


def expected(spark, rows):
    return rows_of(fold_state(spark.createDataFrame(rows, UPDATE), hash_pass="inline"))


def test_two_restarts_and_files_out_of_order(spark):
    path, base, ckpt = scratch_path(spark, "src"), scratch_path(spark, "state"), scratch_path(spark, "ckpt")
    files = [[update(20, "g", "gauge", 2.0, "h20"), update(21, "c", "counter", 2**62)],
             [update(3, "g", "gauge", 1.0, "h3"), update(4, "c", "counter", 2**62), update(5, "d", "counter", 1)],
             [update(30, "d", "counter", 5, "h30")],
             [update(1, "c", "counter", 7), update(2, "new", "gauge", 0.5)]]
    done = []
    for i, rows in enumerate(files):  # each drain is a restart with the same checkpoint
        land(spark, path, f"f{i}", rows, i)
        if i == 0:
            land(spark, path, "f9", [update(40, "only", "counter", 1)], 9)
            done += [update(40, "only", "counter", 1)]
        drain(spark, path, base, ckpt, compact_every=2)
        done += rows
        assert rows_of(ks.read_state(spark, base)) == expected(spark, done)


def test_a_batch_writes_the_keys_it_touched(spark):
    path, base, ckpt = scratch_path(spark, "src"), scratch_path(spark, "state"), scratch_path(spark, "ckpt")
    land(spark, path, "a", [update(i, f"k{i % 500}", "counter", 1) for i in range(2000)], 1)
    land(spark, path, "b", [update(5000, "k7", "counter", 1), update(5001, "k8", "counter", 1)], 2)
    land(spark, path, "c", [update(6000, "k9", "counter", 1)], 3)
    drain(spark, path, base, ckpt)
    run = ks.live_run(spark, base)["run"]
    dirs, _ = ks._change_dirs(spark, base, run)
    assert [spark.read.parquet(d).count() for d in dirs] == [500, 2, 1]
    # Spark's own state: the later batches upload a changelog of the keys, not a new state
    size = lambda v: sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(f"{ckpt}/state") for f in fs
                         if f.split(".")[0].split("_")[0] == str(v) and f.endswith("changelog"))
    assert 0 < size(2) < size(1) / 5 and 0 < size(3) < size(1) / 5
    ks._compact(spark, base, run, 2)
    dirs, old = ks._change_dirs(spark, base, run)
    assert [spark.read.parquet(d).count() for d in dirs] == [500] and len(old) == 3
    assert dict(rows_of(ks.read_state(spark, base), "id", "delta"))["k7"] == 5


def test_a_new_checkpoint_goes_on_from_what_the_last_run_left(spark):
    from tallyho.schema import METRIC
    path, base = scratch_path(spark, "src"), scratch_path(spark, "state")
    sk.write_snapshot_table(spark.createDataFrame([("c", "counter", 50, None, ""), ("g", "gauge", None, 9.0, "s")], METRIC), base)
    one, two = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")
    land(spark, path, "a", [update(1, "c", "counter", 5), update(2, "x", "gauge", 1.0)], 1)
    drain(spark, path, base, one)
    assert rows_of(ks.read_state(spark, base)) == [("c", "counter", 55, None, ""), ("g", "gauge", None, 9.0, "s"), ("x", "gauge", None, 1.0, "")]
    other = scratch_path(spark, "src")
    land(spark, other, "b", [update(3, "c", "counter", 100), update(0, "x", "gauge", 7.0), update(4, "g", "gauge", 2.0)], 1)
    drain(spark, other, base, two)
    want = [("c", "counter", 155, None, ""), ("g", "gauge", None, 2.0, ""), ("x", "gauge", None, 1.0, "")]
    assert rows_of(ks.read_state(spark, base)) == want
    with pytest.raises(ks.RunEnded):  # its totals are in the second run's start already
        drain(spark, path, base, one)
    assert rows_of(ks.read_state(spark, base)) == want
    target = scratch_path(spark, "dump")
    ks.dump_state(spark, base, target)
    from tallyho.sources.snapshot import read_snapshot_table
    assert rows_of(read_snapshot_table(spark, target)) == want


def test_another_writer_stops_the_next_run(spark):
    from tallyho.schema import METRIC
    path, base = scratch_path(spark, "src"), scratch_path(spark, "state")
    land(spark, path, "a", [update(1, "c", "counter", 5)], 1)
    drain(spark, path, base, scratch_path(spark, "ckpt"))
    sk.write_snapshot_table(spark.createDataFrame([("c", "counter", 1, None, "")], METRIC), base)
    with pytest.raises(sk.CommitConflict):
        drain(spark, path, base, scratch_path(spark, "ckpt"))


def test_nothing_yet_and_settings_restored(spark):
    base = scratch_path(spark, "state")
    assert ks.read_state(spark, base).collect() == []
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with ks.with_conf(spark, ks.STATE_STORE | {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get(key) == ks.STATE_STORE[key]
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.shuffle.partitions") == "4"
