"""Streaming fold: replay safety, out-of-order batches, restart from a snapshot."""

from conftest import rows_of
from tallyho.schema import UPDATE
from tallyho.session import scratch_path
from tallyho.streaming import fold_stream as fs


def test_replayed_epoch_is_applied_once(spark, updates):
    base = scratch_path(spark, "stream")
    write = fs.make_batch_writer(base, "run1")
    b0 = updates([dict(seq=10, id="c", mtype="counter", delta=5), dict(seq=11, id="g", mtype="gauge", value=1.0)])
    write(b0, 0)
    write(b0, 0)  # the same epoch again after it was published
    # an older gauge arriving later must not win; counters still add
    b1 = updates([dict(seq=3, id="g", mtype="gauge", value=0.5), dict(seq=4, id="c", mtype="counter", delta=2)])
    write(b1, 1)
    assert rows_of(fs.read_state(spark, base)) == [("c", "counter", 7, None, ""), ("g", "gauge", None, 1.0, "")]


def test_file_stream_and_restart(spark):
    src_dir = scratch_path(spark, "stream-src")
    rows = [(i, i // 10, i % 10, f"k{i % 3}", "counter", 1, None, "") for i in range(30)]
    df = spark.createDataFrame(rows, UPDATE)
    df.filter("seq < 20").repartition(2).write.parquet(src_dir + "/a")
    base = scratch_path(spark, "stream-state")
    stream = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(src_dir + "/a")
    q = fs.start_fold_stream(stream, base, scratch_path(spark, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    assert sum(r.delta for r in fs.read_state(spark, base).collect()) == 20
    # a new stream with a new checkpoint resumes from the saved state
    df.filter("seq >= 20").write.parquet(src_dir + "/b")
    stream2 = spark.readStream.schema(UPDATE).parquet(src_dir + "/b")
    q2 = fs.start_fold_stream(stream2, base, scratch_path(spark, "ckpt"), trigger={"availableNow": True})
    q2.awaitTermination()
    assert rows_of(fs.read_state(spark, base), "id", "delta") == [("k0", 10), ("k1", 10), ("k2", 10)]


def test_restart_keeps_run_id(spark):
    ckpt = scratch_path(spark, "ckpt")
    assert fs.run_id_for(spark, ckpt) == fs.run_id_for(spark, ckpt)
    assert fs.run_id_for(spark, scratch_path(spark, "ckpt")) != fs.run_id_for(spark, ckpt)


def test_a_dump_between_two_batches_is_kept(spark, updates):
    """The stream goes on from whatever was committed last, also by others."""
    from tallyho.schema import METRIC
    from tallyho.sinks import snapshot as sk
    base = scratch_path(spark, "stream")
    write = fs.make_batch_writer(base, "run1")
    write(updates([dict(seq=1, id="c", mtype="counter", delta=5)]), 0)
    sk.write_snapshot_table(spark.createDataFrame([("c", "counter", 50, None, "")], METRIC), base)
    write(updates([dict(seq=2, id="c", mtype="counter", delta=100)]), 1)
    assert rows_of(fs.read_state(spark, base)) == [("c", "counter", 150, None, "")]


def test_two_runs_on_one_base(spark, updates):
    """Two streams take turns, the older one last; replays of either are skipped."""
    base = scratch_path(spark, "stream")
    one, two = fs.make_batch_writer(base, "zzz-older"), fs.make_batch_writer(base, "aaa-newer")
    batch = lambda seq, delta: updates([dict(seq=seq, id="c", mtype="counter", delta=delta)])
    one(batch(1, 10), 0)
    two(batch(2, 2), 0)
    one(batch(3, 100), 1)
    one(batch(3, 100), 1)
    two(batch(2, 2), 0)
    assert rows_of(fs.read_state(spark, base), "delta") == [(112,)]
    assert [sum(r.delta for r in fs.read_dumps(spark, base).filter(f"dump = {n}").collect()) for n in (1, 2, 3)] == [10, 12, 112]


def test_ticks_by_time_also_when_nothing_arrives(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, 1, 1, 3), "c", "counter", 5, None, ""), (2, dt.datetime(2024, 1, 4, 3), "c", "counter", 2, None, ""),
            (3, None, "c", "counter", 1000, None, "")]
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, id string, mtype string, delta long, value double, hash string")
    base = scratch_path(spark, "ticks")
    write = fs.make_batch_writer(base, "r", interval_s=86400)
    write(df.filter("seq != 2"), 0)
    write(df.filter("seq = 2"), 1)
    got = [(r.tick.day, r.delta) for r in fs.read_ticks(spark, base, 86400).orderBy("tick").collect()]
    assert got == [(2, 5), (3, 5), (4, 5), (5, 7)]
