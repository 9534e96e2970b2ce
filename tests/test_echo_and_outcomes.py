"""Stream responses over a restart; counts and refused bodies of an ingest stream."""

import os

from pyspark.sql import functions as F

from conftest import rows_of
from test_keyed_stream import land, update
from tallyho.operators.fold import fold_state
from tallyho.operators.window import batch_echo
from tallyho.schema import UPDATE
from tallyho.session import scratch_path
from tallyho.streaming import echo_stream as es
from tallyho.streaming import keyed_stream as ks
from tallyho.streaming import outcomes as oc

COLS = ("seq", "id", "mtype", "delta", "value", "hash")


def test_echoes_equal_the_whole_log_over_a_restart(spark):
    path, base, ckpt = scratch_path(spark, "src"), scratch_path(spark, "echo"), scratch_path(spark, "ckpt")
    rows = []

    def drain(**kw):
        stream = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        q = es.start_echo_stream(stream, base, ckpt, trigger={"availableNow": True}, range_size=5, compact_every=2)
        q.awaitTermination()
        assert q.exception() is None

    for part in range(5):
        new = [update(part * 20 + i, f"k{i % 3}", "counter", 2**61 + i, "h" * (i % 2)) if i % 4 else update(part * 20 + i, "g", "gauge", float(i))
               for i in range(20)]
        land(spark, path, f"f{part}", new, part)
        rows += new
        if part in (1, 2, 4):
            drain()
    whole = spark.createDataFrame(rows, UPDATE)
    assert rows_of(es.read_echo(spark, base), *COLS) == rows_of(batch_echo(whole), *COLS)
    assert rows_of(ks.read_state(spark, base)) == rows_of(fold_state(whole, hash_pass="inline"))
    # a replayed epoch writes the same: take back the commit of the last one
    echo = rows_of(es.read_echo(spark, base), *COLS)
    last = max(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{n}"):
            os.remove(f"{ckpt}/commits/{n}")
    drain()
    assert rows_of(es.read_echo(spark, base), *COLS) == echo
    assert rows_of(ks.read_state(spark, base)) == rows_of(fold_state(whole, hash_pass="inline"))


def test_counts_and_refused_bodies(spark):
    from tallyho.sources import payloads as pl
    src, out = scratch_path(spark, "bodies"), scratch_path(spark, "refused")
    bodies = ['[{"id":"a","type":"counter","delta":1}]', "[", '[{"type":"gauge","value":1}]', "null", '[{"id":"a","type":"x"}]', "{}"]
    df = spark.createDataFrame(list(enumerate(bodies)), "batch_id long, body string")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    decoded = pl.decode_batches(stream.withColumn("text", F.col("body"))).withColumnRenamed("reject_code", "code")
    q = oc.start_refused_stream(decoded.select("batch_id", "text", "code"), out, scratch_path(spark, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    counts = oc.outcome_counts(q)
    assert {k: v for k, v in counts.items() if v} == {"admitted": 2, "parse_error": 2, "empty_metric_name": 1, "unknown_metric_type": 1}
    assert rows_of(spark.read.parquet(out), "batch_id", "text", "code") == [
        (1, "[", "parse_error"), (2, bodies[2], "empty_metric_name"), (4, bodies[4], "unknown_metric_type"), (5, "{}", "parse_error")]
