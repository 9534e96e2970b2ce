"""Streaming queries: the events table replayed as a stream of files.

Spark first writes ``events`` below the shared folder, in its own partitions
and a directory a day, like the landing zone of an event log; a file stream
then takes a quarter of the files per micro-batch. File arrival order is not
guaranteed, which the fold tolerates (gauges are decided by ``seq``). The
queries return the state, the dumps or the ticks that the stream leaves behind.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import payloads as pl
from ..sources.events import read_table, updates_from_events
from ..streaming import echo_stream as es
from ..streaming import fold_stream as fs
from ..streaming import keyed_stream as ks
from ..streaming import outcomes as oc
from ..streaming import tick_stream as tk
from .queries_core import FOLD_SQL
from .queries_ingest import ADMIT_SQL, KEY, _batch_bodies, envelopes
from .queries_state import SPLIT_TS
from .queries_window import BATCH_ECHO_SQL, DAY, TICK_SQL
from .registry import query

BATCHES = 4
REPORT_SCHEMA = "tick timestamp_ntz, id string, mtype string, delta bigint, value double, hash string"


def _files(df) -> int:
    """How many files a written table has (a directory listing)."""
    return len(df.inputFiles())


def _land(spark, df, name, day=None):
    """Write ``df`` as a landing zone; returns (path, schema, files per micro-batch)."""
    path = scratch_path(spark, name)
    w = df.withColumn("day", F.to_date(day)) if day else df
    (w.write.partitionBy("day") if day else w.write).parquet(path)
    return path, df.schema, max(1, -(-_files(spark.read.schema(df.schema).parquet(path)) // BATCHES))


def _stream(spark, landed):
    path, schema, per_batch = landed
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def _finish(q, trigger):
    if trigger and trigger.get("availableNow"):
        q.awaitTermination()
    else:
        q.processAllAvailable()
        q.stop()
    if q.exception() is not None:
        raise q.exception()


def _run(spark, sf_dir, trigger=None):
    base = scratch_path(spark, "stream-state")
    rows = updates_from_events(_stream(spark, _land(spark, read_table(spark, sf_dir, "events"), "events-stream", "ts")))
    _finish(fs.start_fold_stream(rows, base, scratch_path(spark, "stream-ckpt"), trigger=trigger), trigger)
    return base


def _run_keyed(spark, sf_dir, where=None, base=None):
    e = read_table(spark, sf_dir, "events")
    if where is not None:
        e = e.filter(where)
    base = base or scratch_path(spark, "stream-state")
    rows = updates_from_events(_stream(spark, _land(spark, e, "events-stream", "ts")))
    trigger = {"availableNow": True}
    _finish(ks.start_keyed_stream(rows, base, scratch_path(spark, "stream-ckpt"), trigger=trigger), trigger)
    return base


@query("stream_fold", FOLD_SQL)
def q_stream_fold(spark, sf_dir):
    """Totals in Spark's state store; a micro-batch writes the keys it touched, and the
    state is merged when it is read."""
    return ks.read_state(spark, _run_keyed(spark, sf_dir))


DUMPS_SQL = f"""
SELECT s.*, true AS steady, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) >= {BATCHES} AS several
FROM ({FOLD_SQL}) s
"""


def _dumps(spark, base, least):
    """The last dump, whether every key stays in all later dumps with an order that
    never goes back (``steady``), and whether there were as many dumps as expected."""
    d = fs.read_dumps(spark, base)
    n, last = d.agg(F.countDistinct("dump")).scalar(), d.agg(F.max("dump")).scalar()
    by_key = d.groupBy("id", "mtype").agg(
        F.expr("count(DISTINCT dump) = max(dump) - min(dump) + 1 AS no_gap"),
        F.expr("max(dump) AS until"),
        F.expr("transform(array_sort(collect_list(struct(dump, last_seq))), x -> x.last_seq) AS seqs"))
    steady = F.expr("no_gap AND seqs = array_sort(seqs)") & (F.col("until") == last)
    by_key = by_key.select("id", "mtype", steady.alias("steady"), (n >= least).alias("several"))
    return fs.read_state(spark, base).join(by_key, ["id", "mtype"])


@query("stream_sync_dump", DUMPS_SQL)
def q_stream_sync_dump(spark, sf_dir):
    """Default trigger: a dump after every micro-batch, each holding all before it."""
    return _dumps(spark, _run(spark, sf_dir), BATCHES)


@query("stream_periodic_dump", DUMPS_SQL.replace(
    f"(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) >= {BATCHES}", "true"))
def q_stream_periodic_dump(spark, sf_dir):
    """Processing-time trigger: one dump per interval (1 s here, 300 s by default in a
    deployment) in which something arrived, each holding all before it."""
    return _dumps(spark, _run(spark, sf_dir, trigger={"processingTime": "1 second"}), 1)


@query("stream_restore", FOLD_SQL)
def q_stream_restore(spark, sf_dir):
    """A second stream (new checkpoint) resumes from the first one's state."""
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    base = _run_keyed(spark, sf_dir, where=F.col("ts") < cut)
    _run_keyed(spark, sf_dir, where=F.col("ts") >= cut, base=base)
    return ks.read_state(spark, base)


@query("stream_report_ticks", TICK_SQL)
def q_stream_report_ticks(spark, sf_dir):
    """Reports by time come out while the stream runs: after the first half of the log,
    after the second, and (the last ones) when nothing but time passes. Each part is a
    restart with the same checkpoint."""
    src, clock, out, ckpt = (scratch_path(spark, f"ticks-{n}") for n in ("events", "clock", "reports", "ckpt"))
    e = read_table(spark, sf_dir, "events")
    cut = f"TIMESTAMP_NTZ'{SPLIT_TS}'"
    # the clock stands at the cut, at the newest event, and past the tick of that event
    last = e.selectExpr("max(ts) AS ts").selectExpr("CAST(ts AS TIMESTAMP_NTZ) AS ts")
    parts = [(f"ts < {cut}", spark.range(1).selectExpr(f"{cut} AS ts")), (f"ts >= {cut}", last),
             (None, last.select(F.expr("timestampadd(SECOND, 1, timestampadd(DAY, 1, date_trunc('DAY', ts)))").cast("timestamp_ntz").alias("ts")))]
    for where, now in parts:
        if where is not None:
            e.filter(where).write.mode("append").parquet(src)
        now.write.mode("append").parquet(clock)
        rows = updates_from_events(spark.readStream.schema(e.schema).parquet(src), with_ts=True)
        ticks = spark.readStream.schema("ts timestamp_ntz").parquet(clock)
        trigger = {"availableNow": True}
        _finish(tk.start_tick_stream(rows, out, ckpt, DAY, clock=ticks, trigger=trigger), trigger)
    return spark.read.schema(REPORT_SCHEMA).parquet(out).drop("hash")


def _json_batch_fold_sql():
    from .registry import ORACLES
    return ORACLES["json_batch_fold"]


@query("stream_ingest", _json_batch_fold_sql())
def q_stream_ingest(spark, sf_dir):
    """Raw batch bodies arriving as files: each micro-batch is decoded and
    gated per body (row-local, so it runs inside the stream), and the
    accepted rows are folded into the versioned state."""
    landed = _land(spark, _batch_bodies(spark, sf_dir), "bodies-stream")
    rows = pl.accepted_rows(pl.decode_batches(_stream(spark, landed)))
    base, trigger = scratch_path(spark, "stream-state"), {"availableNow": True}
    _finish(ks.start_keyed_stream(rows, base, scratch_path(spark, "stream-ckpt"), trigger=trigger, order=("batch_id", "pos")), trigger)
    return ks.read_state(spark, base)


@query("stream_batch_echo", BATCH_ECHO_SQL)
def q_stream_batch_echo(spark, sf_dir):
    """The responses of a running stream: the log's first half, a restart, the second. Those of
    the second half go on from the totals of the first."""
    src, base, ckpt = (scratch_path(spark, f"echo-{n}") for n in ("events", "state", "ckpt"))
    e = read_table(spark, sf_dir, "events")
    cut, trigger = f"TIMESTAMP_NTZ'{SPLIT_TS}'", {"availableNow": True}
    for where in (f"ts < {cut}", f"ts >= {cut}"):
        e.filter(where).write.mode("append").parquet(src)
        rows = updates_from_events(spark.readStream.schema(e.schema).parquet(src))
        _finish(es.start_echo_stream(rows, base, ckpt, trigger=trigger, range_size=256), trigger)
    first = updates_from_events(e.filter(f"ts < {cut}")).select("seq")
    return es.read_echo(spark, base).join(first, "seq", "left_anti").select("seq", "id", "mtype", "delta", "value", "hash")


@query("stream_ingest_refused", f"SELECT * FROM ({ADMIT_SQL}) r WHERE reject_code IS NOT NULL")
def q_stream_ingest_refused(spark, sf_dir):
    """Requests arriving as files, admitted, decoded and gated; the refused ones kept with
    their code. The observed counts must be those of the files, or the query fails."""
    e = envelopes(spark, sf_dir)
    out, trigger = scratch_path(spark, "refused"), {"availableNow": True}
    a = pl.admit(_stream(spark, _land(spark, e, "envelopes-stream")).withColumn("request", F.col("body")), KEY)
    d = pl.decode_batches(a.selectExpr("batch_id", "request", "admit_code", "admit_status", "json AS body"))
    d = d.selectExpr("batch_id", "request", "coalesce(admit_code, reject_code) AS code", "coalesce(admit_status, status) AS status")
    q = oc.start_refused_stream(d, out, scratch_path(spark, "stream-ckpt"), trigger=trigger)
    _finish(q, trigger)
    kept = spark.read.schema("batch_id bigint, request binary, status int, code string").parquet(out)
    counts = oc.outcome_counts(q)
    found = {r["code"]: r["count"] for r in kept.groupBy("code").count().collect()}
    if {c: n for c, n in counts.items() if n and c != oc.ADMITTED} != found or sum(counts.values()) != e.count():
        raise RuntimeError(f"observed {counts}, kept {found}")
    return kept.selectExpr("batch_id", "code AS reject_code", "status")
