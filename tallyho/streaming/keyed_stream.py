"""Continuous ingest on Spark's state store: a batch writes what it touched.

The fold is a streaming aggregation in update mode: the totals of every key
since the stream's first start live in Spark's state store (RocksDB with
changelog checkpoints: a micro-batch uploads the keys it changed), partial
sums are made before the shuffle, and Spark's checkpoint makes it exactly-once.
Each micro-batch then leaves the rows of the keys it touched as one change
directory. The state is merged when it is read:

    state = the snapshot that the run started from  ⊕  the newest row of each key

Layout of a location, beside the versioned snapshots of ``sinks.snapshot``::

    <base>/_runs/<number>                 the run: its id and the version it started from
    <base>/changes/<run>/<epoch>          rows touched by a micro-batch
    <base>/changes/<run>/<epoch>.all      newest rows of all epochs up to this one

A replayed epoch writes the same totals to the same directory. Every
``compact_every`` epochs the change rows are reduced to one row a key, so a
reader opens at most that many directories and one more; older ones go.

A run resumes with its checkpoint. A new checkpoint is a new run: what the last
one left becomes the snapshot that it starts from, and the last one may not go
on (its totals are in that snapshot already): ``RunEnded``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import wrap_sum_aggs
from ..operators.fold import DELTA_SQL, KEY, merge_state
from ..schema import STATE_COLUMNS
from ..sinks import snapshot as sk
from ..sources.snapshot import empty_state

RUNS, CHANGES = "_runs", "changes"
#: Settings of the state store, given to the query when it starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class RunEnded(RuntimeError):
    """A newer run has taken over the location."""


class with_conf:
    """Session settings for the time of a block."""

    def __init__(self, spark: SparkSession, settings: dict[str, str]):
        self.conf, self.settings = spark.conf, settings

    def __enter__(self):
        self.before = {k: self.conf.get(k, None) for k in self.settings}
        for k, v in self.settings.items():
            self.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            if v is None:
                self.conf.unset(k)
            else:
                self.conf.set(k, v)


def key_totals(updates: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Streaming fold per key (update mode): ``id, mtype, delta, value, hash, last_seq``, counters as
    wrapping sums, the rest of the row of the largest ``order``."""
    last = order[0] if len(order) == 1 else f"struct({', '.join(order)})"
    h = "coalesce(hash, '')" if "hash" in updates.columns else "''"
    u = updates.selectExpr(f"{last} AS _at", *KEY, "delta", "value", f"{h} AS hash")
    agg = u.groupBy(*KEY).agg(*wrap_sum_aggs("delta", "d"), F.expr("max(_at) AS last_seq"),
                              F.expr("max_by(struct(delta AS last_delta, value, hash), _at) AS _row"))
    return agg.selectExpr("* EXCEPT (_row)", "_row.*").selectExpr(*KEY, f"{DELTA_SQL} AS delta", "value", "hash", "last_seq")


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = sk._fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _done(spark: SparkSession, path: str) -> bool:
    fs, p, _ = sk._fs(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def live_run(spark: SparkSession, base: str) -> dict | None:
    """The run that the location belongs to: ``number``, ``run``, ``start`` (a version or None)."""
    kept = [n for n in _names(spark, f"{base}/{RUNS}") if n.isdigit()]
    return json.loads(sk.read_text(spark, f"{base}/{RUNS}/{kept[-1]}")) | {"number": int(kept[-1])} if kept else None


def _change_dirs(spark: SparkSession, base: str, run: str, before: int | None = None) -> tuple[list[str], list[str]]:
    """(directories that hold the newest rows, older ones), by epoch; of epochs ``before`` one."""
    where = f"{base}/{CHANGES}/{run}"
    names = [n for n in _names(spark, where) if n.split(".")[0].isdigit() and (before is None or int(n.split(".")[0]) < before)
             and _done(spark, f"{where}/{n}")]
    whole = max((n for n in names if n.endswith(".all")), default="")
    new = [n for n in names if not n.endswith(".all") and n > whole.split(".")[0]]
    keep = ([whole] if whole else []) + new
    return [f"{where}/{n}" for n in keep], [f"{where}/{n}" for n in names if n not in keep]


def run_totals(spark: SparkSession, base: str, run: str, before: int | None = None) -> DataFrame | None:
    """The newest row of every key that the run has touched (with ``last_seq``), or None."""
    dirs, _ = _change_dirs(spark, base, run, before)
    if not dirs:
        return None
    rows = spark.read.parquet(*dirs)
    rest = [c for c in rows.columns if c not in (*KEY, "epoch")]
    if len(dirs) == 1:
        return rows.select(*KEY, *rest)
    return (rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "epoch").alias("_row")).select(*KEY, "_row.*"))


def _compact(spark: SparkSession, base: str, run: str, epoch: int) -> None:
    dirs, old = _change_dirs(spark, base, run)
    if len(dirs) > 1:
        run_totals(spark, base, run).withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(
            f"{base}/{CHANGES}/{run}/{epoch:020d}.all")
    for d in old:  # what the last compaction replaced: readers of it have had one interval
        fs, p, _ = sk._fs(spark, d)
        fs.delete(p, True)


def read_full(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """Current state (or that ``before`` an epoch of the run) with ``last_seq``: the run's start
    merged with its newest rows."""
    live = live_run(spark, base)
    at = sk.read_commit(spark, base, live["start"]) if live and live["start"] else None if live else sk.read_commit(spark, base)
    totals = run_totals(spark, base, live["run"], before) if live else None
    if at is None:
        return totals if totals is not None else empty_state(spark).withColumn("last_seq", F.lit(None).cast("bigint"))
    start = spark.read.parquet(at.path)
    if totals is None:
        return start if "last_seq" in start.columns else start.withColumn("last_seq", F.lit(None).cast("bigint"))
    if "last_seq" not in start.columns:  # a plain snapshot: older than anything new
        start = start.withColumn("last_seq", F.lit(None).cast(totals.schema["last_seq"].dataType))
    return merge_state(start, totals)


def read_state(spark: SparkSession, base: str) -> DataFrame:
    return read_full(spark, base).select(*STATE_COLUMNS)


def dump_state(spark: SparkSession, base: str, target: str, keep: int | None = None, epochs: dict | None = None) -> sk.Commit:
    """Write the current state whole, as a new version of another location."""
    start, path = sk.start_version(spark, target)
    sk.write_table_version(read_full(spark, base), path)
    return sk.commit(spark, target, start, path, epochs, keep)


def claim(spark: SparkSession, base: str, run: str) -> dict:
    """The run's record: a new run first turns what the last one left into a version."""
    live, at = live_run(spark, base), sk.read_commit(spark, base)
    if live:
        settled = at is not None and f"settled {live['run']}" in at.epochs
        if live["run"] == run and not settled:
            return live
        if live["run"] == run or sk.read_text(spark, f"{base}/{CHANGES}/{run}.run"):
            raise RunEnded(f"run {run} of {base} has ended")
        if not settled:
            if (at.number if at else None) != live["start"]:
                raise sk.CommitConflict(f"{base} was written by another writer while run {live['run']} owned it")
            if run_totals(spark, base, live["run"]) is not None:
                at = dump_state(spark, base, base, epochs={f"settled {live['run']}": 0})
    record = {"run": run, "start": at.number if at else None}
    number = live["number"] + 1 if live else 1
    for d in (f"{base}/{RUNS}", f"{base}/{CHANGES}"):
        fs, p, _ = sk._fs(spark, d)
        fs.mkdirs(p)
    if not sk.write_text(spark, f"{base}/{RUNS}/{number:020d}", json.dumps(record)):
        raise RunEnded(f"another run has just started on {base}")
    sk.write_text(spark, f"{base}/{CHANGES}/{run}.run", run)
    return record | {"number": number}


def keep_epoch(totals: DataFrame, base: str, run: str, number: int, epoch: int, compact_every: int) -> None:
    """Leave the rows that an epoch touched (totals of the run), if the run still owns the location."""
    spark = totals.sparkSession
    if live_run(spark, base)["number"] != number:
        raise RunEnded(f"run {run} of {base} was followed by another")
    totals.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{base}/{CHANGES}/{run}/{epoch:020d}")
    if (epoch + 1) % compact_every == 0:
        _compact(spark, base, run, epoch)


def start_keyed_stream(updates: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                       order: tuple[str, ...] = ("seq",), compact_every: int = 20, run_id: str | None = None):
    """Start (or resume) the fold of a stream of validated updates into ``base``.
    Returns the ``StreamingQuery``; ``read_state`` gives the state at any time."""
    from .fold_stream import run_id_for

    spark = updates.sparkSession
    run = run_id or run_id_for(spark, checkpoint)
    number = claim(spark, base, run)["number"]

    def keep_changes(batch: DataFrame, epoch: int) -> None:
        keep_epoch(batch, base, run, number, epoch, compact_every)

    w = (key_totals(updates, order).writeStream.outputMode("update").foreachBatch(keep_changes)
         .option("checkpointLocation", checkpoint))
    with with_conf(spark, STATE_STORE):
        return (w.trigger(**trigger) if trigger else w).start()
