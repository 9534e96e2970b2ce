"""Continuous ingest: a streaming fold into versioned state snapshots.

Each micro-batch is folded (``fold_state``) and merged into the current
version (``merge_state``, keyed by ``last_seq`` so the newer gauge wins even
when files arrive out of order), then committed as the next version. Why
``foreachBatch`` and not a stateful streaming aggregation: the state must
start from a saved snapshot (restore), and batches are validated as wholes
before they are applied.

Exactly-once: a commit holds the last epoch of every stream (by the run id
kept beside its checkpoint), in the same file that makes the version current.
A replayed epoch that is already in it is skipped. If another writer commits
in between, the batch fails with ``CommitConflict`` and, when the stream is
started again, is applied to that writer's version.

The trigger chooses the dump policy: the default trigger persists after every
micro-batch (sync dump); ``processingTime='300 seconds'`` persists every
interval (periodic dump); ``availableNow`` drains what is there (tests).
A dump writes the whole state: its cost is that of the keys, once a trigger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fold import KEY, fold_state, merge_state
from ..sinks.snapshot import (Commit, commit, numbers, read_commit, read_text, start_version,
                              write_table_version, write_text)
from ..sources.snapshot import read_snapshot_table


def _state_with_seq(spark: SparkSession, at: Commit, like: DataFrame) -> DataFrame:
    df = spark.read.parquet(at.path)
    if "last_seq" not in df.columns:  # a plain snapshot: older than anything new
        df = df.withColumn("last_seq", F.lit(None).cast(like.schema["last_seq"].dataType))
    return df


def make_batch_writer(base: str, run_id: str, hash_pass: str = "separate", keep: int | None = None,
                      order: tuple[str, ...] = ("seq",), interval_s: int | None = None):
    """The ``foreachBatch`` function for a state location. ``hash_pass`` and ``order``
    are passed to ``fold_state``; with ``interval_s`` the folds are per tick of
    that many seconds (``operators.window.tick_folds``)."""
    keys = KEY if interval_s is None else (*KEY, "tick")

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        from ..operators.window import tick_number
        spark = batch.sparkSession
        at, path = start_version(spark, base)
        if at is not None and at.epochs.get(run_id, -1) >= epoch_id:
            return  # already committed: a replay after the commit
        if interval_s is not None:
            batch = batch.filter("ts IS NOT NULL").withColumn("tick", tick_number("ts", interval_s))
        state = fold_state(batch, keep_seq=True, hash_pass=hash_pass, order=order, keys=keys)
        if at is not None:
            state = merge_state(_state_with_seq(spark, at, state), state, keys)
        write_table_version(state, path)
        commit(spark, base, at, path, {run_id: epoch_id}, keep)

    return apply_batch


def run_id_for(spark: SparkSession, checkpoint: str) -> str:
    """The run id of a checkpoint: made on its first start, stored next to
    it, and read back on every restart (so replayed epochs are known)."""
    path = checkpoint.rstrip("/") + ".run"
    if read_text(spark, path) is None:
        write_text(spark, path, uuid.uuid4().hex)
    return read_text(spark, path)


def start_fold_stream(updates: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                      run_id: str | None = None, hash_pass: str = "separate", keep: int | None = None,
                      order: tuple[str, ...] = ("seq",), interval_s: int | None = None):
    """Start the streaming fold of an update stream into ``base``.

    ``updates`` is a streaming DataFrame of validated update rows; ``keep``
    versions stay (default all). Returns the ``StreamingQuery``.
    """
    run_id = run_id or run_id_for(updates.sparkSession, checkpoint)
    w = (updates.writeStream.foreachBatch(make_batch_writer(base, run_id, hash_pass, keep, order, interval_s))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_state(spark: SparkSession, base: str) -> DataFrame:
    """Current state of a stream's location (without ``last_seq``)."""
    return read_snapshot_table(spark, base).select("id", "mtype", "delta", "value", "hash")


def read_dumps(spark: SparkSession, base: str) -> DataFrame:
    """All kept versions of a location, each as the dump it was: state rows and ``dump``
    (its number). One read of the versions' directories; the number comes from the path."""
    paths = [read_commit(spark, base, n).path for n in numbers(spark, base)]
    if not paths:
        return read_snapshot_table(spark, base).withColumn("dump", F.lit(0).cast("bigint")).limit(0)
    number = F.regexp_extract(F.col("_metadata.file_path"), "/v(?:=|%3D)(\\d+)-", 1).cast("bigint")
    # versions without ``last_seq`` (plain snapshots) may stand beside others
    return spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*paths).withColumn("dump", number).drop("v")


def read_ticks(spark: SparkSession, base: str, interval_s: int) -> DataFrame:
    """State as of every tick, from a location that a stream folds per tick."""
    from ..operators.window import fill_ticks
    return fill_ticks(spark.read.parquet(read_commit(spark, base).path), interval_s)
