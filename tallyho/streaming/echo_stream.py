"""The responses of a stream of batches: running totals over everything before.

The echo of an update is its counter's total after it, over all earlier
micro-batches and the earlier rows of its own. A micro-batch reads the totals of
the state before it, echoes by ``operators.window.batch_echo`` (ranges of the
order within a key, so a hot key is many tasks), and leaves the totals of the
keys it touched beside the state, in the layout of ``keyed_stream``. Echo and
totals of an epoch are directories of that epoch's name: a replay starts from the
same state and writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.fold import KEY, fold_state, merge_state
from ..operators.window import DEFAULT_RANGE, batch_echo
from ..schema import STATE_COLUMNS
from . import keyed_stream as ks

ECHO = "echo"


def start_echo_stream(updates: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                      compact_every: int = 20, range_size: int = DEFAULT_RANGE):
    """Start (or resume) the echo of a stream of validated updates into ``base``. Returns the
    ``StreamingQuery``; ``read_echo`` gives the responses, ``keyed_stream.read_state`` the state."""
    from .fold_stream import run_id_for

    run = run_id_for(updates.sparkSession, checkpoint)
    number = ks.claim(updates.sparkSession, base, run)["number"]

    def respond(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            before = ks.read_full(spark, base, before=epoch)
            echo = batch_echo(batch, prior=before.select(*STATE_COLUMNS), range_size=range_size)
            echo.write.mode("overwrite").parquet(f"{base}/{ECHO}/{run}/{epoch:020d}")
            touched = fold_state(batch, keep_seq=True, hash_pass="inline")
            own = ks.run_totals(spark, base, run, before=epoch)
            if own is not None:
                touched = merge_state(own.join(touched.select(*KEY), list(KEY), "left_semi"), touched)
            ks.keep_epoch(touched, base, run, number, epoch, compact_every)
        finally:
            batch.unpersist()

    w = updates.writeStream.foreachBatch(respond).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def read_echo(spark: SparkSession, base: str, run: str | None = None) -> DataFrame:
    """Responses of a run (default: the one that owns the location), one row an update."""
    run = run or ks.live_run(spark, base)["run"]
    where = f"{base}/{ECHO}/{run}"
    done = [n for n in ks._names(spark, where) if n.isdigit() and ks._done(spark, f"{where}/{n}")]
    return spark.read.parquet(*(f"{where}/{n}" for n in done))
