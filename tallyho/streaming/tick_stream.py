"""Reports of the state by time, from a running stream.

A tick is a multiple of the interval; its report is the state of every key seen
so far, as of that time. Two stateful steps: Spark's windowed aggregation folds
the updates of a key between two ticks (partial sums before the shuffle, state
per key and open tick, dropped when the watermark passes), and a stateful
processor keeps one row a key, adds each closed tick's fold to it, and sets a
timer for the key's next tick. When the watermark passes that, the timer fires
and the report comes out, whether or not the key had updates.

The watermark follows the largest time seen, less ``delay``. For reports when
nothing arrives at all, a clock (any stream with a ``ts``, such as
``clock_stream``) moves it on. Updates that come later than the delay are not
folded into ticks already reported, nor into later ones.

Output: ``tick, id, mtype, delta, value, hash``, in append mode, each report once.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Iterator

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.numbers import wrap_sum_aggs
from ..operators.fold import DELTA_SQL, KEY
from ..operators.window import EPOCH_NTZ, tick_time
from ..schema import COUNTER

# The processor travels to the Python workers by value.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

STATE = "tick bigint, delta bigint, value double, hash string, last_seq bigint"
REPORT = "tick_no bigint, id string, mtype string, delta bigint, value double, hash string"


def wrap(n: int) -> int:
    """An integer as int64 addition leaves it."""
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def add_fold(kind: str, now: tuple | None, fold: tuple) -> tuple:
    """State (tick, delta, value, hash, last_seq) after a later tick's fold of the same shape."""
    if now is None:
        return fold
    delta, seq = fold[1], fold[4]
    row = fold if now[4] is None or seq is None or seq >= now[4] else now
    if kind == COUNTER:
        delta = None if now[1] is None and delta is None else wrap((now[1] or 0) + (delta or 0))
    else:
        delta = row[1]
    return fold[0], delta, row[2], row[3], row[4]


class TickReports(StatefulProcessor):
    """One row of state and one timer a key."""

    def __init__(self, interval_s: int):
        self.step = interval_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def _timer(self, tick: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        self.handle.registerTimer(tick * self.step)

    def _reports(self, key, first: int, last: int, now: tuple) -> Iterator[Row]:
        for tick in range(first, last + 1):
            yield Row(tick_no=tick, id=key[0], mtype=key[1], delta=now[1], value=now[2], hash=now[3])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.state.get()
        now = tuple(now) if now is not None else None
        for fold in sorted((r.tick_no, r.delta, r.value, r.hash, r.last_seq) for r in rows):
            if now is not None:
                yield from self._reports(key, now[0] + 1, fold[0] - 1, now)
            now = add_fold(key[1], now, fold)
            yield from self._reports(key, now[0], now[0], now)
        self.state.update(now)
        self._timer(now[0] + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = tuple(self.state.get())
        due = timerValues.getCurrentWatermarkInMs() // self.step
        if due > now[0]:
            yield from self._reports(key, now[0] + 1, due, now)
            now = (due, *now[1:])
            self.state.update(now)
        self._timer(now[0] + 1)

    def close(self) -> None:
        pass


def clock_stream(spark: SparkSession) -> DataFrame:
    """The time of day, once a second, as a clock for ``report_ticks``."""
    return (spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
            .selectExpr(f"timestampadd(MICROSECOND, unix_micros(timestamp), {EPOCH_NTZ}) AS ts"))


def report_ticks(updates: DataFrame, interval_s: int, delay: str = "0 seconds", clock: DataFrame | None = None) -> DataFrame:
    """The stream of reports of a stream of updates (with ``ts``; rows without one belong to no tick)."""
    h = "coalesce(hash, '')" if "hash" in updates.columns else "''"
    # an instant with the same digits as ts: ticks do not depend on the session's zone
    at = f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH_NTZ}, CAST(ts AS TIMESTAMP_NTZ))) AS at"
    rows = updates.selectExpr(at, *KEY, "seq", "delta", "value", f"{h} AS hash").where("at IS NOT NULL")
    if clock is not None:
        rows = rows.unionByName(clock.selectExpr(at).where("at IS NOT NULL"), allowMissingColumns=True)
    folds = (rows.withWatermark("at", delay).groupBy(F.window("at", f"{interval_s} seconds"), *KEY)
             .agg(*wrap_sum_aggs("delta", "d"), F.max("seq").alias("last_seq"),
                  F.expr("max_by(struct(delta AS last_delta, value, hash), seq) AS _row"), F.max(F.col("seq").isNotNull()).alias("_data")))
    folds = folds.where("_data").selectExpr("* EXCEPT (_row, _data)", "_row.*").selectExpr(
        *KEY, "window", f"unix_seconds(window.end) DIV {interval_s} AS tick_no", f"{DELTA_SQL} AS delta", "value", "hash", "last_seq")
    out = folds.groupBy(*KEY).transformWithState(TickReports(interval_s), REPORT, "Append", "eventTime")
    return out.select(tick_time("tick_no", interval_s).alias("tick"), *KEY, "delta", "value", "hash")


def start_tick_stream(updates: DataFrame, path: str, checkpoint: str, interval_s: int, delay: str = "0 seconds",
                      clock: DataFrame | None = None, trigger: dict | None = None):
    """Start (or resume) the reports as Parquet files below ``path``. Returns the ``StreamingQuery``."""
    from .keyed_stream import STATE_STORE, with_conf

    w = (report_ticks(updates, interval_s, delay, clock).writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint))
    with with_conf(updates.sparkSession, STATE_STORE):
        return (w.trigger(**trigger) if trigger else w).start()
