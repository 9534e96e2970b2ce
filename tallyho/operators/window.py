"""Ordered (window) operators: running echo totals and tick snapshots.

Both are computed so that no single task has to hold all rows of a hot key:

* ``batch_echo`` cuts each key's updates into ``seq`` ranges. Limb totals per
  (key, range) form a small table; a window over it gives each range's
  starting offset. The per-row running sum is a window partitioned by
  (key, range), so its partitions are bounded by the range size however many
  rows a key has.
* ``tick_snapshot`` folds per (key, tick) first (partial aggregation), runs
  its window over that small table, and fills ticks without updates by
  exploding each row up to the key's next tick with data: no grid join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import LIMBS, combine_sql, limb_sql, wrap_sum_aggs
from ..schema import COUNTER

KEY = ["id", "mtype"]
DEFAULT_RANGE = 1 << 20
#: Ticks filled by one array.
TICK_CHUNK = 8640


def batch_echo(updates: DataFrame, prior: DataFrame | None = None,
               range_size: int = DEFAULT_RANGE, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Echo of each update as a batch response shows it.

    A counter row echoes the key's total right after it was applied: prior
    state + all earlier counter deltas of that key + its own (int64
    wrap-around). A gauge row echoes as sent. ``order`` is the arrival order
    (``("batch_id", "pos")`` for decoded bodies). ``range_size`` is the span of
    its first column that one window partition holds (a tuning knob, no rows
    are dropped): pick it so that a range of the densest key fits a task;
    orders with wide gaps want larger ranges, repeated values smaller ones.
    """
    by = ", ".join(order)
    h = "coalesce(hash, '')" if "hash" in updates.columns else "''"
    # gauges ride through the same window: they add nothing to a total
    u = updates.selectExpr(*order, *KEY, "delta", "value", f"{h} AS hash", f"{order[0]} div {int(range_size)} AS rng",
                           f"CASE WHEN mtype = '{COUNTER}' THEN delta ELSE 0 END AS _add")

    # per (key, range) limb totals → offset of each range = sum of earlier ranges
    t = u.groupBy(*KEY, "rng").agg(*wrap_sum_aggs("_add", "r"))
    t = t.selectExpr(*KEY, "rng", *[
        f"coalesce(sum(r_l{i}) OVER (PARTITION BY id, mtype ORDER BY rng "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b_l{i}" for i in range(LIMBS)])
    if prior is not None:
        p = prior.filter(f"mtype = '{COUNTER}'").selectExpr(
            *KEY, *[f"{limb_sql('coalesce(delta, 0)', i)} AS p_l{i}" for i in range(LIMBS)])
        t = t.join(p, KEY, "left").selectExpr(
            *KEY, "rng", *[f"b_l{i} + coalesce(p_l{i}, 0) AS b_l{i}" for i in range(LIMBS)])

    # running limb sums inside (key, range): the only window over all rows
    run = u.selectExpr(*order, *KEY, "rng", "delta", "value", "hash", *[
        f"sum({limb_sql('_add', i)}) OVER (PARTITION BY id, mtype, rng ORDER BY {by} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w_l{i}" for i in range(LIMBS)])
    total = combine_sql([f"coalesce(w_l{i}, 0) + b_l{i}" for i in range(LIMBS)])
    return run.join(t, [*KEY, "rng"], "left").selectExpr(
        *order, *KEY, f"CASE WHEN mtype = '{COUNTER}' THEN {total} ELSE delta END AS delta", "value", "hash")


def running_counts(rows: DataFrame, key: str, range_size: int | None = None) -> DataFrame:
    """``(seq, key)`` → the running count per key as ``poll_count``, split by ``seq`` range."""
    r = rows.selectExpr("seq", key, f"seq div {int(range_size or DEFAULT_RANGE)} AS rng")
    t = r.groupBy(key, "rng").agg(F.expr("count(1) AS n")).selectExpr(
        key, "rng", f"coalesce(sum(n) OVER (PARTITION BY {key} ORDER BY rng "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    run = r.selectExpr("seq", key, "rng", f"row_number() OVER (PARTITION BY {key}, rng ORDER BY seq) AS nth")
    return run.join(t, [key, "rng"], "left").selectExpr("seq", key, "before + nth AS poll_count")


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def tick_number(ts_col: str, interval_s: int):
    """Snapshot tick an update belongs to: the first tick boundary after it
    (ticks at multiples of the interval since the epoch)."""
    us = F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, CAST({ts_col} AS TIMESTAMP_NTZ))")
    return F.floor(us / F.lit(interval_s * 1_000_000)).cast("bigint") + F.lit(1)


def tick_time(tick_col: str, interval_s: int):
    return F.expr(f"timestampadd(MICROSECOND, {tick_col} * {interval_s * 1_000_000}, {EPOCH_NTZ})")


def tick_folds(updates: DataFrame, interval_s: int) -> DataFrame:
    """Updates folded per key and tick, with ``last_seq``: one row a key and tick that
    has data. Folds of different parts of the log merge with ``merge_state``."""
    from .fold import fold_state
    u = updates.withColumn("tick", tick_number("ts", interval_s))
    return fold_state(u, keep_seq=True, keys=(*KEY, "tick"))


def fill_ticks(folds: DataFrame, interval_s: int, last_tick: int | None = None) -> DataFrame:
    """Per-tick folds → the state as of every tick, also of ticks when nothing arrived.

    The output has a row a key and tick by definition. A long gap is filled in
    two steps, by chunks of ``TICK_CHUNK`` ticks, so no array holds all of it.
    """
    if last_tick is not None:
        folds = folds.filter(F.col("tick") <= F.lit(int(last_tick)))
        end = F.lit(int(last_tick)).cast("bigint")
    else:
        end = folds.agg(F.max("tick")).scalar()
    w = "OVER (PARTITION BY id, mtype ORDER BY tick"
    run = folds.selectExpr(
        *KEY, "tick", "delta", "value", "hash",
        *[f"sum({limb_sql('delta', i)}) {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s_l{i}" for i in range(LIMBS)],
        f"lead(tick) {w}) - 1 AS until").withColumn("until", F.coalesce("until", end))
    chunk = run.selectExpr("*", f"explode(sequence(tick div {TICK_CHUNK}, until div {TICK_CHUNK})) AS c")
    filled = chunk.selectExpr("*", f"explode(sequence(greatest(tick, c * {TICK_CHUNK}), "
                                   f"least(until, (c + 1) * {TICK_CHUNK} - 1))) AS t")
    return filled.select(
        tick_time("t", interval_s).alias("tick"), *KEY,
        F.expr(f"CASE WHEN mtype = '{COUNTER}' THEN {combine_sql([f's_l{i}' for i in range(LIMBS)])} "
               "ELSE delta END").alias("delta"),
        "value", "hash")


def tick_snapshot(updates: DataFrame, interval_s: int, last_tick: int | None = None) -> DataFrame:
    """State as of every tick: each metric seen so far, once per tick, with
    its folded value at that time (updates with ``ts`` before the tick; rows
    without a ``ts`` belong to no tick).

    ``last_tick`` (tick number) bounds the series; by default the tick of the
    newest update (a scalar subquery of the same plan).
    """
    folds = tick_folds(updates.filter("ts IS NOT NULL"), interval_s)
    return fill_ticks(folds, interval_s, last_tick).drop("hash")
