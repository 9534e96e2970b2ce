"""Keyed folds of update tables into state tables.

The fold is the heart of the engine: counters add (int64 wrap-around),
gauges keep the last row, and for counters the non-additive fields
(``value``, ``hash``) also come from the last row. "Last" means the largest
``seq``.

Physical shape: one ``groupBy(id, mtype)`` whose aggregates (limb sums,
``max_by`` over fixed-width columns, ``max``) all have fixed-width buffers,
so Spark plans a codegen'd partial ``HashAggregate`` before the shuffle: each
task ships at most one row per key, so a hot key costs no more than a cold
one. The string ``hash`` would force a sort-based aggregate over every row;
instead it is folded from only the rows that carry a non-empty hash (usually
none, and the Parquet filter skips row groups without one) and joined back on
the key. Both sides are already hash-partitioned on the key by their own
aggregation, so that join adds no exchange. When the input is expensive to
recompute (decoded request bodies), ``hash_pass="inline"`` folds everything
in one pass instead, accepting the sort-based aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import LIMBS, combine_sql, wrap_add_sql, wrap_sum_aggs, wrap_sum_result
from ..schema import COUNTER, GAUGE, METRIC, NIL_DELTA, NIL_METRIC, NIL_VALUE, STATE_COLUMNS, UNKNOWN_TYPE


KEY = ("id", "mtype")
DELTA_SQL = f"CASE WHEN mtype = '{COUNTER}' THEN {combine_sql([f'd_l{i}' for i in range(LIMBS)])} ELSE last_delta END"


def fold_state(updates: DataFrame, keep_seq: bool = False, hash_pass: str = "separate",
               order: tuple[str, ...] = ("seq",), keys: tuple[str, ...] = KEY) -> DataFrame:
    """Update rows ``(seq, id, mtype, delta, value[, hash])`` → state rows.

    Input is assumed validated (see ``operators.validate``). ``order`` names
    the columns of the arrival order (``("batch_id", "pos")`` for decoded
    bodies, however many items a body has); with ``keep_seq`` the result
    carries the order of the last row as ``last_seq`` for later merges.

    ``hash_pass`` picks how the string ``hash`` is folded:
    ``"separate"`` (default, for stored tables) keeps the main aggregate a
    ``HashAggregate`` and reads the rows carrying a hash in a second,
    column-pruned pass; ``"inline"`` (for inputs that are expensive to
    recompute, e.g. freshly decoded request bodies, and for orders of several
    columns) folds it in the same single pass, which Spark plans as a
    sort-based aggregate.

    The last row is always one whole row. The order should be total; of rows
    with equal order ``"inline"`` takes one whole, and ``"separate"`` takes the
    numbers of one and its hash only if no other hashed row shares its order.
    """
    if hash_pass not in ("separate", "inline"):
        raise ValueError(f"hash_pass must be 'separate' or 'inline', not {hash_pass!r}")
    h = "coalesce(hash, '')" if "hash" in updates.columns else "''"
    last = order[0] if len(order) == 1 else f"struct({', '.join(order)})"
    u = updates.selectExpr(f"{last} AS _at", *keys, "delta", "value", f"{h} AS hash")
    sums = wrap_sum_aggs("delta", "d")
    keep = ["last_seq"] if keep_seq else []
    if hash_pass == "inline":
        out = u.groupBy(*keys).agg(*sums, F.expr("max(_at) AS last_seq"),
                                   F.expr("max_by(struct(delta AS last_delta, value, hash), _at) AS _row"))
        out = out.selectExpr("* EXCEPT (_row)", "_row.*")
        return out.selectExpr(*keys, f"{DELTA_SQL} AS delta", "value", "hash", *keep)
    core = u.groupBy(*keys).agg(*sums, F.expr("max_by(delta, _at) AS last_delta"),
                                F.expr("max_by(value, _at) AS value"), F.expr("max(_at) AS last_seq"))
    hashed = (u.filter("hash != ''").groupBy(*keys)
               .agg(F.expr("max_by(struct(_at, delta, value, hash), _at) AS _h")))
    same = "_h._at = last_seq AND _h.delta <=> last_delta AND _h.value <=> value"
    return core.join(hashed, list(keys), "left").selectExpr(
        *keys, f"{DELTA_SQL} AS delta", "value", f"CASE WHEN {same} THEN _h.hash ELSE '' END AS hash", *keep)


def counter_totals(updates: DataFrame) -> DataFrame:
    """Sum of deltas per counter id (int64 wrap-around)."""
    return (updates.filter(F.col("mtype") == COUNTER)
            .groupBy("id").agg(*wrap_sum_aggs("delta", "d"))
            .select("id", wrap_sum_result("d").alias("delta")))


def gauge_last(updates: DataFrame) -> DataFrame:
    """Last value per gauge id (a null last value stays null)."""
    return (updates.filter(F.col("mtype") == GAUGE)
            .groupBy("id").agg(F.max_by("value", "seq").alias("value")))


def of_kind(state: DataFrame, kind: str) -> DataFrame:
    return state.filter(F.col("mtype") == kind)


def merge_state(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """State + a newer state (e.g. one batch folded) → state.

    Same rules as applying ``new``'s rows one by one: counters add, all other
    fields come from ``new`` where it has the key. When both sides carry
    ``last_seq`` the larger one wins for them (safe for out-of-order batches;
    ``new`` on ties) and the result keeps it. One full outer join on the key:
    each side has a row a key, and a side that was just folded is already
    partitioned by it.
    """
    carry = "last_seq" in old.columns and "last_seq" in new.columns
    side = lambda df, p: df.selectExpr(
        *keys, f"delta AS {p}_delta", f"value AS {p}_value", f"coalesce(hash, '') AS {p}_hash",
        *([f"last_seq AS {p}_seq"] if carry else []), f"true AS {p}_in")
    both = side(old, "o").join(side(new, "n"), list(keys), "full")
    wins = "n_in AND NOT coalesce(o_seq > n_seq, false)" if carry else "n_in"
    pick = lambda c: f"CASE WHEN {wins} THEN n_{c} ELSE o_{c} END"
    return both.selectExpr(
        *keys, f"CASE WHEN mtype = '{COUNTER}' THEN {wrap_add_sql('o_delta', 'n_delta')} ELSE {pick('delta')} END AS delta",
        f"{pick('value')} AS value", f"{pick('hash')} AS hash", *([f"{pick('seq')} AS last_seq"] if carry else []))


def store_check(rows: DataFrame) -> DataFrame:
    """Store-level rule (weaker than request validation): a missing row,
    unknown type, or a counter/gauge without its number. Empty ids pass."""
    code = (f"CASE WHEN mtype IS NULL AND id IS NULL AND delta IS NULL AND value IS NULL THEN '{NIL_METRIC}' "
            f"WHEN mtype = '{COUNTER}' THEN CASE WHEN delta IS NULL THEN '{NIL_DELTA}' END "
            f"WHEN mtype = '{GAUGE}' THEN CASE WHEN value IS NULL THEN '{NIL_VALUE}' END "
            f"ELSE '{UNKNOWN_TYPE}' END")
    return rows.selectExpr("*", f"{code} AS reject_code")


def restore_state(current: DataFrame, snapshot: DataFrame, order_col: str | None = None) -> DataFrame:
    """Replay snapshot rows through the fold onto the current state.

    Counters present in both add up; the snapshot's rows come after the
    current state, in the order of ``order_col`` (default: ``at``, the place in
    file order that ``read_snapshot_json(with_at=True)`` gives, if there is one,
    else as the rows are read, whatever files Spark puts in a partition). The first bad snapshot row aborts: the returned
    plan raises when it runs (checked on the executors, nothing is collected).
    """
    checked = store_check(snapshot).filter(
        F.when(F.col("reject_code").isNotNull(),
               F.raise_error(F.concat(F.lit("restore aborted: "), F.col("reject_code"))))
         .otherwise(F.lit(True)))
    if order_col is None and "at" in checked.columns:
        order_col = "at"
    if order_col is None:
        checked, order_col = checked.withColumn("_ord", F.monotonically_increasing_id()), "_ord"
    for c in STATE_COLUMNS:
        if c not in checked.columns:
            checked = checked.withColumn(c, F.lit(None).cast(METRIC[c].dataType))
    return merge_state(current, fold_state(checked, hash_pass="inline", order=(order_col,)))
