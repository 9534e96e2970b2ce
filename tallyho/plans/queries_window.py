"""Window queries: running echo totals and tick snapshots."""

from __future__ import annotations

from ..operators import fold as fo
from ..operators import window as wi
from ..sources.events import UPDATES_SQL, load_updates
from .queries_state import OLD_SQL, SPLIT_TS, _halves
from .registry import query

BATCH_ECHO_SQL = f"""
WITH a AS ({OLD_SQL}),
n AS (SELECT * FROM ({UPDATES_SQL}) u WHERE ts >= TIMESTAMP '{SPLIT_TS}')
SELECT n.seq, n.id, n.mtype,
       CASE WHEN n.mtype = 'counter'
            THEN wrap64(coalesce(a.delta, 0)::HUGEINT + coalesce(sum(n.delta) OVER (
                   PARTITION BY n.id, n.mtype ORDER BY n.seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0))
            ELSE n.delta END AS delta,
       n.value, n.hash
FROM n LEFT JOIN a ON a.id = n.id AND a.mtype = n.mtype
"""


@query("batch_echo", BATCH_ECHO_SQL)
def q_batch_echo(spark, sf_dir):
    """Echo of the later updates on top of the state of the earlier ones.
    Small seq ranges here so that every key spans many window partitions."""
    old, new = _halves(spark, sf_dir)
    return wi.batch_echo(new, prior=fo.fold_state(old), range_size=256)


DAY = 86400

TICK_SQL = f"""
WITH t AS (
  SELECT *, CAST(floor(epoch_us(ts) / {DAY * 1_000_000}) AS BIGINT) + 1 AS tick_no
  FROM ({UPDATES_SQL}) u),
k AS (SELECT id, mtype, min(tick_no) AS first_tick FROM t GROUP BY id, mtype),
m AS (SELECT max(tick_no) AS last_tick FROM t),
g AS (SELECT k.id, k.mtype, unnest(generate_series(k.first_tick, m.last_tick)) AS tick_no FROM k, m),
j AS (SELECT g.id, g.mtype, g.tick_no, t.seq, t.delta, t.value
      FROM g JOIN t ON t.id = g.id AND t.mtype = g.mtype AND t.tick_no <= g.tick_no)
SELECT make_timestamp(tick_no * {DAY * 1_000_000}) AS tick, id, mtype,
       CASE WHEN mtype = 'counter' THEN wrap64(sum(delta))
            ELSE arg_max_null(delta, seq) END AS delta,
       arg_max_null(value, seq) AS value
FROM j GROUP BY tick_no, id, mtype
"""


@query("tick_snapshot", TICK_SQL)
def q_tick_snapshot(spark, sf_dir):
    """Daily snapshots of the state (the dump/report ticker, as a table)."""
    return wi.tick_snapshot(load_updates(spark, sf_dir, with_ts=True), DAY)


# One key holds a third of all rows: the echo's window partitions are
# (key, seq range), so the hot key is spread over many tasks.
HOT_UPDATES_SQL = f"""
SELECT seq, CASE WHEN seq % 3 = 0 THEN 'hot' ELSE id END AS id,
       CASE WHEN seq % 3 = 0 THEN 'counter' ELSE mtype END AS mtype,
       CASE WHEN seq % 3 = 0 THEN coalesce(delta, 1) ELSE delta END AS delta,
       CASE WHEN seq % 3 = 0 THEN NULL ELSE value END AS value, hash
FROM ({UPDATES_SQL}) u
"""


def hot_updates(spark, sf_dir):
    return load_updates(spark, sf_dir).selectExpr(
        "seq",
        "CASE WHEN seq % 3 = 0 THEN 'hot' ELSE id END AS id",
        "CASE WHEN seq % 3 = 0 THEN 'counter' ELSE mtype END AS mtype",
        "CASE WHEN seq % 3 = 0 THEN coalesce(delta, 1) ELSE delta END AS delta",
        "CASE WHEN seq % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS value",
        "hash")


@query("batch_echo_hot", f"""
SELECT seq, id, mtype,
       CASE WHEN mtype = 'counter'
            THEN wrap64(sum(delta) OVER (PARTITION BY id, mtype ORDER BY seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            ELSE delta END AS delta,
       value, hash
FROM ({HOT_UPDATES_SQL}) h
""")
def q_batch_echo_hot(spark, sf_dir):
    """Running totals when one counter receives a third of all updates."""
    return wi.batch_echo(hot_updates(spark, sf_dir), range_size=1024)


@query("fold_state_hot", f"""
SELECT id, mtype,
       CASE WHEN mtype = 'counter' THEN wrap64(sum(delta)) ELSE arg_max_null(delta, seq) END AS delta,
       arg_max_null(value, seq) AS value, arg_max_null(hash, seq) AS hash
FROM ({HOT_UPDATES_SQL}) h GROUP BY id, mtype
""")
def q_fold_state_hot(spark, sf_dir):
    """The fold when one key holds a third of all rows (partial aggregation
    sends one row per task for it)."""
    return fo.fold_state(hot_updates(spark, sf_dir))
