"""Core fold, aggregation and join queries over update tables from ``events``."""

from __future__ import annotations


from ..operators import fold as fo
from ..schema import COUNTER
from ..sources.events import UPDATES_SQL, WIDE_UPDATES_SQL, load_updates
from .registry import query

FOLD_SQL = f"""
WITH u AS ({UPDATES_SQL})
SELECT id, mtype,
       CASE WHEN mtype = 'counter' THEN wrap64(sum(delta))
            ELSE arg_max_null(delta, seq) END AS delta,
       arg_max_null(value, seq) AS value,
       arg_max_null(hash, seq) AS hash
FROM u GROUP BY id, mtype
"""


@query("fold_state", FOLD_SQL)
def q_fold_state(spark, sf_dir):
    return fo.fold_state(load_updates(spark, sf_dir))


@query("fold_state_wide", FOLD_SQL.replace(UPDATES_SQL, WIDE_UPDATES_SQL))
def q_fold_state_wide(spark, sf_dir):
    """Same fold with one key per (event type, user): many more keys."""
    return fo.fold_state(load_updates(spark, sf_dir, wide=True))


@query("counter_total", f"""
WITH u AS ({UPDATES_SQL})
SELECT id, wrap64(sum(delta)) AS delta FROM u WHERE mtype = 'counter' GROUP BY id
""")
def q_counter_total(spark, sf_dir):
    return fo.counter_totals(load_updates(spark, sf_dir))


@query("gauge_last", f"""
WITH u AS ({UPDATES_SQL})
SELECT id, arg_max_null(value, seq) AS value FROM u WHERE mtype = 'gauge' GROUP BY id
""")
def q_gauge_last(spark, sf_dir):
    return fo.gauge_last(load_updates(spark, sf_dir))


@query("filter_kind", f"SELECT * FROM ({FOLD_SQL}) s WHERE mtype = 'counter'")
def q_filter_kind(spark, sf_dir):
    return fo.of_kind(fo.fold_state(load_updates(spark, sf_dir)), COUNTER)


def lineitem_updates(spark, sf_dir):
    """``lineitem`` as a counter log: each line adds its quantity to its
    part's counter. (The table has no unique arrival order, so only counters,
    whose totals do not depend on order, are taken from it.)"""
    from ..sources.events import read_table
    li = read_table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_orderkey * 8 + l_linenumber AS seq", "concat('part_', CAST(l_partkey AS STRING)) AS id",
        f"'{COUNTER}' AS mtype", "CAST(floor(l_quantity) AS BIGINT) AS delta", "CAST(NULL AS DOUBLE) AS value")


@query("fold_lineitem", """
SELECT 'part_' || CAST(l_partkey AS VARCHAR) AS id, 'counter' AS mtype,
       CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS delta, CAST(NULL AS DOUBLE) AS value, '' AS hash
FROM lineitem GROUP BY l_partkey
""")
def q_fold_lineitem(spark, sf_dir):
    """The fold over the largest given table (6x the events at every scale)."""
    return fo.fold_state(lineitem_updates(spark, sf_dir))
