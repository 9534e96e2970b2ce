"""Update tables derived from the ``events`` table.

The ``events`` table stands in for an ingest log: each event is one metric
update. The mapping is a plain projection, so Catalyst prunes the scan to the
columns used and pushes any later filter into the Parquet reader.

    seq      = event_id
    id       = event_type || '_' || (user_id % 10)      (or user_id when wide)
    mtype    = 'counter' for click/view/signup, else 'gauge'
    delta    = counters: props.k as BIGINT (plus 2^62 on every 97th event, so totals wrap), else NULL
    value    = gauges: value, else NULL
    hash     = 'h<event_id>' on every 5th event, else ''
    batch_id = event_id div 100, pos = event_id % 100
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import COUNTER, GAUGE

# Which event types count as counters; the batch size.
COUNTER_EVENTS = ("click", "view", "signup")
BATCH_SIZE = 100
LARGE = 1 << 62


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def props_k_sql(props: str = "props") -> str:
    """``k`` from a props JSON string, as BIGINT (null if absent or not an integer)."""
    return f"try_cast(get_json_object({props}, '$.k') AS BIGINT)"


def props_k(props: str = "props"):
    return F.expr(props_k_sql(props))


_COUNTER_SQL = "event_type IN (" + ", ".join(f"'{e}'" for e in COUNTER_EVENTS) + ")"


def updates_from_events(events: DataFrame, wide: bool = False, with_ts: bool = False) -> DataFrame:
    """One SQL projection (a single call into the JVM, pruned and pushed like
    any other)."""
    suffix = "user_id" if wide else "user_id % 10"
    cols = [
        "event_id AS seq",
        f"event_id div {BATCH_SIZE} AS batch_id",
        f"CAST(event_id % {BATCH_SIZE} AS INT) AS pos",
        f"concat(event_type, '_', CAST({suffix} AS STRING)) AS id",
        f"CASE WHEN {_COUNTER_SQL} THEN '{COUNTER}' ELSE '{GAUGE}' END AS mtype",
        f"CASE WHEN {_COUNTER_SQL} THEN {props_k_sql()} + CASE WHEN event_id % 97 = 0 THEN {LARGE} ELSE 0 END END AS delta",
        f"CASE WHEN NOT {_COUNTER_SQL} THEN value END AS value",
        "CASE WHEN event_id % 5 = 0 THEN concat('h', CAST(event_id AS STRING)) ELSE '' END AS hash",
    ]
    if with_ts:
        cols.insert(1, "ts")
    return events.selectExpr(*cols)


def load_updates(spark: SparkSession, sf_dir: str, wide: bool = False, with_ts: bool = False) -> DataFrame:
    return updates_from_events(read_table(spark, sf_dir, "events"), wide=wide, with_ts=with_ts)


# Rules that make some updates invalid, so validation and batch gating have
# work on every row of the table (no row is dropped or sampled).
def dirty_updates_from_events(events: DataFrame) -> DataFrame:
    u = updates_from_events(events)
    return u.selectExpr(
        "seq", "batch_id", "pos",
        "CASE WHEN seq % 1013 = 0 THEN '' ELSE id END AS id",
        "CASE WHEN seq % 1009 = 0 THEN 'unknown' ELSE mtype END AS mtype",
        "CASE WHEN seq % 997 = 0 THEN CAST(NULL AS BIGINT) ELSE delta END AS delta",
        "CASE WHEN seq % 997 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS value",
        "hash",
    )


def load_dirty_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_updates_from_events(read_table(spark, sf_dir, "events"))


# The same mapping as SQL, for DuckDB oracles.
UPDATES_SQL = """
SELECT event_id AS seq,
       CAST(event_id // 100 AS BIGINT) AS batch_id,
       CAST(event_id % 100 AS INTEGER) AS pos,
       event_type || '_' || CAST(user_id % 10 AS VARCHAR) AS id,
       CASE WHEN event_type IN ('click','view','signup') THEN 'counter' ELSE 'gauge' END AS mtype,
       CASE WHEN event_type IN ('click','view','signup')
            THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)
                 + CASE WHEN event_id % 97 = 0 THEN 4611686018427387904 ELSE 0 END END AS delta,
       CASE WHEN event_type IN ('click','view','signup') THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 5 = 0 THEN 'h' || CAST(event_id AS VARCHAR) ELSE '' END AS hash,
       ts
FROM events
"""

WIDE_UPDATES_SQL = UPDATES_SQL.replace("CAST(user_id % 10 AS VARCHAR)", "CAST(user_id AS VARCHAR)")

DIRTY_UPDATES_SQL = f"""
SELECT seq, batch_id, pos,
       CASE WHEN seq % 1013 = 0 THEN '' ELSE id END AS id,
       CASE WHEN seq % 1009 = 0 THEN 'unknown' ELSE mtype END AS mtype,
       CASE WHEN seq % 997 = 0 THEN NULL ELSE delta END AS delta,
       CASE WHEN seq % 997 = 0 THEN NULL ELSE value END AS value,
       hash
FROM ({UPDATES_SQL}) u0
"""
