"""Reshape, delivery and output-encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codec import gunzip
from ..functions.signing import hmac_sql, sign, verify_sql
from ..operators import delivery as dv
from ..operators import fold as fo
from ..operators import lookup as lk
from ..operators import reshape as rs
from ..operators.common import materialize
from ..session import scratch_path
from ..sinks import snapshot as sk
from ..sinks.bodies import cut_bodies
from ..sources import snapshot as src
from ..sources.events import UPDATES_SQL, WIDE_UPDATES_SQL, load_updates, props_k_sql, read_table
from .queries_core import FOLD_SQL
from .queries_ingest import KEY
from .queries_state import VALUE_TEXT_SQL
from .registry import query


def samples(spark, sf_dir):
    """One host sample per event: a few gauges, the poll counter, per-core CPU."""
    e = read_table(spark, sf_dir, "events")
    k = props_k_sql()
    return e.selectExpr(
        "event_id AS seq", "user_id AS source",
        f"map('Alloc', value, 'HeapAlloc', value * 2, 'RandomValue', CAST({k} AS DOUBLE) / 100.0) AS gauge",
        f"map('{rs.POLL_COUNT}', {k}) AS counter",
        f"array(value, CAST({k} AS DOUBLE), CAST(user_id % 100 AS DOUBLE)) AS pct")


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query("sample_to_rows", f"""
SELECT event_id AS seq, 'Alloc' AS id, 'gauge' AS mtype, CAST(NULL AS BIGINT) AS delta, value FROM events
UNION ALL SELECT event_id, 'HeapAlloc', 'gauge', NULL, value * 2 FROM events
UNION ALL SELECT event_id, 'RandomValue', 'gauge', NULL, CAST({K_SQL} AS DOUBLE) / 100.0 FROM events
UNION ALL SELECT event_id, 'PollCount', 'counter', {K_SQL}, NULL FROM events
""")
def q_sample_to_rows(spark, sf_dir):
    return rs.sample_to_rows(samples(spark, sf_dir))


@query("cpu_array_to_rows", f"""
SELECT event_id AS seq, 'CPUutilization1' AS id, 'gauge' AS mtype, CAST(NULL AS BIGINT) AS delta, value FROM events
UNION ALL SELECT event_id, 'CPUutilization2', 'gauge', NULL, CAST({K_SQL} AS DOUBLE) FROM events
UNION ALL SELECT event_id, 'CPUutilization3', 'gauge', NULL, CAST(user_id % 100 AS DOUBLE) FROM events
""")
def q_cpu_array_to_rows(spark, sf_dir):
    return rs.indexed_gauges(samples(spark, sf_dir), "pct")


def runtime_columns(spark, sf_dir):
    """A wide runtime-stats row per event: one numeric column per gauge name."""
    e = read_table(spark, sf_dir, "events")
    k = f"CAST({props_k_sql()} AS DOUBLE)"
    return e.selectExpr("event_id AS seq",
                        *[f"value * {float(i + 1)} + {k} AS {n}" for i, n in enumerate(rs.RUNTIME_GAUGES)])


_NAMES_SQL = ", ".join(f"'{n}'" for n in rs.RUNTIME_GAUGES)
_VALS_SQL = ", ".join(f"value * {float(i + 1)} + CAST({K_SQL} AS DOUBLE)" for i in range(len(rs.RUNTIME_GAUGES)))


@query("fixed_gauge_project", f"""
SELECT event_id AS seq, unnest([{_NAMES_SQL}]) AS id, 'gauge' AS mtype, CAST(NULL AS BIGINT) AS delta,
       unnest([{_VALS_SQL}]) AS value
FROM events
""")
def q_fixed_gauge_project(spark, sf_dir):
    return rs.gauges_from_columns(runtime_columns(spark, sf_dir))


@query("sample_fold", f"""
WITH r AS (
SELECT event_id AS seq, 'Alloc' AS id, 'gauge' AS mtype, CAST(NULL AS BIGINT) AS delta, value FROM events
UNION ALL SELECT event_id, 'HeapAlloc', 'gauge', NULL, value * 2 FROM events
UNION ALL SELECT event_id, 'RandomValue', 'gauge', NULL, CAST({K_SQL} AS DOUBLE) / 100.0 FROM events
UNION ALL SELECT event_id, 'PollCount', 'counter', {K_SQL}, NULL FROM events
UNION ALL SELECT event_id, 'CPUutilization1', 'gauge', NULL, value FROM events
UNION ALL SELECT event_id, 'CPUutilization2', 'gauge', NULL, CAST({K_SQL} AS DOUBLE) FROM events
UNION ALL SELECT event_id, 'CPUutilization3', 'gauge', NULL, CAST(user_id % 100 AS DOUBLE) FROM events)
SELECT id, mtype,
       CASE WHEN mtype = 'counter' THEN wrap64(sum(delta)) ELSE arg_max_null(delta, seq) END AS delta,
       arg_max_null(value, seq) AS value, '' AS hash
FROM r GROUP BY id, mtype
""")
def q_sample_fold(spark, sf_dir):
    """Agent side to server side: all rows of the reshaped samples folded into the state."""
    return fo.fold_state(rs.sample_to_rows(samples(spark, sf_dir), indexed="pct"))


@query("poll_count", "SELECT user_id AS source, count(*) AS poll_count FROM events GROUP BY user_id")
def q_poll_count(spark, sf_dir):
    return rs.poll_counts(samples(spark, sf_dir))


@query("poll_count_running", """
SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS source,
       count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS poll_count
FROM events
""")
def q_poll_count_running(spark, sf_dir):
    """PollCount after every sample, per source."""
    return rs.poll_counts_running(samples(spark, sf_dir), range_size=512)


def attempts(spark, sf_dir):
    """Each run of eight events is what one report meets on its sends:
    view/click → 200 (on every fifth event only, so that runs get long), else
    500; signup → network error, purchase → cancelled on every ninth, else 400
    on every seventh, else a network error."""
    e = read_table(spark, sf_dir, "events")
    return e.selectExpr(
        "event_id div 8 AS report_id", "CAST(event_id % 8 + 1 AS INT) AS attempt_no",
        "CASE WHEN event_type = 'purchase' AND event_id % 9 = 0 THEN 'cancelled' "
        "WHEN event_type = 'signup' OR (event_type = 'purchase' AND event_id % 7 <> 0) THEN 'network' ELSE 'http' END AS kind",
        "CAST(CASE WHEN event_type IN ('view', 'click') AND event_id % 5 = 0 THEN 200 "
        "WHEN event_type IN ('view', 'click', 'error') THEN 500 "
        "WHEN event_type = 'purchase' AND event_id % 9 <> 0 AND event_id % 7 = 0 THEN 400 END AS INT) AS http_status",
        "CASE WHEN event_type = 'purchase' AND event_id % 9 = 0 THEN 'context canceled' "
        "WHEN event_type = 'signup' OR (event_type = 'purchase' AND event_id % 7 <> 0) THEN 'connection refused' END AS error")


DELIVERY_SQL = """
WITH a AS (
  SELECT event_id // 8 AS report_id, CAST(event_id % 8 + 1 AS INTEGER) AS attempt_no,
         event_type IN ('view', 'click') AND event_id % 5 = 0 AS ok,
         event_type IN ('view', 'click', 'error', 'signup')
           OR (event_type = 'purchase' AND event_id % 9 <> 0 AND event_id % 7 <> 0) AS retriable,
         CASE WHEN event_type = 'purchase' AND event_id % 9 = 0 THEN 'context canceled'
              WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN 'unexpected response status code 400'
              WHEN event_type IN ('signup', 'purchase') THEN 'network error: connection refused'
              ELSE 'retriable http status: unexpected response status code 500' END AS text
  FROM events),
s AS (SELECT report_id, min(CASE WHEN ok OR NOT retriable THEN attempt_no END) AS stop_at FROM a GROUP BY report_id),
x AS (SELECT a.* FROM a JOIN s USING (report_id) WHERE s.stop_at IS NULL OR a.attempt_no <= s.stop_at),
n AS (SELECT *, count(*) FILTER (WHERE NOT ok) OVER (PARTITION BY report_id ORDER BY attempt_no) AS nth FROM x)
SELECT report_id, bool_or(ok) AS succeeded, CAST(count(*) AS INTEGER) AS sends,
       CAST(count(*) FILTER (WHERE NOT ok) AS INTEGER) AS failed_attempts,
       CASE WHEN bool_or(ok) AND count(*) = 1 THEN NULL
            ELSE 'retry ' || CASE WHEN bool_or(ok) THEN 'succeeded' ELSE 'failed' END || ' after '
                 || CAST(count(*) FILTER (WHERE NOT ok) AS VARCHAR) || ' attempts: '
                 || coalesce(string_agg('attempt ' || nth || ': ' || text, '; ' ORDER BY attempt_no)
                             FILTER (WHERE NOT ok), '') END AS message,
       count(*) > 4 AS over_limit
FROM n GROUP BY report_id
"""


@query("delivery_rollup", DELIVERY_SQL)
def q_delivery_rollup(spark, sf_dir):
    return dv.delivery_rollup(attempts(spark, sf_dir), max_sends=4)


@query("sink_json_rows", f"""
SELECT id, mtype,
  '{{"id":' || to_json(id) || ',"type":' || to_json(mtype)
  || coalesce(',"delta":' || CAST(delta AS VARCHAR), '')
  || coalesce(',"value":' || CAST(value AS VARCHAR), '')
  || CASE WHEN hash <> '' THEN ',"hash":' || to_json(hash) ELSE '' END || '}}' AS json
FROM ({FOLD_SQL}) s
""")
def q_sink_json_rows(spark, sf_dir):
    s = fo.fold_state(load_updates(spark, sf_dir))
    enc = sk.metric_json_columns(s)
    return enc.select("id", F.col("type").alias("mtype"), F.to_json(F.struct(*enc.columns)).alias("json"))


@query("sink_gzip", FOLD_SQL)
def q_sink_gzip(spark, sf_dir):
    """A gzip-compressed JSON snapshot, written and read back."""
    base = scratch_path(spark, "snapshot-gz")
    sk.write_snapshot_json(fo.fold_state(load_updates(spark, sf_dir)), base, compression="gzip")
    return src.read_snapshot_json(spark, base)


REPORT_LINE_SQL = f"""
'<p>' || replace(replace(replace(replace(replace(id || ':' || chr(9) || {VALUE_TEXT_SQL},
         '&', '&amp;'), '''', '&#39;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;') || '</p>'"""


SIGNED_BYTES = 4096

SIGNED_SQL = f"""
WITH l AS (
  SELECT id, mtype, '{{"id":' || to_json(id) || ',"type":' || to_json(mtype)
    || coalesce(',"delta":' || CAST(delta AS VARCHAR), '') || coalesce(',"value":' || CAST(value AS VARCHAR), '')
    || CASE WHEN hash <> '' THEN ',"hash":' || to_json(hash) ELSE '' END || '}}' AS json
  FROM ({FOLD_SQL.replace(UPDATES_SQL, WIDE_UPDATES_SQL)}) s),
c AS (SELECT *, (sum(strlen(json) + 1) OVER (PARTITION BY mtype ORDER BY id) - strlen(json) - 1)
               // {SIGNED_BYTES - SIGNED_BYTES // 16 - 1} AS cut FROM l)
SELECT mtype || '.' || kind AS report, min(id) AS first, CASE WHEN kind = 'text' THEN '' ELSE 'gzip' END AS content_encoding,
       '[' || string_agg(json, ',' ORDER BY id) || ']' AS body, 'ok' AS verified, 'bad' AS tampered
FROM c, (SELECT unnest(['json', 'html', 'text']) AS kind) k GROUP BY mtype, kind, cut
"""


@query("sink_signed", SIGNED_SQL)
def q_sink_signed(spark, sf_dir):
    """The state of all users as JSON bodies of at most 4 KiB, each compressed if its content
    type is JSON or HTML, signed over the bytes sent, written, read back, verified and
    unpacked; ``tampered`` is what verification says of the bytes with one more."""
    state = sk.metric_json_columns(fo.fold_state(load_updates(spark, sf_dir, wide=True)))
    rows = state.selectExpr("type", "id", "to_json(struct(id, type, delta, value, hash)) AS json")
    bodies = cut_bodies(rows, "type", "id", "json", SIGNED_BYTES)
    bodies = bodies.selectExpr("type", "first", "body", "explode(map('json', 'application/json', 'html', 'text/html; charset=utf-8', "
                                               "'text', 'text/plain')) AS (kind, content_type)")
    path = scratch_path(spark, "signed")
    sk.signed_payloads(bodies.selectExpr("concat(type, '.', kind) AS report", "first", "body", "content_type"), KEY).write.parquet(path)
    got = spark.read.parquet(path)
    got = materialize(got.withColumn("_plain", gunzip(F.expr("CASE WHEN content_encoding = 'gzip' THEN payload END"))))
    return got.selectExpr(
        "report", "first", "content_encoding", "CAST(CASE WHEN content_encoding = 'gzip' THEN _plain ELSE payload END AS STRING) AS body",
        f"{verify_sql('payload', KEY, 'signature')} AS verified",
        f"{verify_sql('concat(payload, unhex("00"))', KEY, 'signature')} AS tampered")


@query("sign_lines", f"""
SELECT id, mtype, line, {hmac_sql('line', KEY)} AS signature
FROM (SELECT id, mtype, {REPORT_LINE_SQL} AS line FROM ({FOLD_SQL}) s) t
""")
def q_sign_lines(spark, sf_dir):
    """Report lines with the HMAC of each line's bytes."""
    lines = lk.report_lines(fo.fold_state(load_updates(spark, sf_dir)))
    return lines.withColumn("signature", sign(F.col("line"), KEY))
