"""The scalar functions, each applied to every row of ``events``.

Inside the library these are column expressions of the table jobs (parsing
in validation, text forms in display, signatures in admission). Here each
one runs on its own over a whole table, with fixed rules on ``event_id``
producing the awkward inputs (blanks, suffixes, overflow, bad hex…).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import format_counter, parse_counter, parse_gauge
from ..functions.signing import hmac_sql, sign, sign_sql, verify
from ..functions.text import format_gauge, html_escape, metric_line
from ..operators.delivery import is_retriable, is_success
from ..sources.events import read_table
from .queries_ingest import GAUGE_RE, KEY, SPECIAL_RE
from .queries_misc import attempts
from .registry import query

K_TEXT_SQL = "json_extract_string(props, '$.k')"


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


COUNTER_TEXT_SQL = f"""
CASE WHEN event_id % 5 = 0 THEN {K_TEXT_SQL} || '.5'
     WHEN event_id % 7 = 0 THEN ' ' || {K_TEXT_SQL}
     WHEN event_id % 11 = 0 THEN '+' || {K_TEXT_SQL}
     WHEN event_id % 13 = 0 THEN '-' || {K_TEXT_SQL} || '0000000000000000000'
     WHEN event_id % 17 = 0 THEN {K_TEXT_SQL} || 'x'
     ELSE {K_TEXT_SQL} END"""


@query("parse_counter", f"""
SELECT event_id AS seq, t AS text,
       CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') THEN TRY_CAST(t AS BIGINT) END AS delta
FROM (SELECT event_id, {COUNTER_TEXT_SQL} AS t FROM events) x
""")
def q_parse_counter(spark, sf_dir):
    e = _events(spark, sf_dir)
    k = "get_json_object(props, '$.k')"
    t = (f"CASE WHEN event_id % 5 = 0 THEN concat({k}, '.5') WHEN event_id % 7 = 0 THEN concat(' ', {k}) "
         f"WHEN event_id % 11 = 0 THEN concat('+', {k}) "
         f"WHEN event_id % 13 = 0 THEN concat('-', {k}, '0000000000000000000') "
         f"WHEN event_id % 17 = 0 THEN concat({k}, 'x') ELSE {k} END")
    return e.selectExpr("event_id AS seq", f"{t} AS text").withColumn("delta", parse_counter("text"))


GAUGE_TEXT_SQL = """
CASE WHEN event_id % 5 = 0 THEN printf('%.2f', value) || 'e3'
     WHEN event_id % 7 = 0 THEN '1e400'
     WHEN event_id % 11 = 0 THEN '-inf'
     WHEN event_id % 13 = 0 THEN 'Infinity'
     WHEN event_id % 17 = 0 THEN '.5'
     WHEN event_id % 19 = 0 THEN '5.'
     WHEN event_id % 23 = 0 THEN '1_000'
     WHEN event_id % 29 = 0 THEN ' ' || printf('%.2f', value)
     WHEN event_id % 31 = 0 THEN printf('%.2f', value) || 'f'
     ELSE printf('%.2f', value) END"""


@query("parse_gauge", f"""
SELECT event_id AS seq, t AS text,
       CASE WHEN regexp_matches(t, '{GAUGE_RE}') AND isfinite(TRY_CAST(t AS DOUBLE)) THEN TRY_CAST(t AS DOUBLE)
            WHEN regexp_matches(t, '{SPECIAL_RE}') THEN TRY_CAST(t AS DOUBLE) END AS value
FROM (SELECT event_id, {GAUGE_TEXT_SQL} AS t FROM events) x
""")
def q_parse_gauge(spark, sf_dir):
    e = _events(spark, sf_dir)
    v = "format_string('%.2f', value)"
    t = (f"CASE WHEN event_id % 5 = 0 THEN concat({v}, 'e3') WHEN event_id % 7 = 0 THEN '1e400' "
         "WHEN event_id % 11 = 0 THEN '-inf' WHEN event_id % 13 = 0 THEN 'Infinity' "
         "WHEN event_id % 17 = 0 THEN '.5' WHEN event_id % 19 = 0 THEN '5.' WHEN event_id % 23 = 0 THEN '1_000' "
         f"WHEN event_id % 29 = 0 THEN concat(' ', {v}) WHEN event_id % 31 = 0 THEN concat({v}, 'f') ELSE {v} END")
    return e.selectExpr("event_id AS seq", f"{t} AS text").withColumn("value", parse_gauge("text"))


@query("format_counter", f"""
SELECT event_id AS seq, CAST(CAST({K_TEXT_SQL} AS BIGINT) * (event_id - 50000) AS VARCHAR) AS text FROM events
""")
def q_format_counter(spark, sf_dir):
    e = _events(spark, sf_dir)
    d = F.get_json_object("props", "$.k").cast("bigint") * (F.col("event_id") - F.lit(50000))
    return e.select(F.col("event_id").alias("seq"), format_counter(d).alias("text"))


@query("format_gauge", r"""
SELECT event_id AS seq, value,
       regexp_replace(CAST(value AS VARCHAR), '\.0$', '') AS text,
       regexp_replace(CAST(floor(value) AS VARCHAR), '\.0$', '') AS floor_text
FROM events
""")
def q_format_gauge(spark, sf_dir):
    """Go's shortest plain text of every event value (and of its floor,
    which prints without a fraction)."""
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("seq"), "value", format_gauge("value").alias("text"),
                    format_gauge(F.floor("value").cast("double")).alias("floor_text"))


@query("sign", f"SELECT event_id AS seq, {hmac_sql('props', KEY)} AS signature FROM events")
def q_sign(spark, sf_dir):
    """HMAC-SHA256 of each event's ``props`` bytes."""
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("seq"), sign(F.col("props"), KEY).alias("signature"))


@query("verify", f"""
SELECT seq, sig AS signature,
       CASE WHEN sig IS NULL OR sig = '' THEN 'skipped'
            WHEN regexp_matches(sig, '^([0-9a-fA-F]{{2}})*$') AND lower(sig) = h THEN 'ok'
            ELSE 'bad' END AS verdict
FROM (SELECT event_id AS seq, h,
             CASE WHEN event_id % 3 = 0 THEN upper(h)
                  WHEN event_id % 5 = 0 THEN NULL
                  WHEN event_id % 7 = 0 THEN ''
                  WHEN event_id % 11 = 0 THEN substr(h, 2)
                  WHEN event_id % 13 = 0 THEN 'zz' || substr(h, 3)
                  WHEN event_id % 17 = 0 THEN '00' || substr(h, 3)
                  ELSE h END AS sig
      FROM (SELECT event_id, {hmac_sql('props', KEY)} AS h FROM events) a) b
""")
def q_verify(spark, sf_dir):
    """Three-valued signature check of each event's ``props``: skipped when
    no signature came, ok when it matches as bytes, bad otherwise."""
    e = _events(spark, sf_dir)
    h = sign_sql("props", KEY)
    sig = (f"CASE WHEN event_id % 3 = 0 THEN upper({h}) WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING) "
           f"WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN substring({h}, 2, 64) "
           f"WHEN event_id % 13 = 0 THEN concat('zz', substring({h}, 3, 64)) "
           f"WHEN event_id % 17 = 0 THEN concat('00', substring({h}, 3, 64)) ELSE {h} END")
    d = e.selectExpr("event_id AS seq", "props", f"{sig} AS signature")
    return d.select("seq", "signature", verify("props", KEY, "signature").alias("verdict"))


@query("is_retriable", """
SELECT event_id // 8 AS report_id, CAST(event_id % 8 + 1 AS INTEGER) AS attempt_no,
       event_type IN ('signup', 'error') OR (event_type IN ('view', 'click') AND event_id % 5 <> 0)
         OR (event_type = 'purchase' AND event_id % 9 <> 0 AND event_id % 7 <> 0) AS retriable,
       event_type IN ('view', 'click') AND event_id % 5 = 0 AS success
FROM events
""")
def q_is_retriable(spark, sf_dir):
    a = attempts(spark, sf_dir)
    return a.select("report_id", "attempt_no",
                    F.coalesce(is_retriable("kind", "http_status"), F.lit(False)).alias("retriable"),
                    F.coalesce(is_success("kind", "http_status"), F.lit(False)).alias("success"))


@query("metric_line", """
SELECT event_id AS seq, event_type || ':' || chr(9) || props AS line FROM events
""")
def q_metric_line(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("seq"), metric_line("event_type", "props").alias("line"))


@query("html_escape", """
SELECT event_id AS seq,
       replace(replace(replace(replace(replace(
         props || CASE WHEN event_id % 3 = 0 THEN ' <b>&amp;</b> ''x''' ELSE '' END,
         '&', '&amp;'), '''', '&#39;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;') AS text
FROM events
""")
def q_html_escape(spark, sf_dir):
    """Escaping of text with quotes, tags and existing entities."""
    e = _events(spark, sf_dir)
    extra = F.when(F.col("event_id") % 3 == 0, F.lit(" <b>&amp;</b> 'x'")).otherwise(F.lit(""))
    return e.select(F.col("event_id").alias("seq"), html_escape(F.concat("props", extra)).alias("text"))
