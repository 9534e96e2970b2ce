"""Schemas, metric kinds, reject codes and route names.

Every table in the library has an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The two metric kinds (case-sensitive).
COUNTER = "counter"
GAUGE = "gauge"
KINDS = (COUNTER, GAUGE)

# State / snapshot row: unique on (id, mtype). ``hash`` is a plain string
# ('' when absent), ``delta``/``value`` are nullable numbers.
METRIC = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("mtype", T.StringType(), False),
    T.StructField("delta", T.LongType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("hash", T.StringType(), True),
])
STATE_COLUMNS = ["id", "mtype", "delta", "value", "hash"]

# Update row: a metric row plus its arrival order. ``seq`` replaces the
# mutex of a single-node store: the larger ``seq`` is the later write.
UPDATE = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("pos", T.IntegerType(), True),
    T.StructField("id", T.StringType(), True),
    T.StructField("mtype", T.StringType(), True),
    T.StructField("delta", T.LongType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("hash", T.StringType(), True),
])

# JSON shape of one metric (field names as sent on the wire).
METRIC_JSON = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("delta", T.LongType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("hash", T.StringType(), True),
])

ENVELOPE = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("body", T.BinaryType(), True),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("content_encoding", T.StringType(), True),
    T.StructField("signature", T.StringType(), True),
])

ATTEMPT = T.StructType([
    T.StructField("report_id", T.LongType(), False),
    T.StructField("attempt_no", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), True),        # 'network' | 'http'
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("error", T.StringType(), True),
])

LOOKUP = T.StructType([
    T.StructField("req_id", T.LongType(), False),
    T.StructField("id", T.StringType(), True),
    T.StructField("mtype", T.StringType(), True),
])

# Reject codes.
NIL_DELTA = "nil_delta"
NIL_VALUE = "nil_value"
UNKNOWN_TYPE = "unknown_metric_type"
UNKNOWN_VALUE = "unknown_metric_value"
EMPTY_TYPE = "empty_metric_type"
EMPTY_NAME = "empty_metric_name"
EMPTY_VALUE = "empty_metric_value"
NIL_METRIC = "nil_metric"
NOT_FOUND = "not_found"
PARSE_ERROR = "parse_error"                # body is not decodable JSON
BAD_SIGNATURE = "bad_signature"
BAD_GZIP = "bad_gzip"
BAD_CONTENT_TYPE = "bad_content_type"

# Retry messages of the sender.
RETRIABLE_STATUS_TEXT = "retriable http status"
STATUS_TEXT = "unexpected response status code"
NETWORK_TEXT = "network error"

# Routes whose status rules differ (see operators.validate.route_status).
ROUTE_UPDATE_TEXT = "update_text"      # POST /update/{type}/{name}/{value}
ROUTE_UPDATE_JSON = "update_json"      # POST /update
ROUTE_UPDATES_JSON = "updates_json"    # POST /updates/
ROUTE_VALUE_TEXT = "value_text"        # GET  /value/{type}/{name}
ROUTE_VALUE_JSON = "value_json"        # POST /value
