"""Request payloads as table columns: JSON bodies, URL paths, envelopes.

JSON is decoded as VARIANT (``try_parse_json``) and then field by field, by
the rules of a strict struct decoder: a field is looked up by its top-level
name in any case, unknown fields are ignored at any depth, and the body is
refused when a known field has the wrong JSON type or a number does not fit
(``1e400``). Spark's typed ``from_json`` would silently null such a field.
All of it is one projection per body, with no shuffle.

When an object has a field in several spellings, the one that sorts last wins
(all lower case before all others); exact duplicate names are refused by the
parser. A body beyond what a VARIANT can hold fails the job with its size: it
is never answered as undecodable; ``large_bodies`` decodes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import gunzip
from ..functions._util import sql_str
from ..functions.signing import verify_sql
from ..operators.common import materialize
from ..schema import (BAD_CONTENT_TYPE, BAD_GZIP, BAD_SIGNATURE, PARSE_ERROR)

# Allowed JSON types per field, as ``schema_of_variant`` spells them.
_STR = "(STRING|VOID)"
_INT = "(TINYINT|SMALLINT|INT|BIGINT|VOID)"
_NUM = r"(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\)|VOID)"
#: JSON name → (column, allowed types, SQL type).
FIELDS = {"id": ("id", _STR, "string"), "type": ("mtype", _STR, "string"), "delta": ("delta", _INT, "bigint"),
          "value": ("value", _NUM, "double"), "hash": ("hash", _STR, "string")}
#: Texts from this size on may be too large for a VARIANT (128 MiB).
LARGE_BODY = 100 << 20

# Everything below is SQL text: a projection is one call into the JVM.


def _decoded_sql(e: str, fields: tuple[str, ...]) -> str:
    """Variant expression → struct(bad, columns): a JSON object, or null for a row of nulls."""
    entries = "map_entries(try_variant_get(v, '$', 'map<string,variant>'))"
    picked = ", ".join(f"'{f}', try_element_at(filter(m, x -> lower(x.key) = '{f}'), -1).value" for f in fields)
    cols, bad = [], ["o.m IS NULL AND NOT o.nil"]
    for f in fields:
        col, types, sql_type = FIELDS[f]
        value = f"try_variant_get(o.f.{f}, '$', '{sql_type}')"
        cols.append(f"'{col}', " + (f"coalesce({value}, '')" if f == "hash" else value))
        bad.append(f"coalesce(schema_of_variant(o.f.{f}), 'VOID') NOT RLIKE {sql_str(f'^{types}$')}")
        if sql_type == "double":
            bad.append(f"coalesce(abs({value}) = double('infinity'), false)")
    # three one-element transforms: each step is evaluated once and named
    step = f"transform(array({e}), v -> named_struct('nil', v IS NULL OR is_variant_null(v), 'm', {entries}))"
    step = f"transform({step}, y -> named_struct('nil', y.nil, 'm', y.m, 'f', transform(array(y.m), m -> named_struct({picked}))[0]))"
    return f"transform({step}, o -> named_struct('bad', {' OR '.join(bad)}, {', '.join(cols)}))[0]"


def _variant(df: DataFrame, body: str) -> DataFrame:
    """``body`` → ``_v``; a body that is too large to hold fails the job."""
    keep = [f"`{c}`" for c in df.columns if c != body]
    text = f"CAST(`{body}` AS STRING)"
    parsed = (f"CASE WHEN octet_length({text}) >= {LARGE_BODY} THEN coalesce(try_parse_json({text}), "
              f"raise_error(concat('a body of ', CAST(octet_length({text}) AS STRING), ' bytes is not JSON or too large to decode in its row (see large_bodies)'))) "
              f"ELSE try_parse_json({text}) END")
    return df.selectExpr(*keep, f"{parsed} AS _v")


def _elements(df: DataFrame, body: str) -> DataFrame:
    """Batch bodies → ``_es`` (decoded elements; null for ``null``) and ``parse_error``."""
    d = _variant(df, body).selectExpr("*", "try_variant_get(_v, '$', 'array<variant>') AS _a")
    d = d.selectExpr("*", f"transform(_a, e -> {_decoded_sql('e', tuple(FIELDS))}) AS _es")
    d = materialize(d.selectExpr("* EXCEPT (_v, _a)", "_v IS NULL OR (_a IS NULL AND NOT is_variant_null(_v)) AS _no"))
    return d.selectExpr("* EXCEPT (_no)", "_no OR coalesce(exists(_es, x -> x.bad), false) AS parse_error")


def parse_batches(df: DataFrame, body: str = "body", key: str = "batch_id") -> DataFrame:
    """Batch bodies (a JSON array of updates) → one row per element, in order.

    Output: ``key, pos, id, mtype, delta, value, hash, parse_error``. A body
    that does not decode gives a single row with ``parse_error`` set and null
    ``pos``; ``[]`` and ``null`` give no rows; a ``null`` element gives a row
    of nulls (it then fails validation as an empty name).
    """
    d = _elements(df.select(key, body), body)
    d = d.selectExpr(key, "parse_error", "posexplode_outer(CASE WHEN NOT parse_error THEN _es END) AS (pos, _e)")
    d = d.filter("parse_error OR pos IS NOT NULL")
    return materialize(d.selectExpr(key, "CAST(pos AS INT) AS pos", "_e.id AS id", "_e.mtype AS mtype", "_e.delta AS delta",
                                    "_e.value AS value", "coalesce(_e.hash, '') AS hash", "parse_error"))


def _single(df: DataFrame, body: str, fields: tuple[str, ...]) -> DataFrame:
    keep = [f"`{c}`" for c in df.columns if c != body]
    d = _variant(df, body).selectExpr("*", f"{_decoded_sql('_v', fields)} AS _e", "_v IS NULL AS _no")
    d = materialize(d.selectExpr(*keep, "_e", "_no OR _e.bad AS parse_error"))
    cols = [f"{'coalesce(' if f == 'hash' else ''}CASE WHEN NOT parse_error THEN _e.{FIELDS[f][0]} END"
            f"{', %s)' % sql_str('') if f == 'hash' else ''} AS {FIELDS[f][0]}" for f in fields]
    return d.selectExpr(*keep, *cols, "parse_error")


def parse_singles(df: DataFrame, body: str = "body") -> DataFrame:
    """Single bodies (a JSON object) → ``id, mtype, delta, value, hash,
    parse_error``, other columns kept. ``null`` decodes to an empty update."""
    return _single(df, body, tuple(FIELDS))


def parse_lookups(df: DataFrame, body: str = "body") -> DataFrame:
    """Lookup bodies ``{"id":…, "type":…}`` → ``id, mtype, parse_error`` (the other
    known fields must have their types too)."""
    return _single(df, body, tuple(FIELDS)).drop("delta", "value", "hash")


UPDATE_PATH = r"^/update/([^/]*)/([^/]*)/([^/]*)\z"
VALUE_PATH = r"^/value/([^/]*)/([^/]*)\z"


def parse_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """``/update/{type}/{name}/{value}`` → ``mtype, id, raw_value, routed``;
    an empty segment is legal input, a path of another shape is not routed."""
    r = sql_str(UPDATE_PATH)
    return df.selectExpr("*", f"`{path}` RLIKE {r} AS routed", f"regexp_extract(`{path}`, {r}, 1) AS mtype",
                         f"regexp_extract(`{path}`, {r}, 2) AS id", f"regexp_extract(`{path}`, {r}, 3) AS raw_value")


def parse_lookup_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """``/value/{type}/{name}`` → ``mtype, id, routed``."""
    r = sql_str(VALUE_PATH)
    return df.selectExpr("*", f"`{path}` RLIKE {r} AS routed", f"regexp_extract(`{path}`, {r}, 1) AS mtype",
                         f"regexp_extract(`{path}`, {r}, 2) AS id")


def admit(envelopes: DataFrame, key: str, require_json: bool = True) -> DataFrame:
    """Admission of raw requests, in the order the request passes the checks:
    signature (over the body as received) → gzip → content type.

    Replaces ``body`` by ``json`` (the decoded body text, null when refused) and
    adds ``admit_code`` and ``admit_status`` (400 / 415, null when admitted).
    """
    zipped = "contains(coalesce(content_encoding, ''), 'gzip')"
    # only gzip bodies reach the UDF; the others pass it a null
    d = envelopes.withColumn("_unz", gunzip(F.expr(f"CASE WHEN {zipped} THEN body END")))
    d = d.selectExpr("*", f"{verify_sql('body', key, 'signature')} AS _sig",
                     f"CASE WHEN {zipped} THEN _unz ELSE body END AS _raw")
    code = (f"CASE WHEN _sig = 'bad' THEN '{BAD_SIGNATURE}' "
            f"WHEN {zipped} AND _raw IS NULL THEN '{BAD_GZIP}' ")
    if require_json:
        code += f"WHEN NOT contains(coalesce(content_type, ''), 'application/json') THEN '{BAD_CONTENT_TYPE}' "
    code += "END"
    d = d.selectExpr("*", f"{code} AS admit_code")
    d = d.selectExpr("*", f"CASE WHEN admit_code = '{BAD_CONTENT_TYPE}' THEN 415 "
                          "WHEN admit_code IS NOT NULL THEN 400 END AS admit_status",
                     "CASE WHEN admit_code IS NULL THEN CAST(_raw AS STRING) END AS json")
    return materialize(d.drop("_sig", "_raw", "_unz", "body"))


def decode_batches(df: DataFrame, body: str = "body") -> DataFrame:
    """Batch bodies → one row per body with its decoded, gated items.

    A batch is one request body, so the all-or-nothing rule (the first
    failing element decides, nothing of the batch is applied) is evaluated
    inside the row with array functions: no shuffle, and the body is decoded
    once. Other columns are kept; adds ``parse_error``, ``items`` (array of
    ``pos, id, mtype, delta, value, hash``), ``first_bad_pos``,
    ``reject_code`` (null when the batch is accepted) and ``status``.
    """
    from ..operators.validate import element_code_sql, route_status_sql
    from ..schema import ROUTE_UPDATES_JSON

    d = _elements(df, body)
    items = ("transform(CASE WHEN NOT parse_error THEN coalesce(_es, array()) END, (m, i) -> named_struct('pos', CAST(i AS INT), "
             "'id', m.id, 'mtype', m.mtype, 'delta', m.delta, 'value', m.value, 'hash', coalesce(m.hash, '')))")
    d = d.selectExpr("* EXCEPT (_es)", f"{items} AS items")
    first = (f"try_element_at(filter(transform(items, m -> named_struct('pos', m.pos, 'code', "
             f"{element_code_sql('m.')})), x -> x.code IS NOT NULL), 1)")
    d = d.selectExpr("*", f"{first} AS _first")
    d = d.selectExpr("* EXCEPT (_first)", "CASE WHEN NOT parse_error THEN _first.pos END AS first_bad_pos",
                     f"CASE WHEN parse_error THEN '{PARSE_ERROR}' ELSE _first.code END AS reject_code")
    return materialize(d.selectExpr("*", f"{route_status_sql('reject_code', ROUTE_UPDATES_JSON)} AS status"))


def accepted_rows(decoded: DataFrame, key: str = "batch_id") -> DataFrame:
    """Update rows of the accepted batches (``key, pos, id, mtype, delta,
    value, hash``)."""
    return decoded.filter("reject_code IS NULL").selectExpr(key, "inline(items)")

