"""Batch bodies of any size, element by element.

A VARIANT holds at most 128 MiB, and a body decoded in its row holds all its
items there. For larger bodies the array is cut into its elements where the body
is (inflated piece by piece if it is gzip, so a small body that unpacks to a huge
one needs the memory of one element), each element is decoded as a row of its
own, and the batch's outcome is decided from the rows that fail: the same rules
as ``payloads.decode_batches``, over many tasks.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.elements import Broken, decoded, elements, inflate, pieces_of
from ..operators.common import materialize
from ..operators.validate import element_code_sql, route_status_sql
from ..schema import PARSE_ERROR, ROUTE_UPDATES_JSON
from ..session import scratch_path
from .payloads import FIELDS, _decoded_sql

# Travels to the Python workers by value, like the scanners.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

#: Elements, and characters of elements, that go on together.
ROWS, CHARS = 10_000, 4 << 20


def body_elements(df: DataFrame, body: str, key: str, zipped: str | None = None) -> DataFrame:
    """(key, pos, element) for every element of the bodies; a body that breaks off, or is no
    array (or, where ``zipped``, no gzip), ends with a row without ``pos``."""
    schema = df.select(F.col(key)).schema.add("pos", "integer").add("element", "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind = b.schema.field(0).type
            keys, pos, texts, chars = [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(pos, pa.int32()), pa.array(texts, pa.string())], names)

            for i in range(b.num_rows):
                k, data, gz = b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py()
                n = 0
                try:
                    pieces = inflate(data or b"") if gz else pieces_of(data or b"")
                    for e in elements(decoded(pieces)):
                        keys.append(k), pos.append(n), texts.append(e)
                        n, chars = n + 1, chars + len(e)
                        if len(keys) >= ROWS or chars >= CHARS:
                            yield out()
                            keys, pos, texts, chars = [], [], [], 0
                except Broken:
                    keys.append(k), pos.append(None), texts.append(None)
            yield out()

    bodies = df.selectExpr(f"`{key}`", f"CAST(`{body}` AS BINARY) AS _body", f"{zipped or 'false'} AS _zipped")
    return bodies.mapInArrow(run, schema)


def decode_large_batches(df: DataFrame, body: str = "body", key: str = "batch_id", zipped: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, outcomes) of bodies of any size. Accepted rows are ``key, pos, id, mtype,
    delta, value, hash``; outcomes ``key, first_bad_pos, reject_code, status``, one a body (``key``
    names a body). ``zipped`` is SQL that tells which bodies are gzip.

    The decoded rows are written to the shared folder: the bodies are read once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "large-bodies")
    d = body_elements(df, body, key, zipped).selectExpr(f"`{key}` AS k", "pos", "try_parse_json(element) AS _v")
    d = materialize(d.selectExpr("k", "pos", "_v IS NULL AS _no", f"{_decoded_sql('_v', tuple(FIELDS))} AS e"))
    d = d.selectExpr("k", "pos", "e.id", "e.mtype", "e.delta", "e.value", "coalesce(e.hash, '') AS hash", "_no OR e.bad AS parse_error")
    d.write.parquet(path)
    rows = spark.read.schema(d.schema).parquet(path)
    # a body that does not decode is refused as a whole, before any rule about its rows
    code = f"CASE WHEN parse_error THEN '{PARSE_ERROR}' ELSE {element_code_sql('')} END"
    bad = rows.selectExpr("k", "pos", "parse_error", f"{code} AS code").where("code IS NOT NULL").groupBy("k").agg(
        F.expr("max(parse_error) AS broken"), F.expr("min(pos) FILTER (WHERE NOT parse_error) AS p"),
        F.expr("min_by(code, pos) FILTER (WHERE NOT parse_error) AS c"))
    bad = bad.selectExpr("k", "CASE WHEN NOT broken THEN p END AS first_bad_pos",
                         f"CASE WHEN broken THEN '{PARSE_ERROR}' ELSE c END AS reject_code")
    accepted = rows.join(bad, "k", "left_anti").selectExpr(f"k AS `{key}`", "pos", "id", "mtype", "delta", "value", "hash")
    outcomes = df.selectExpr(f"`{key}` AS k").join(bad, "k", "left")
    outcomes = outcomes.selectExpr(f"k AS `{key}`", "first_bad_pos", "reject_code",
                                   f"{route_status_sql('reject_code', ROUTE_UPDATES_JSON)} AS status")
    return accepted, outcomes
