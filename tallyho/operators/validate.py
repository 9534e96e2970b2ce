"""Validation: per-row reject codes, batch gating, prefix apply, statuses.

Rules are ordered ``when`` chains (first failing rule wins), evaluated inside
the scan's codegen stage. Batch decisions never filter row by row: a batch's
fate is decided from its failing rows only (a partial aggregate over the
few bad rows), then applied to all rows with an anti/left join whose small
side Spark can broadcast once it has seen its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import counter_sql, gauge_sql
from ..operators.common import materialize
from ..operators.fold import store_check
from ..schema import (COUNTER, EMPTY_NAME, EMPTY_TYPE, EMPTY_VALUE, GAUGE, KINDS, NIL_DELTA,
                      NIL_VALUE, PARSE_ERROR, ROUTE_UPDATE_JSON, ROUTE_UPDATE_TEXT,
                      ROUTE_UPDATES_JSON, UNKNOWN_TYPE, UNKNOWN_VALUE)

# Rules are written as SQL CASE text: one projection is one call into the
# JVM, however many rules it holds.


def _e(x: str) -> str:
    return f"coalesce({x}, '') = ''"


_KINDS_SQL = "(" + ", ".join(f"'{k}'" for k in KINDS) + ")"


def text_code_sql(raw: str = "raw_value") -> str:
    return (f"CASE WHEN {_e('id')} THEN '{EMPTY_NAME}' "
            f"WHEN {_e('mtype')} THEN '{EMPTY_TYPE}' "
            f"WHEN mtype NOT IN {_KINDS_SQL} THEN '{UNKNOWN_TYPE}' "
            f"WHEN {_e(raw)} THEN '{EMPTY_VALUE}' "
            f"WHEN mtype = '{COUNTER}' AND ({counter_sql(raw)}) IS NULL THEN '{UNKNOWN_VALUE}' "
            f"WHEN mtype = '{GAUGE}' AND ({gauge_sql(raw)}) IS NULL THEN '{UNKNOWN_VALUE}' END")


def validate_text(df: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Text updates ``(mtype, id, raw_value)`` → parsed ``delta``/``value`` +
    ``reject_code`` (null when accepted). Order: empty name, empty type,
    unknown type, empty value, unparsable value."""
    d = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in ("delta", "value", "reject_code")],
                      f"{text_code_sql(raw)} AS reject_code")
    return materialize(d.selectExpr(
        "*",
        f"CASE WHEN reject_code IS NULL AND mtype = '{COUNTER}' THEN {counter_sql(raw)} END AS delta",
        f"CASE WHEN reject_code IS NULL AND mtype = '{GAUGE}' THEN {gauge_sql(raw)} END AS value"))


def element_code_sql(p: str = "") -> str:
    """Batch-route rule for one metric (columns, or fields of struct ``p``):
    empty name, unknown (or empty) type, counter without delta, gauge
    without value. A null array element fails as an empty name."""
    return (f"CASE WHEN {_e(p + 'id')} THEN '{EMPTY_NAME}' "
            f"WHEN NOT coalesce({p}mtype IN {_KINDS_SQL}, false) THEN '{UNKNOWN_TYPE}' "
            f"WHEN {p}mtype = '{COUNTER}' AND {p}delta IS NULL THEN '{EMPTY_VALUE}' "
            f"WHEN {p}mtype = '{GAUGE}' AND {p}value IS NULL THEN '{EMPTY_VALUE}' END")


def validate_rows(df: DataFrame) -> DataFrame:
    """Batch-route rule per row (see ``element_code_sql``)."""
    return df.selectExpr("*", f"{element_code_sql()} AS reject_code")


def validate_single(df: DataFrame) -> DataFrame:
    """Single JSON update rule: the kind decides which number must be there
    (400 otherwise, also for any other kind); an empty id then fails in the
    service (500). The stored row keeps only the kind's number and no hash."""
    code = (f"CASE WHEN mtype = '{COUNTER}' AND delta IS NULL THEN '{NIL_DELTA}' "
            f"WHEN mtype = '{GAUGE}' AND value IS NULL THEN '{NIL_VALUE}' "
            f"WHEN NOT coalesce(mtype IN {_KINDS_SQL}, false) THEN '{UNKNOWN_TYPE}' "
            f"WHEN {_e('id')} THEN '{EMPTY_NAME}' END")
    out = df.selectExpr("*", f"{code} AS reject_code")
    return out.selectExpr("*", f"{route_status_sql('reject_code', ROUTE_UPDATE_JSON)} AS status")


def stored_single(validated: DataFrame) -> DataFrame:
    """Rows a single JSON update stores: only the kind's number, empty hash."""
    return validated.filter("reject_code IS NULL").selectExpr(
        "seq", "id", "mtype",
        f"CASE WHEN mtype = '{COUNTER}' THEN delta END AS delta",
        f"CASE WHEN mtype = '{GAUGE}' THEN value END AS value",
        "'' AS hash")


def single_echo(validated: DataFrame) -> DataFrame:
    """What an accepted single update echoes: the row as submitted."""
    return validated.filter("reject_code IS NULL").select("seq", "id", "mtype", "delta", "value", "hash")


def batch_gate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing per batch: the first failing ``pos`` decides.

    ``rows`` carry ``batch_id``, ``pos`` and ``reject_code``. Returns
    ``(accepted_rows, rejected_batches)``; rejected batches list the first
    failing position, its code and the status of the batch route.
    """
    bad = rows.filter("reject_code IS NOT NULL")
    rejected = bad.groupBy("batch_id").agg(
        F.expr("min(pos) AS first_bad_pos"), F.expr("min_by(reject_code, pos) AS reject_code"),
    ).selectExpr("*", f"{route_status_sql('reject_code', ROUTE_UPDATES_JSON)} AS status")
    accepted = rows.join(rejected.select("batch_id"), "batch_id", "left_anti")
    return accepted, rejected


def prefix_apply(rows: DataFrame) -> DataFrame:
    """Rows a store applies before the first row it refuses (store rules),
    per batch; later rows of that batch are not applied."""
    checked = store_check(rows)
    first_bad = (checked.filter("reject_code IS NOT NULL")
                 .groupBy("batch_id").agg(F.expr("min(pos) AS _first_bad")))
    kept = checked.join(first_bad, "batch_id", "left").filter(
        "_first_bad IS NULL OR pos < _first_bad")
    return kept.drop("_first_bad", "reject_code")


def route_status_sql(code: str, route: str) -> str:
    """SQL: HTTP status of an update outcome (null code = accepted) per route."""
    if route == ROUTE_UPDATE_TEXT:
        return f"CASE WHEN {code} IS NULL THEN 200 WHEN {code} = '{EMPTY_NAME}' THEN 404 ELSE 400 END"
    if route == ROUTE_UPDATE_JSON:
        # decode error and missing number/unknown kind: 400; service errors: 500
        bad = ", ".join(f"'{c}'" for c in (PARSE_ERROR, NIL_DELTA, NIL_VALUE, UNKNOWN_TYPE))
        return f"CASE WHEN {code} IS NULL THEN 200 WHEN {code} IN ({bad}) THEN 400 ELSE 500 END"
    if route == ROUTE_UPDATES_JSON:
        bad = ", ".join(f"'{c}'" for c in (PARSE_ERROR, EMPTY_NAME, UNKNOWN_TYPE, EMPTY_VALUE))
        return f"CASE WHEN {code} IS NULL THEN 200 WHEN {code} IN ({bad}) THEN 400 ELSE 500 END"
    raise ValueError(f"unknown route {route}")


def route_status(code, route: str):
    """HTTP status of an update outcome (null code = accepted) per route."""
    if not isinstance(code, str):
        raise TypeError("route_status takes the code column's name")
    return F.expr(route_status_sql(code, route))
