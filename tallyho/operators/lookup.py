"""Reads against a state table: point lookups, bulk lookups, listing, display.

Lookups are equi-joins on ``(id, mtype)``. No broadcast hint is given: the
state's size is checked by Spark itself, statically from Parquet file sizes
when the state is a persisted snapshot, and at runtime by AQE
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) when it is computed in the
same job. Beyond the threshold the join stays a shuffled sort-merge join, and
AQE splits skewed request keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_gauge, html_escape_sql
from ..schema import (COUNTER, GAUGE, KINDS, NOT_FOUND, ROUTE_VALUE_JSON, ROUTE_VALUE_TEXT,
                      STATE_COLUMNS, UNKNOWN_TYPE)


def first_match(state: DataFrame, at: str = "at") -> DataFrame:
    """One row a key: the first in order of ``at`` (dropped). A snapshot file may hold a key
    more than once, and a lookup takes the first one in the file."""
    if at not in state.columns:
        return state
    rest = [c for c in state.columns if c not in ("id", "mtype", at)]
    return state.groupBy("id", "mtype").agg(F.min_by(F.struct(*rest), at).alias("_m")).select("id", "mtype", "_m.*")


def lookup(state: DataFrame, id_: str, mtype: str) -> DataFrame:
    """The row of one key, no row for a missing key or an unknown kind
    (``lookup_outcome`` tells them apart). The filter reaches the Parquet scan when
    ``state`` is a snapshot: row groups are skipped by min/max and Bloom filter. With a
    column ``at`` (a place in file order) the first of several rows is taken."""
    if mtype not in KINDS:
        return state.drop("at").limit(0)
    return first_match(state.filter((F.col("id") == F.lit(id_)) & (F.col("mtype") == F.lit(mtype))))


def lookup_outcome(state: DataFrame, id_: str, mtype: str) -> DataFrame:
    """One row for one key: ``outcome`` (``ok``, ``not_found``, ``unknown_metric_type``,
    ``nil_number``), numbers, text and statuses, as ``lookup_bulk`` gives them.
    Only the key's row is read from a snapshot."""
    asked = state.sparkSession.range(1).select(F.col("id").alias("req_id"), F.lit(id_).alias("id"), F.lit(mtype).alias("mtype"))
    return lookup_bulk(asked, lookup(state, id_, mtype)).drop("req_id")


def with_value_text(state: DataFrame) -> DataFrame:
    """Adds ``value_text``: the number of the row's kind as text, '' if missing."""
    d = state.withColumn("_gt", format_gauge("value"))
    keep = [f"`{c}`" for c in state.columns if c != "value_text"]
    return d.selectExpr(*keep, f"coalesce(CASE WHEN mtype = '{GAUGE}' THEN _gt "
                               f"WHEN mtype = '{COUNTER}' THEN CAST(delta AS STRING) END, '') AS value_text")


def display_rows(state: DataFrame) -> DataFrame:
    """State → ``(id, mtype, name, value_text)``; a missing number gives ''."""
    return with_value_text(state).selectExpr("id", "mtype", "id AS name", "value_text")


def report_lines(state: DataFrame) -> DataFrame:
    """One ``<p>name:\\tvalue</p>`` line per metric, HTML-escaped."""
    line = html_escape_sql("concat(name, ':\\t', value_text)")
    return display_rows(state).selectExpr("id", "mtype", f"concat('<p>', {line}, '</p>') AS line")


def all_rows(state: DataFrame) -> DataFrame:
    """All gauges and all counters, as one bag (order unspecified): the state as it is."""
    return state.select(*STATE_COLUMNS)


_KINDS_SQL = "(" + ", ".join(f"'{k}'" for k in KINDS) + ")"


def lookup_status_sql(route: str) -> str:
    """SQL: HTTP status of a lookup (columns ``outcome``, ``id``, ``mtype``)."""
    if route == ROUTE_VALUE_TEXT:
        return (f"CASE WHEN outcome = '{NOT_FOUND}' THEN 404 WHEN outcome = '{UNKNOWN_TYPE}' THEN 400 "
                "WHEN outcome = 'nil_number' THEN 500 ELSE 200 END")
    # JSON body route: empty id or type is refused first; no nil check
    return (f"CASE WHEN coalesce(id, '') = '' OR coalesce(mtype, '') = '' THEN 400 "
            f"WHEN outcome = '{NOT_FOUND}' THEN 404 WHEN outcome = '{UNKNOWN_TYPE}' THEN 400 ELSE 200 END")


def lookup_bulk(requests: DataFrame, state: DataFrame, text_on: str = "state") -> DataFrame:
    """Many ``(req_id, id, mtype)`` requests → outcome, number, text, statuses, one row each.

    Outcomes: ``ok``, ``not_found``, ``unknown_metric_type``, ``nil_number``
    (row present but its number missing). Of a key with several rows the first
    in order of the state's column ``at`` counts. The text form is formatted on the
    state (one row per key) before the join, or (``text_on="requests"``) after it:
    for few requests of a large state, and for a bucketed one, whose rows then
    stay where they are.
    """
    if text_on not in ("state", "requests"):
        raise ValueError(f"text_on must be 'state' or 'requests', not {text_on!r}")
    state = first_match(state)
    if text_on == "state":
        shown = with_value_text(state).selectExpr("id", "mtype", "delta", "value", "value_text", "true AS _hit")
        j = requests.join(shown, ["id", "mtype"], "left")
    else:
        j = requests.join(state.selectExpr("id", "mtype", "delta", "value", "true AS _hit"), ["id", "mtype"], "left")
        j = with_value_text(j)
    outcome = (f"CASE WHEN mtype IS NULL OR mtype NOT IN {_KINDS_SQL} THEN '{UNKNOWN_TYPE}' "
               f"WHEN _hit IS NULL THEN '{NOT_FOUND}' "
               f"WHEN CASE WHEN mtype = '{COUNTER}' THEN delta IS NULL ELSE value IS NULL END THEN 'nil_number' "
               "ELSE 'ok' END")
    j = j.selectExpr("*", f"{outcome} AS outcome")
    return j.selectExpr(
        "req_id", "id", "mtype", "outcome",
        "CASE WHEN outcome = 'ok' THEN value_text END AS value_text",
        "CASE WHEN _hit IS NOT NULL THEN delta END AS delta",
        "CASE WHEN _hit IS NOT NULL THEN value END AS value",
        f"{lookup_status_sql(ROUTE_VALUE_TEXT)} AS status_text",
        f"{lookup_status_sql(ROUTE_VALUE_JSON)} AS status_json")


def lookup_status(outcome, id_, mtype, route: str):
    """HTTP status of a lookup on the text route or the JSON route (columns
    named ``outcome``, ``id``, ``mtype``)."""
    return F.expr(lookup_status_sql(route))
