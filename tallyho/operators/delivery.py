"""Delivery attempts of reports → one outcome per report.

A sender tries again while the failure is retriable (a network error or an
HTTP status >= 500); only status 200 is success. How often it tries is its own
setting: the log's attempts are taken as they are, however many. The roll-up
keeps the attempts up to the first success or final failure (a cancelled send
is one) and renders the retry message listing the failed ones.

Attempts are first reduced to one row per (report, attempt number) with a
partial aggregate, then grouped per report, whose list the message holds.
``max_sends``, a sender's limit, only labels the reports that went beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import NETWORK_TEXT, RETRIABLE_STATUS_TEXT, STATUS_TEXT


def _success_sql(kind: str = "kind", status: str = "http_status") -> str:
    return f"({kind} = 'http' AND {status} = 200)"


def _retriable_sql(kind: str = "kind", status: str = "http_status") -> str:
    return f"({kind} = 'network' OR ({kind} = 'http' AND {status} >= 500))"


def _error_text_sql(kind: str = "kind", status: str = "http_status", error: str = "error") -> str:
    """How a failed attempt prints."""
    return (f"CASE WHEN {kind} = 'network' THEN concat('{NETWORK_TEXT}: ', coalesce({error}, '')) "
            f"WHEN {kind} = 'http' AND {status} >= 500 THEN concat('{RETRIABLE_STATUS_TEXT}: {STATUS_TEXT} ', CAST({status} AS STRING)) "
            f"WHEN {kind} = 'http' AND {status} IS NOT NULL THEN concat('{STATUS_TEXT} ', CAST({status} AS STRING)) "
            f"ELSE coalesce({error}, {kind}, '') END")


def is_success(kind: str = "kind", status: str = "http_status") -> Column:
    """Only HTTP 200 is a success."""
    return F.expr(_success_sql(kind, status))


def is_retriable(kind: str = "kind", status: str = "http_status") -> Column:
    """A network error or an HTTP status >= 500."""
    return F.expr(_retriable_sql(kind, status))


def delivery_rollup(attempts: DataFrame, max_sends: int | None = None) -> DataFrame:
    """``(report_id, attempt_no, kind, http_status, error)`` → ``report_id,
    succeeded, sends, failed_attempts, message`` (message null when the
    first send succeeded), and ``over_limit`` when ``max_sends`` is given."""
    a = attempts.selectExpr(
        "report_id", "attempt_no", f"coalesce({_success_sql()}, false) AS ok",
        f"coalesce({_retriable_sql()}, false) AS retriable", f"{_error_text_sql()} AS text")
    # one outcome per attempt number (duplicates, if any, resolve the same way everywhere)
    a = (a.groupBy("report_id", "attempt_no").agg(F.expr("min(struct(ok, retriable, text)) AS o"))
          .selectExpr("report_id", "attempt_no", "o.ok AS ok", "o.retriable AS retriable", "o.text AS text"))
    g = a.groupBy("report_id").agg(
        F.expr("min(CASE WHEN ok OR NOT retriable THEN attempt_no END) AS stop_at"),
        F.expr("array_sort(collect_list(struct(attempt_no, ok, text))) AS atts"))
    g = g.selectExpr("report_id", "filter(atts, x -> coalesce(x.attempt_no <= stop_at, true)) AS sent")
    failed = "filter(sent, x -> NOT x.ok)"
    succeeded = "exists(sent, x -> x.ok)"
    listing = f"array_join(transform({failed}, (x, i) -> concat('attempt ', CAST(i + 1 AS STRING), ': ', x.text)), '; ')"
    message = (f"concat('retry ', CASE WHEN {succeeded} THEN 'succeeded' ELSE 'failed' END, ' after ', "
               f"CAST(size({failed}) AS STRING), ' attempts: ', {listing})")
    return g.selectExpr(
        "report_id", f"{succeeded} AS succeeded", "size(sent) AS sends", f"size({failed}) AS failed_attempts",
        f"CASE WHEN sent[0].ok AND size(sent) = 1 THEN CAST(NULL AS STRING) ELSE {message} END AS message",
        *([] if max_sends is None else [f"size(sent) > {int(max_sends)} AS over_limit"]))
