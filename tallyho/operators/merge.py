"""Snapshot maintenance: upsert (insert-or-replace) and partial patch.

Both are expressed as keyed joins of the old snapshot with the new rows,
computed into a new DataFrame; the sinks write it as a new version, so a
snapshot being read is never overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import COUNTER, GAUGE

KEY = ["id", "mtype"]


def upsert_snapshot(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Insert-or-replace on ``(id, mtype)``.

    The last row per key wins; ``delta`` and ``value`` are both replaced (no
    adding: the state already holds totals); keys absent from ``new`` stay; the
    stored ``hash`` is kept on conflict and new rows get an empty hash, since
    the table write never carries one. An empty ``new`` leaves ``old`` as is.
    """
    n = new.groupBy(*KEY).agg(F.expr(f"max_by(delta, {seq}) AS delta"), F.expr(f"max_by(value, {seq}) AS value"),
                              F.expr("true AS _new"))
    o = old.selectExpr(*KEY, "delta AS o_delta", "value AS o_value", "coalesce(hash, '') AS o_hash")
    return o.join(n, KEY, "full").selectExpr(
        *KEY, "CASE WHEN _new THEN delta ELSE o_delta END AS delta",
        "CASE WHEN _new THEN value ELSE o_value END AS value", "coalesce(o_hash, '') AS hash")


def patch_snapshot(old: DataFrame, patches: DataFrame, seq: str = "seq") -> DataFrame:
    """Apply patch rows one by one, the way a single-row file save does.

    For a key already in the snapshot, only the number of its kind (``delta``
    for counters, ``value`` for gauges) and the ``hash`` change, on every row
    with that key. A key not yet there is appended whole by its first patch,
    and later patches of the same key then change only the kind's number and
    the hash.
    """
    p = patches.selectExpr(*KEY, seq, "delta", "value", "coalesce(hash, '') AS hash")
    agg = p.groupBy(*KEY).agg(*[F.expr(e) for e in (
        f"min_by(delta, {seq}) AS first_delta", f"min_by(value, {seq}) AS first_value",
        f"max_by(delta, {seq}) AS last_delta", f"max_by(value, {seq}) AS last_value",
        f"max_by(hash, {seq}) AS last_hash")])
    o = old.selectExpr(*KEY, "delta AS o_delta", "value AS o_value", "hash AS o_hash", "true AS _old")
    # one full outer join: patched old rows, untouched old rows, appended keys
    c, g = f"mtype = '{COUNTER}'", f"mtype = '{GAUGE}'"
    hit, was = "last_hash IS NOT NULL", "_old IS NOT NULL"
    return o.join(agg, KEY, "full").selectExpr(
        *KEY,
        f"CASE WHEN {was} AND {hit} AND {c} THEN last_delta WHEN {was} THEN o_delta "
        f"WHEN {c} THEN last_delta ELSE first_delta END AS delta",
        f"CASE WHEN {was} AND {hit} AND {g} THEN last_value WHEN {was} THEN o_value "
        f"WHEN {g} THEN last_value ELSE first_value END AS value",
        f"CASE WHEN {hit} THEN last_hash ELSE o_hash END AS hash")


def append_missing(old: DataFrame, rows: DataFrame) -> DataFrame:
    """Old rows, plus the rows whose key the old table lacks (one full outer
    join on the key; ``rows`` is unique on the key)."""
    vals = ["delta", "value", "hash"]
    o = old.selectExpr(*KEY, *[f"{c} AS o_{c}" for c in vals], "true AS _old")
    n = rows.selectExpr(*KEY, *[f"{c} AS n_{c}" for c in vals])
    return o.join(n, KEY, "full").selectExpr(
        *KEY, *[f"CASE WHEN _old IS NOT NULL THEN o_{c} ELSE n_{c} END AS {c}" for c in vals])
