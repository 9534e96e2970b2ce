"""Reshaping host samples into metric update rows.

A sample is a wide snapshot (maps or named columns). Turning it into long
rows is a per-row generator (``explode`` / ``posexplode`` / ``unpivot``): a
projection with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import COUNTER, GAUGE

# The runtime gauge names a sampling agent reports, in its order.
RUNTIME_GAUGES = (
    "Alloc", "BuckHashSys", "Frees", "GCCPUFraction", "GCSys", "HeapAlloc", "HeapIdle", "HeapInuse",
    "HeapObjects", "HeapReleased", "HeapSys", "LastGC", "Lookups", "MCacheInuse", "MCacheSys",
    "MSpanInuse", "MSpanSys", "Mallocs", "NextGC", "NumForcedGC", "NumGC", "OtherSys",
    "PauseTotalNs", "StackInuse", "StackSys", "Sys", "TotalAlloc", "RandomValue",
)
# The counter a sampling agent reports, and the CPU gauge prefix.
POLL_COUNT = "PollCount"
CPU_PREFIX = "CPUutilization"


def sample_to_rows(samples: DataFrame, keys=("seq",), gauge: str = "gauge", counter: str = "counter",
                   indexed: str | None = None, prefix: str = CPU_PREFIX) -> DataFrame:
    """``(keys…, gauge MAP<STRING,DOUBLE>, counter MAP<STRING,BIGINT>)`` →
    update rows: gauges carry only ``value``, counters only ``delta``.
    ``indexed`` names an array whose elements become gauges ``{prefix}1``, …
    One generator over one scan: all rows of a sample are one array."""
    row = "named_struct('id', {0}, 'mtype', '{1}', 'delta', {2}, 'value', {3})"
    parts = [f"transform(map_entries({gauge}), e -> {row.format('e.key', GAUGE, 'CAST(NULL AS BIGINT)', 'e.value')})",
             f"transform(map_entries({counter}), e -> {row.format('e.key', COUNTER, 'e.value', 'CAST(NULL AS DOUBLE)')})"]
    if indexed:
        name = f"concat('{prefix}', CAST(i + 1 AS STRING))"
        parts.append(f"transform({indexed}, (v, i) -> {row.format(name, GAUGE, 'CAST(NULL AS BIGINT)', 'CAST(v AS DOUBLE)')})")
    rows = ", ".join(f"coalesce({p}, array())" for p in parts)
    return samples.selectExpr(*keys, f"inline(concat({rows}))")


def indexed_gauges(df: DataFrame, array_col: str, prefix: str = CPU_PREFIX, keys=("seq",)) -> DataFrame:
    """Array of per-core numbers → gauges ``{prefix}1``, ``{prefix}2``, …"""
    k = list(keys)
    return df.selectExpr(*k, f"posexplode({array_col}) AS (pos, value)").selectExpr(
        *k, f"concat('{prefix}', CAST(pos + 1 AS STRING)) AS id", f"'{GAUGE}' AS mtype",
        "CAST(NULL AS BIGINT) AS delta", "CAST(value AS DOUBLE) AS value")


def gauges_from_columns(df: DataFrame, names=RUNTIME_GAUGES, keys=("seq",)) -> DataFrame:
    """Named numeric columns → one gauge row per column, cast to double."""
    k = list(keys)
    wide = df.selectExpr(*k, *[f"CAST({n} AS DOUBLE) AS {n}" for n in names])
    long = wide.unpivot(k, list(names), "id", "value")
    return long.selectExpr(*k, "id", f"'{GAUGE}' AS mtype", "CAST(NULL AS BIGINT) AS delta", "value")


def poll_counts(samples: DataFrame, source: str = "source") -> DataFrame:
    """Samples taken per source (the agent's poll counter)."""
    return samples.groupBy(source).agg(F.expr("count(1) AS poll_count"))


def poll_counts_running(samples: DataFrame, source: str = "source", seq: str = "seq",
                        range_size: int | None = None) -> DataFrame:
    """The poll counter as the agent reports it after each sample: the
    running count per source (a busy source is split by seq range, not held
    in one task)."""
    from .window import running_counts
    return running_counts(samples.selectExpr(f"{seq} AS seq", f"CAST({source} AS STRING) AS {source}"), source, range_size)
