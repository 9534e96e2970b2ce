"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` built from the
library's operators over the given tables. Oracles are independent SQL
formulations over the same tables (views named as the parquet files).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def expand(sql: str) -> str:
    """Oracle text with each ``wrap64(x)`` spelled out: x (a HUGEINT) modulo 2^64 as a BIGINT."""
    while (at := sql.find("wrap64(")) >= 0:
        depth, end = 1, at + len("wrap64(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        x = sql[at + len("wrap64("):end - 1]
        sql = (sql[:at] + f"CAST(((({x}) % 18446744073709551616) + 27670116110564327424) % 18446744073709551616"
               f" - 9223372036854775808 AS BIGINT)" + sql[end:])
    return sql


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = expand(oracle)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (queries_core, queries_functions, queries_ingest, queries_misc,  # noqa: F401
                   queries_state, queries_stream, queries_window)
