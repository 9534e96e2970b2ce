"""Rows as request bodies of bounded size.

A body is a JSON array of at most ``max_bytes`` bytes. Rows are put in order of
their keys and cut where the running total of their sizes crosses a step. The
running total has two levels: the rows are range-partitioned, numbered and cut
into blocks; block totals (one row a block) give where each block starts, and
only the rows of a block are summed along. So neither a group nor a task ever
holds more than a block's sizes or one body's rows, however large the state is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of a body, by default.
MAX_BYTES = 1 << 20
#: Rows of one block of the running total.
BLOCK = 4096
#: A row beyond this share of a body is a body of its own.
ALONE = 16


def cut_bodies(rows: DataFrame, group: str, order: str, json: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(group, first, n, body): JSON texts as arrays of at most ``max_bytes`` bytes, in ``order``
    within each; ``first`` is the order's least value in a body.

    A row larger than a ``ALONE``-th of that is sent alone (it alone may be larger than a
    body); the others are cut every ``max_bytes`` less one such row.
    """
    spark = rows.sparkSession
    small = max_bytes // ALONE
    step = max_bytes - small - 1
    d = rows.selectExpr(f"`{group}` AS g", f"`{order}` AS o", f"`{json}` AS j", f"octet_length(`{json}`) + 1 AS size")
    d = d.selectExpr("*", f"size > {small} AS alone").repartitionByRange("g", "o").sortWithinPartitions("g", "o")
    path = scratch_path(spark, "rows-in-order")  # read twice: the ranges are sampled once
    d.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    d = spark.read.parquet(path).withColumn("block", F.expr(f"at DIV {BLOCK}"))
    sized = "CASE WHEN alone THEN 0 ELSE size END"
    totals = d.groupBy("g", "block").agg(F.expr(f"sum({sized}) AS total"))
    starts = totals.selectExpr("g", "block", "coalesce(sum(total) OVER (PARTITION BY g ORDER BY block "
                               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start")
    d = d.selectExpr("*", f"sum({sized}) OVER (PARTITION BY g, block ORDER BY at "
                          f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {sized} AS before")
    d = d.join(starts, ["g", "block"]).selectExpr("g", "o", "j", "at", f"CASE WHEN alone THEN at ELSE (start + before) DIV {step} END AS cut", "alone")
    out = d.groupBy("g", "alone", "cut").agg(F.expr("min(o) AS first"), F.expr("count(1) AS n"),
                                             F.expr("array_sort(collect_list(struct(at, j))) AS _rows"))
    return out.selectExpr(f"g AS `{group}`", "first", "n", "concat('[', array_join(transform(_rows, x -> x.j), ','), ']') AS body")
