"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame) -> DataFrame:
    """Evaluate ``df``'s projection once per row, whatever filters follow.

    Catalyst pushes a later filter below a projection by copying the
    projected expressions into the filter condition. For cheap columns that
    is a win; for decoded payloads (JSON parsing, regex validation, UDFs) it
    runs the decoding twice or more per row. A one-element generator is a
    boundary filters on its output cannot cross, and costs a row copy.
    """
    return df.selectExpr("inline(array(struct(*)))")

