"""Shared helpers: evaluate-once boundary."""

from conftest import rows_of
from tallyho.operators.common import materialize


def test_materialize_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "k long, s string, d double")
    m = materialize(df)
    assert m.columns == df.columns
    assert rows_of(m) == rows_of(df)
    # a filter on the output stays above the generator
    plan = m.filter("k > 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
