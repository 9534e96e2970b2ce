"""Property tests: int64 wrap-around arithmetic against a Python model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyho.functions.numbers import wrap_add, wrap_sum_aggs, wrap_sum_result

I64 = st.integers(min_value=-(2**63), max_value=2**63 - 1)
EDGE = st.sampled_from([0, 1, -1, 2**63 - 1, -(2**63), 2**62, -(2**62), 65535, 65536, -65536])


def wrap(x):
    return (x + 2**63) % 2**64 - 2**63


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(I64, EDGE)), min_size=1, max_size=300))
def test_grouped_wrap_sum(spark, rows):
    df = spark.createDataFrame(rows, "g int, d long")
    got = {r.g: r.s for r in df.groupBy("g").agg(*wrap_sum_aggs("d", "x"))
           .select("g", wrap_sum_result("x").alias("s")).collect()}
    want = {}
    for g, d in rows:
        want[g] = wrap(want.get(g, 0) + d)
    assert got == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(I64, EDGE, st.none()), st.one_of(I64, EDGE, st.none())),
                min_size=1, max_size=200))
def test_wrap_add(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.s for r in df.select(wrap_add("a", "b").alias("s")).collect()]
    want = [None if a is None and b is None else wrap((a or 0) + (b or 0)) for a, b in pairs]
    assert got == want
