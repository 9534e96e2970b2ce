"""Lookups, text forms and report lines."""

from conftest import rows_of
from tallyho.operators import lookup as lk
from tallyho.schema import METRIC


def state(spark):
    return spark.createDataFrame([("myCounter", "counter", 42, None, ""), ("myGauge", "gauge", None, 3.14, ""),
                                  ("nilGauge", "gauge", None, None, "")], METRIC)


def test_lookup_bulk_outcomes(spark):
    req = spark.createDataFrame([(1, "myCounter", "counter"), (2, "myGauge", "gauge"), (3, "unknown", "counter"),
                                 (4, "myCounter", "wrong"), (5, "nilGauge", "gauge"), (6, "", "gauge")],
                                "req_id long, id string, mtype string")
    got = rows_of(lk.lookup_bulk(req, state(spark)), "req_id", "outcome", "value_text", "status_text", "status_json")
    assert got == [(1, "ok", "42", 200, 200), (2, "ok", "3.14", 200, 200), (3, "not_found", None, 404, 404),
                   (4, "unknown_metric_type", None, 400, 400), (5, "nil_number", None, 500, 200),
                   (6, "not_found", None, 404, 400)]


def test_lookup_point(spark):
    assert rows_of(lk.lookup(state(spark), "myCounter", "counter"), "delta") == [(42,)]
    assert lk.lookup(state(spark), "myCounter", "unknown").count() == 0


def test_gauge_text_is_plain_shortest(spark):
    vals = [100.0, 0.1, 1e21, 1e-7, 3.14, 123456789.125, -2.5, float("inf")]
    df = spark.createDataFrame([(f"g{i}", "gauge", None, v, "") for i, v in enumerate(vals)], METRIC)
    got = {r.name: r.value_text for r in lk.display_rows(df).collect()}
    assert [got[f"g{i}"] for i in range(len(vals))] == [
        "100", "0.1", "1000000000000000000000", "0.0000001", "3.14", "123456789.125", "-2.5", "+Inf"]


def test_report_lines_escape(spark):
    df = spark.createDataFrame([("a<b>&'\"", "counter", 7, None, ""), ("n", "gauge", None, None, "")], METRIC)
    got = rows_of(lk.report_lines(df), "line")
    assert got == [("<p>a&lt;b&gt;&amp;&#39;&#34;:\t7</p>",), ("<p>n:\t</p>",)]


def test_lookup_outcome_tells_missing_from_unknown(spark):
    asked = [("myCounter", "counter"), ("nope", "counter"), ("myCounter", "wrong"), ("nilGauge", "gauge")]
    got = [lk.lookup_outcome(state(spark), *a).collect() for a in asked]
    assert [len(r) for r in got] == [1, 1, 1, 1]
    assert [(r[0].outcome, r[0].status_text) for r in got] == [
        ("ok", 200), ("not_found", 404), ("unknown_metric_type", 400), ("nil_number", 500)]
