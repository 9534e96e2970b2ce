"""Validation order, number parsing, batch gate, prefix apply, statuses."""

from pyspark.sql import functions as F

from conftest import rows_of
from tallyho.operators import validate as va
from tallyho.schema import ROUTE_UPDATE_TEXT


def text(spark, rows):
    df = spark.createDataFrame(rows, "mtype string, id string, raw_value string")
    v = va.validate_text(df)
    return v.withColumn("status", va.route_status("reject_code", ROUTE_UPDATE_TEXT))


def test_text_cases(spark):
    cases = [
        ("counter", "testCounter", "527", None, 200),
        ("gauge", "testCounter", "123.456", None, 200),
        ("wrong", "testCounter", "527", "unknown_metric_type", 400),
        ("counter", "", "527", "empty_metric_name", 404),
        ("gauge", "", "123.456", "empty_metric_name", 404),
        ("counter", "testCounter", "123.456", "unknown_metric_value", 400),
        ("gauge", "testCounter", "abc", "unknown_metric_value", 400),
        ("", "x", "1", "empty_metric_type", 400),
        ("counter", "x", "", "empty_metric_value", 400),
    ]
    got = text(spark, [c[:3] for c in cases]).collect()
    assert sorted((r.mtype, r.id, r.raw_value, r.reject_code, r.status) for r in got) == sorted(cases)


def test_number_parsing(spark):
    ints = {"42": 42, "-7": -7, "abc": None, "3.14": None, " 1": None, "1d": None,
            "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "12\n": None}
    floats = {"3.14": 3.14, "42": 42.0, "-1.5": -1.5, "abc": None, "1e400": None, "1d": None,
              " 1": None, "1.5\n": None, "inf\n": None, "1e-3": 0.001, "Inf": float("inf"), "-infinity": float("-inf")}
    c = text(spark, [("counter", "x", s) for s in ints])
    assert {r.raw_value: r.delta for r in c.collect()} == ints
    g = text(spark, [("gauge", "x", s) for s in floats])
    assert {r.raw_value: r.value for r in g.collect()} == floats
    nan = text(spark, [("gauge", "x", "NaN")]).collect()[0]
    assert nan.reject_code is None and nan.value != nan.value


def test_batch_gate_first_bad_position_decides(updates):
    u = updates([dict(seq=1, batch_id=1, pos=0, id="a", mtype="counter", delta=1),
                 dict(seq=2, batch_id=1, pos=1, id="", mtype="counter", delta=1),
                 dict(seq=3, batch_id=1, pos=2, id="b", mtype="weird", delta=1),
                 dict(seq=4, batch_id=2, pos=0, id="a", mtype="counter", delta=2),
                 dict(seq=5, batch_id=3, pos=0, id="g", mtype="gauge")])
    accepted, rejected = va.batch_gate(va.validate_rows(u))
    assert rows_of(accepted, "seq") == [(4,)]
    assert rows_of(rejected, "batch_id", "first_bad_pos", "reject_code", "status") == [
        (1, 1, "empty_metric_name", 400), (3, 0, "empty_metric_value", 400)]


def test_prefix_apply_keeps_rows_before_first_bad(updates):
    u = updates([dict(seq=1, batch_id=1, pos=0, id="hits", mtype="counter", delta=1),
                 dict(seq=2, batch_id=1, pos=1),
                 dict(seq=3, batch_id=1, pos=2, id="temp", mtype="gauge", value=1.0),
                 dict(seq=4, batch_id=2, pos=0, id="", mtype="gauge", value=1.0)])
    assert rows_of(va.prefix_apply(u), "seq") == [(1,), (4,)]


def test_single_json_rules(spark):
    df = spark.createDataFrame(
        [(1, "c", "counter", 42, None), (2, "g", "gauge", None, 3.14), (3, "c", "counter", None, None),
         (4, "g", "gauge", None, None), (5, "x", "unknown", 1, None), (6, "", "counter", 1, None)],
        "seq long, id string, mtype string, delta long, value double").withColumn("hash", F.lit(""))
    v = va.validate_single(df)
    assert rows_of(v, "seq", "reject_code", "status") == [
        (1, None, 200), (2, None, 200), (3, "nil_delta", 400), (4, "nil_value", 400),
        (5, "unknown_metric_type", 400), (6, "empty_metric_name", 500)]
