"""Decoding of JSON bodies and paths; signatures; gzip; admission."""

import gzip
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallyho.functions.codec import gunzip
from tallyho.functions.signing import sign, verify
from tallyho.operators import validate as va
from tallyho.sources import payloads as pl


def batches(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "batch_id long, body string")


# One body a rule: (body, status, first failing position, accepted items). The
# rules: an array of objects; names in any case; unknown fields ignored at any
# depth; a known field of the wrong type, or a number that does not fit, refuses
# the whole body; then the first bad element decides.
BODIES = [
    ('[{"type":"gauge","id":"load","value":-0.25}]', 200, None, [("load", None, -0.25)]),
    ('[{"delta":-9,"id":"jobs","type":"counter"},{"id":"jobs","type":"counter","delta":4}]', 200, None,
     [("jobs", -9, None), ("jobs", 4, None)]),
    ('  [ ]  ', 200, None, []),
    ('null', 200, None, []),
    ('[{"ID":"up","tYpE":"gauge","VALUE":7}]', 200, None, [("up", None, 7.0)]),
    ('[{"id":"up","type":"gauge","value":1,"tags":{"id":5,"delta":"x"}}]', 200, None, [("up", None, 1.0)]),
    ('[{"id":"up","type":"gauge","value":1,"delta":null,"hash":null}]', 200, None, [("up", None, 1.0)]),
    ('[{"id":"up","type":"gauge","value":1e400}]', 400, None, None),
    ('[{"id":"n","type":"counter","delta":9223372036854775807}]', 200, None, [("n", 2**63 - 1, None)]),
    ('[{"id":"n","type":"counter","delta":9223372036854775808}]', 400, None, None),
    ('[{"id":"n","type":"counter","delta":2.0}]', 400, None, None),
    ('[{"id":"n","type":"counter","delta":true}]', 400, None, None),
    ('[{"id":["n"],"type":"counter","delta":2}]', 400, None, None),
    ('[{"id":"n","type":"counter","delta":2},7]', 400, None, None),
    ('{"id":"n","type":"counter","delta":2}', 400, None, None),
    ('[{"id":"n"', 400, None, None),
    ('', 400, None, None),
    ('[{"id":"n","type":"counter","delta":2},null]', 400, 1, None),
    ('[{"id":"n","type":"counter","delta":2},{"id":"m","type":"Gauge","value":1}]', 400, 1, None),
    ('[{"id":"n","type":"gauge","delta":2}]', 400, 0, None),
    ('[{"type":"counter","delta":2},{"id":"n"}]', 400, 0, None),
]


def test_batch_bodies_row_by_row(spark):
    rows = pl.parse_batches(batches(spark, [b[0] for b in BODIES]))
    rows = rows.withColumn("pos", F.coalesce("pos", F.lit(-1)))
    checked = va.validate_rows(rows).withColumn(
        "reject_code", F.when(F.col("parse_error"), F.lit("parse_error")).otherwise(F.col("reject_code")))
    accepted, rejected = va.batch_gate(checked)
    bad = {r.batch_id: r for r in rejected.collect()}
    assert [bad[i].status if i in bad else 200 for i in range(len(BODIES))] == [b[1] for b in BODIES]
    assert {i: r.first_bad_pos for i, r in bad.items()} == {
        i: -1 if b[2] is None else b[2] for i, b in enumerate(BODIES) if b[1] != 200}
    got = {}
    for r in sorted(accepted.collect(), key=lambda r: (r.batch_id, r.pos)):
        got.setdefault(r.batch_id, []).append((r.id, r.delta, r.value))
    assert got == {i: b[3] for i, b in enumerate(BODIES) if b[3]}


def test_batch_bodies_in_row(spark):
    d = pl.decode_batches(batches(spark, [b[0] for b in BODIES] + [None]))
    got = {r.batch_id: r for r in d.collect()}
    assert [got[i].status for i in range(len(BODIES))] == [b[1] for b in BODIES] and got[len(BODIES)].status == 400
    assert [got[i].first_bad_pos for i in range(len(BODIES))] == [b[2] for b in BODIES]
    rows = {}
    for r in sorted(pl.accepted_rows(d).collect(), key=lambda r: (r.batch_id, r.pos)):
        rows.setdefault(r.batch_id, []).append((r.id, r.delta, r.value))
    assert rows == {i: b[3] for i, b in enumerate(BODIES) if b[3]}


def test_singles_and_lookups(spark):
    bodies = ['{"Id":"q","TYPE":"counter","delta":7,"more":[{"id":3}]}', '[]', 'null', '{"id":null,"value":"1"}', '{"id":"z","type":4}']
    rows = pl.parse_singles(batches(spark, bodies)).collect()
    assert [(r.id, r.mtype, r.delta, r.parse_error) for r in sorted(rows, key=lambda r: r.batch_id)] == [
        ("q", "counter", 7, False), (None, None, None, True), (None, None, None, False), (None, None, None, True), (None, None, None, True)]
    rows = pl.parse_lookups(batches(spark, bodies)).collect()
    assert [(r.id, r.mtype, r.parse_error) for r in sorted(rows, key=lambda r: r.batch_id)][0] == ("q", "counter", False)


def test_order_of_long_bodies(spark):
    """A body of more than a thousand items comes before the next body, whatever its length."""
    from tallyho.operators.fold import fold_state
    long = "[" + ",".join('{"id":"g","type":"gauge","value":%d}' % i for i in range(1501)) + "]"
    d = pl.decode_batches(batches(spark, [None, long, '[{"id":"g","type":"gauge","value":-1}]']))
    state = fold_state(pl.accepted_rows(d), hash_pass="inline", order=("batch_id", "pos"))
    assert rows_of(state, "id", "value") == [("g", -1.0)]


def test_a_body_too_large_to_hold_fails_loudly(spark, monkeypatch):
    monkeypatch.setattr(pl, "LARGE_BODY", 10)
    with pytest.raises(Exception, match="too large to decode"):
        pl.decode_batches(batches(spark, ["[[[[[[[[[[[[[[[[["])).collect()
    assert pl.decode_batches(batches(spark, [BODIES[0][0]])).first().status == 200


def test_paths(spark):
    df = spark.createDataFrame([("/update/counter/x/5",), ("/update/counter//5",), ("/update/x",), ("/update/counter/x/5\n",)], "path string")
    got = rows_of(pl.parse_paths(df), "path", "routed", "mtype", "id", "raw_value")
    assert got == sorted([("/update/counter/x/5", True, "counter", "x", "5"),
                          ("/update/counter//5", True, "counter", "", "5"),
                          ("/update/counter/x/5\n", True, "counter", "x", "5\n"),
                          ("/update/x", False, "", "", "")], key=repr)


def test_sign_matches_python_hmac(spark):
    body = b'[{"id":"cpu","type":"gauge","value":1.5}]'
    df = spark.createDataFrame([(bytearray(body),)], "body binary")
    for n in (1, 64, 65, 100):
        key = "k" * n
        want = hmac.new(key.encode(), body, hashlib.sha256).hexdigest()
        assert df.select(sign("body", key).alias("s")).first().s == want


def test_verify_three_valued(spark):
    body = b"payload"
    key = "secret"
    good = hmac.new(key.encode(), body, hashlib.sha256).hexdigest()
    df = spark.createDataFrame([(bytearray(body), s) for s in (good, good.upper(), "", None, "abc", "00")],
                               "body binary, sig string")
    got = [r.v for r in df.select(verify("body", key, F.col("sig")).alias("v")).collect()]
    assert got == ["ok", "ok", "skipped", "skipped", "bad", "bad"]
    assert df.select(verify("body", "", F.col("sig")).alias("v")).distinct().first().v == "skipped"


def test_gzip_round_trip_and_bad_input(spark):
    body = b'{"id":"cpu","type":"gauge","value":1.5}'
    df = spark.createDataFrame([(bytearray(gzip.compress(body)),), (bytearray(b"not gzip at all"),)], "b binary")
    got = [r.u for r in df.select(gunzip("b").alias("u")).collect()]
    assert bytes(got[0]) == body and got[1] is None


def test_admission_order(spark):
    key = "k"
    good_body = b"[]"
    sig = hmac.new(key.encode(), good_body, hashlib.sha256).hexdigest()
    zipped = gzip.compress(good_body)
    zsig = hmac.new(key.encode(), zipped, hashlib.sha256).hexdigest()
    rows = [
        (1, bytearray(good_body), "application/json", "", sig),
        (2, bytearray(good_body), "application/json", "", "00"),
        (3, bytearray(b"not gzip"), "application/json", "gzip", None),
        (4, bytearray(good_body), "text/plain", "", sig),
        (5, bytearray(zipped), "application/json; charset=utf-8", "gzip", zsig),
        (6, bytearray(good_body), "", "", None),
    ]
    df = spark.createDataFrame(rows, "batch_id long, body binary, content_type string, "
                                     "content_encoding string, signature string")
    got = rows_of(pl.admit(df, key), "batch_id", "admit_status", "json")
    assert got == [(1, None, "[]"), (2, 400, None), (3, 400, None), (4, 415, None), (5, None, "[]"),
                   (6, 415, None)]


def test_readme_ingest_path(spark):
    from tallyho.operators.fold import fold_state, merge_state
    from tallyho.schema import METRIC
    from tallyho.session import scratch_path
    from tallyho.sinks.snapshot import read_commit, write_snapshot_table
    from tallyho.sources.snapshot import read_snapshot_table

    key = "k"
    b1 = b'[{"id":"hits","type":"counter","delta":3},{"id":"hits","type":"counter","delta":7}]'
    b2 = gzip.compress(b'[{"id":"temp","type":"gauge","value":1.5}]')
    b3 = b'[{"id":"hits","type":"counter","delta":100},{"id":"","type":"gauge","value":1}]'
    sig = lambda b: hmac.new(key.encode(), b, hashlib.sha256).hexdigest()
    env = spark.createDataFrame(
        [(1, bytearray(b1), "application/json", "", sig(b1)), (2, bytearray(b2), "application/json", "gzip", sig(b2)),
         (3, bytearray(b3), "application/json", "", None), (4, bytearray(b1), "application/json", "", "00")],
        "batch_id long, body binary, content_type string, content_encoding string, signature string")
    base = scratch_path(spark, "readme")
    write_snapshot_table(spark.createDataFrame([("hits", "counter", 5, None, "")], METRIC), base)
    req = pl.admit(env, key)
    dec = pl.decode_batches(req.select("batch_id", "admit_code", F.col("json").alias("body")))
    rows = pl.accepted_rows(dec.filter("admit_code IS NULL"))
    upd = fold_state(rows, hash_pass="inline", order=("batch_id", "pos"))
    start = read_commit(spark, base)
    state = merge_state(read_snapshot_table(spark, base), upd)
    write_snapshot_table(state, base, start=start)
    assert rows_of(read_snapshot_table(spark, base)) == [("hits", "counter", 15, None, ""),
                                                         ("temp", "gauge", None, 1.5, "")]


def test_signed_payloads(spark):
    from tallyho.sinks.snapshot import signed_payloads
    rows = [(1, "[1]", "application/json"), (2, "<p>", "text/html; charset=utf-8"), (3, "plain", "text/plain"), (4, "x", None)]
    df = spark.createDataFrame(rows, "n long, body string, content_type string")
    for r in signed_payloads(df, "k").collect():
        sent, body = bytes(r.payload), rows[r.n - 1][1].encode()
        assert r.signature == hmac.new(b"k", sent, hashlib.sha256).hexdigest()
        assert (gzip.decompress(sent) if r.content_encoding == "gzip" else sent) == body
        assert (r.content_encoding == "gzip") == (r.n <= 2)
    plain = signed_payloads(df.withColumn("accept", F.lit("br")), "k", accepts="accept")
    assert {r.content_encoding for r in plain.collect()} == {""}
