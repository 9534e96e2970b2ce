"""Bodies beyond what a row can decode: element by element, inflated piece by piece."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallyho.functions import elements as el
from tallyho.functions.codec import gunzip
from tallyho.operators.fold import fold_state
from tallyho.sources import large_bodies as lb
from tallyho.sources import payloads as pl
from tallyho.streaming.keyed_stream import with_conf

from test_payloads import BODIES


@pytest.mark.parametrize("rows", [1, 10_000])
def test_same_outcomes_as_in_the_row(spark, monkeypatch, rows):
    monkeypatch.setattr(lb, "ROWS", rows)
    bodies = [b[0] for b in BODIES] + [None, '[{"id":"a","type":"counter","delta":1}] tail', '[{"id":"a","type":"counter","delta":1},]',
                                       '[{"id":"a","type":"x"},{"id":7}]', '[{"id":"n","type":"counter","delta":1},5,{"id":""}]']
    df = spark.createDataFrame(list(enumerate(bodies)), "batch_id long, body string")
    d = pl.decode_batches(df)
    accepted, outcomes = lb.decode_large_batches(df)
    assert rows_of(outcomes, "batch_id", "first_bad_pos", "reject_code", "status") == rows_of(d, "batch_id", "first_bad_pos", "reject_code", "status")
    assert rows_of(accepted) == rows_of(pl.accepted_rows(d))


def test_gzip_bodies(spark):
    good = json.dumps([{"id": "a", "type": "counter", "delta": 2}]).encode()
    half = len(good) // 2
    z = [gzip.compress(good), gzip.compress(good[:half]) + gzip.compress(good[half:]), gzip.compress(good)[:-9], b"plain", b""]
    df = spark.createDataFrame(list(enumerate(z)) + [(9, bytearray(good))], "batch_id long, body binary")
    accepted, outcomes = lb.decode_large_batches(df, zipped="batch_id < 9")
    # the array of the body that breaks off is whole: what is behind it is not read
    assert rows_of(outcomes, "batch_id", "status") == [(0, 200), (1, 200), (2, 200), (3, 400), (4, 400), (9, 200)]
    assert rows_of(accepted, "batch_id", "delta") == [(0, 2), (1, 2), (2, 2), (9, 2)]
    # held in a row, a body has to be whole
    got = dict(rows_of(df.where("batch_id < 9").select("batch_id", gunzip("body").cast("string").alias("s")), "batch_id", "s"))
    assert got == {0: good.decode(), 1: good.decode(), 2: None, 3: None, 4: None}


def test_elements_whatever_the_pieces():
    """Pieces end within escapes, characters, strings and numbers."""
    import random
    r = random.Random(2)

    def value(depth=0):
        k = r.randint(0, 7 if depth < 3 else 4)
        if k == 0:
            return r.choice([None, True, 1, -2.5, 1e300])
        if k <= 4:
            return "".join(r.choice('ab"\\{}[], \n é /') for _ in range(r.randint(0, 12)))
        return [value(depth + 1) for _ in range(r.randint(0, 3))] if k == 5 else {f"k{i}\\}}": value(depth + 1) for i in range(r.randint(0, 4))}

    for _ in range(800):
        rows = [value() for _ in range(r.randint(0, 8))]
        body = ("\n" + json.dumps(rows, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) + r.choice(["", " tail ]{"])).encode()
        half, piece = len(body) // 2, r.randint(1, 9)
        pieces = el.pieces_of(body, piece) if r.random() < 0.5 else el.inflate(gzip.compress(body[:half]) + gzip.compress(body[half:]), piece)
        assert [json.loads(e) for e in el.elements(el.decoded(pieces))] == rows
    for bad in ["", " ", "{}", "[", "[1", "[1,", "[1,]", "[,1]", "[1 2]", '["a', '["a]', '[{"a":1]', "[}", "[{]}]", "5", "nulls", '"x"', '[{"a":"b\\"}]']:
        with pytest.raises(el.Broken):
            list(el.elements(el.decoded(el.pieces_of(bad.encode(), 3))))


def test_inflates_in_pieces():
    z = gzip.compress(b"x" * (50 << 20)) * 2
    sizes = [len(p) for p in el.inflate(z)]
    assert sum(sizes) == 100 << 20 and max(sizes) <= el.PIECE
    with pytest.raises(el.Broken):
        list(el.inflate(z[:-4]))


def test_a_body_that_inflates_too_far_is_not_called_broken(spark):
    df = spark.createDataFrame([(1, bytearray(gzip.compress(b"0" * 5000)))], "k long, body binary")
    assert df.select(F.length(gunzip("body", 5000)).alias("n")).first().n == 5000
    with pytest.raises(Exception, match="inflates beyond 4999"):
        df.select(gunzip("body", 4999)).collect()


def test_a_body_of_200_mib_folds(spark, tmp_path):
    """More than a VARIANT holds; as it is and as a small gzip body; and a broken one."""
    pad, n = "p" * 4000, 52_000
    body = "[" + ",".join(f'{{"id":"k{i % 10}","type":"counter","delta":{i},"note":"{pad}"}}' for i in range(n)) + "]"
    assert len(body) > 200 << 20
    (tmp_path / "1").write_text(body)
    (tmp_path / "2").write_bytes(gzip.compress(body.encode(), 1))
    (tmp_path / "3").write_text(body[:-2])
    del body
    df = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("CAST(regexp_extract(path, '[0-9]$', 0) AS BIGINT) AS batch_id", "content AS body")
    with with_conf(spark, {"spark.sql.files.maxPartitionBytes": str(8 << 20), "spark.sql.shuffle.partitions": "16"}):
        accepted, outcomes = lb.decode_large_batches(df, zipped="batch_id = 2")
        assert rows_of(outcomes, "batch_id", "reject_code", "status") == [(1, None, 200), (2, None, 200), (3, "parse_error", 400)]
        state = fold_state(accepted, hash_pass="inline", order=("batch_id", "pos"))
        want = [(f"k{k}", 2 * sum(range(k, n, 10))) for k in range(10)]
        assert rows_of(state, "id", "delta") == want
