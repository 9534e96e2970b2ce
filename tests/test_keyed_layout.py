"""State in buckets, Bloom filters, first match of repeated keys."""

import json

from conftest import rows_of
from tallyho.operators import lookup as lk
from tallyho.operators import merge as mg
from tallyho.operators.fold import fold_state, merge_state
from tallyho.schema import METRIC
from tallyho.session import scratch_path
from tallyho.sinks import bucketed as bk
from tallyho.sinks import snapshot as sk
from tallyho.sources import snapshot as src
from tallyho.streaming.keyed_stream import with_conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4"}


def state_of(spark, n, first=0):
    return spark.range(first, first + n).selectExpr("concat('k', id) AS id", "'counter' AS mtype", "id AS delta", "CAST(NULL AS DOUBLE) AS value", "'' AS hash")


def exchanges_above_scans(df):
    """For each file scan of the physical plan: whether an exchange lies above it."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node, moved):
        moved = moved or "Exchange" in node.nodeName()
        if node.nodeName().startswith("Scan parquet"):
            found.append((node.nodeName(), moved))
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i), moved)

    walk(plan, False)
    return found


def test_joins_leave_the_state_where_it_is(spark):
    base = scratch_path(spark, "bucketed")
    bk.write_bucketed(state_of(spark, 500), base, 4)
    requests = spark.range(0, 900, 3).selectExpr("id AS req_id", "concat('k', id) AS id", "IF(id % 2 = 0, 'counter', 'gauge') AS mtype")
    new = fold_state(spark.range(400, 700).selectExpr("id AS seq", "concat('k', id) AS id", "IF(id < 690, 'counter', 'gauge') AS mtype", "1 AS delta", "CAST(NULL AS DOUBLE) AS value"))
    with with_conf(spark, NO_BROADCAST):
        state = bk.read_bucketed(spark, base)
        found = lk.lookup_bulk(requests, state, text_on="requests")
        merged = merge_state(state, new)
        upserted = mg.upsert_snapshot(state, new.withColumn("seq", new.delta))
        for df in (found, merged, upserted):
            assert [moved for name, moved in exchanges_above_scans(df) if "tallyho_state" in name] == [False], df._jdf.queryExecution().executedPlan().toString()
        assert rows_of(found) == rows_of(lk.lookup_bulk(requests, state_of(spark, 500)))
        assert rows_of(merged) == rows_of(merge_state(state_of(spark, 500), new))
        # the result is the next version
        bk.write_bucketed(merged, base, 4, start=sk.read_commit(spark, base))
        again = bk.read_bucketed(spark, base)
        assert rows_of(again) == rows_of(merge_state(state_of(spark, 500), new))
        assert again.count() == 700 and sk.numbers(spark, base) == [1, 2]


def scanned_rows(df):
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()

    def walk(node):
        nonlocal total
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return total


def test_bloom_filters_skip_row_groups(spark):
    """An id between the least and the greatest of a file, that the file doesn't hold."""
    base = scratch_path(spark, "table")
    sk.write_snapshot_table(state_of(spark, 3000).coalesce(1), base)
    state = src.read_snapshot_table(spark, base)
    with with_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        assert scanned_rows(lk.lookup(state, "k150", "counter")) > 0
        assert scanned_rows(lk.lookup(state, "k150x", "counter")) == 0
        assert scanned_rows(lk.lookup(state, "k2x", "counter")) == 0
    assert rows_of(lk.lookup(state, "k150", "counter"), "id", "delta") == [("k150", 150)]


def test_first_match_of_repeated_keys(spark, tmp_path):
    rows = [{"id": "a", "type": "counter", "delta": 1}, {"id": "b", "type": "gauge", "value": 2.5}, {"id": "a", "type": "counter", "delta": 9},
            {"id": "a", "type": "gauge", "value": 7.0}, {"id": "b", "type": "gauge"}]
    for layout, text in (("array", json.dumps(rows)), ("lines", "\n".join(map(json.dumps, rows)))):
        p = tmp_path / layout
        p.write_text(text)
        state = src.read_snapshot_json(spark, str(p), with_at=True)
        assert rows_of(lk.lookup(state, "a", "counter"), "delta") == [(1,)]
        assert lk.lookup(state, "zz", "counter").collect() == [] == lk.lookup(state, "a", "histogram").collect()
        requests = spark.createDataFrame([(1, "a", "counter"), (2, "b", "gauge"), (3, "a", "gauge"), (4, "x", "gauge"), (5, "a", "counter")], "req_id long, id string, mtype string")
        for text_on in ("state", "requests"):
            got = rows_of(lk.lookup_bulk(requests, state, text_on), "req_id", "outcome", "value_text")
            assert got == [(1, "ok", "1"), (2, "ok", "2.5"), (3, "ok", "7"), (4, "not_found", None), (5, "ok", "1")]
        assert lk.lookup_outcome(state, "b", "gauge").first().value_text == "2.5"


def test_empty_bucketed_state(spark):
    base = scratch_path(spark, "bucketed")
    bk.write_bucketed(spark.createDataFrame([], METRIC), base, 4)
    assert bk.read_bucketed(spark, base).collect() == []
