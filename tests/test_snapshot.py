"""Snapshot files and tables: missing, replace, patch, upsert."""

import os

import pytest
from conftest import rows_of
from tallyho.operators import merge as mg
from tallyho.schema import METRIC
from tallyho.session import scratch_path
from tallyho.sinks import snapshot as sk
from tallyho.sources import snapshot as src


def m(spark, rows):
    return spark.createDataFrame(rows, METRIC)


def test_missing_file_is_empty(spark):
    assert src.read_snapshot_json(spark, scratch_path(spark, "none")).count() == 0


def test_reads_a_one_line_json_array(spark, tmp_path):
    p = tmp_path / "state.json"
    p.write_text('[{"id":"cpu","type":"gauge","value":1},{"id":"hits","type":"counter","delta":5,"hash":"h"}]')
    got = rows_of(src.read_snapshot_json(spark, str(p)))
    assert got == [("cpu", "gauge", None, 1.0, ""), ("hits", "counter", 5, None, "h")]
    e = tmp_path / "empty.json"
    e.write_text("")
    assert src.read_snapshot_json(spark, str(e)).count() == 0


def test_dump_then_read_and_overwrite(spark):
    base = scratch_path(spark, "snap")
    sk.write_snapshot_json(m(spark, [("cpu", "gauge", None, 1.0, ""), ("c", "counter", 10, None, "x")]), base)
    assert src.read_snapshot_json(spark, base).count() == 2
    sk.write_snapshot_json(m(spark, [("cpu", "gauge", None, 99.9, "")]), base)
    assert rows_of(src.read_snapshot_json(spark, base)) == [("cpu", "gauge", None, 99.9, "")]


def test_json_dump_refuses_nan(spark):
    base = scratch_path(spark, "snap")
    try:
        sk.write_snapshot_json(m(spark, [("g", "gauge", None, float("nan"), "")]), base)
    except Exception as e:  # noqa: BLE001
        assert "non-finite" in str(e)
    else:
        raise AssertionError("NaN must not be written")


def test_patch_replaces_number_of_kind_and_appends(spark):
    old = m(spark, [("c", "counter", 10, 1.0, "old"), ("g", "gauge", 3, 1.0, "")])
    patches = spark.createDataFrame(
        [(1, "c", "counter", 20, None, "new"), (2, "g", "gauge", 9, 2.0, ""), (3, "n", "gauge", 5, 7.0, "a"),
         (4, "n", "gauge", 6, 8.0, "b")],
        "seq long, id string, mtype string, delta long, value double, hash string")
    got = rows_of(mg.patch_snapshot(old, patches))
    assert got == [("c", "counter", 20, 1.0, "new"), ("g", "gauge", 3, 2.0, ""), ("n", "gauge", 5, 8.0, "b")]


def test_upsert_replaces_keeps_absent_and_hash(spark):
    old = m(spark, [("g1", "gauge", None, 1.0, "h"), ("keep", "counter", 5, None, "")])
    new = spark.createDataFrame([(1, "g1", "gauge", None, 42.0), (2, "c1", "counter", 7, None),
                                 (3, "c1", "counter", 20, None)],
                                "seq long, id string, mtype string, delta long, value double")
    got = rows_of(mg.upsert_snapshot(old, new))
    assert got == [("c1", "counter", 20, None, ""), ("g1", "gauge", None, 42.0, "h"), ("keep", "counter", 5, None, "")]
    empty = new.limit(0)
    assert rows_of(mg.upsert_snapshot(old, empty)) == rows_of(old)


def test_versions_follow_commits(spark):
    base = scratch_path(spark, "table")
    p1 = sk.write_snapshot_table(m(spark, [("a", "counter", 1, None, "")]), base)
    p2 = sk.write_snapshot_table(m(spark, [("a", "counter", 2, None, "")]), base)
    assert sk.numbers(spark, base) == [1, 2] and sk.read_commit(spark, base).path == p2 != p1
    assert rows_of(src.read_snapshot_table(spark, base), "delta") == [(2,)]


def test_a_write_on_an_older_version_conflicts(spark):
    """Two upserts that start from one version: the second fails, nothing is lost silently."""
    base = scratch_path(spark, "table")
    sk.write_snapshot_table(m(spark, [("a", "counter", 1, None, "")]), base)
    start = sk.read_commit(spark, base)
    sk.write_snapshot_table(m(spark, [("a", "counter", 5, None, "")]), base, start=start)
    with pytest.raises(sk.CommitConflict):
        sk.write_snapshot_table(m(spark, [("b", "counter", 9, None, "")]), base, start=start)
    assert rows_of(src.read_snapshot_table(spark, base), "id", "delta") == [("a", 5)]
    # a commit file that appears just before ours also conflicts
    at, path = sk.start_version(spark, base)
    assert sk.write_text(spark, f"{base}/{sk.COMMITS}/{3:020d}", '{"dir": "v=x"}')
    assert not sk.write_text(spark, f"{base}/{sk.COMMITS}/{3:020d}", '{"dir": "v=y"}')
    with pytest.raises(sk.CommitConflict):
        sk.commit(spark, base, at, path)


def test_only_the_last_versions_are_kept(spark):
    base = scratch_path(spark, "table")
    for i in range(4):
        sk.write_snapshot_table(m(spark, [("a", "counter", i, None, "")]), base, keep=2)
    assert sk.numbers(spark, base) == [3, 4]
    assert len([d for d in os.listdir(base) if d.startswith("v=")]) == 2
    assert rows_of(src.read_snapshot_table(spark, base), "delta") == [(3,)]


def test_a_cluster_needs_a_named_folder():
    from types import SimpleNamespace as S

    from tallyho.session import shared_dir
    conf = S(get=lambda key, default=None: default)
    ctx = S(getConf=lambda: conf, master="spark://host:7077", applicationId="app", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(S(sparkContext=ctx, conf=S(get=lambda key, default=None: default)))
