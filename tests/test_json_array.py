"""One-line snapshots in byte ranges: quotes, escapes and braces across range borders."""

import json
import random

import pytest

from conftest import rows_of
from tallyho.functions import elements as el
from tallyho.operators.fold import restore_state
from tallyho.session import scratch_path
from tallyho.sinks import snapshot as sk
from tallyho.sources import snapshot as src
from tallyho.sources.json_array import json_objects
from tallyho.streaming.keyed_stream import with_conf


def objects(seed, n):
    r = random.Random(seed)
    nasty = ['}', '{', '"', '\\', '\\"', '}{', '},{"id":"x"', 'a', 'é', '日', ' ', '[', ']', 'null', '\n', '\\\\']
    out = []
    for i in range(n):
        o = {"id": f"{i}" + "".join(r.choice(nasty) for _ in range(r.randint(0, 8))), "type": r.choice(["counter", "gauge"])}
        o["delta" if o["type"] == "counter" else "value"] = r.randint(-99, 99)
        if r.random() < 0.2:
            o["more"] = {"deep": [{"x": "}" * r.randint(0, 3)}], "s": r.choice(nasty)}
        if r.random() < 0.3:
            o["hash"] = "".join(r.choice(nasty) for _ in range(3))
        out.append(o)
    return out


def layouts(rows):
    yield "one line", json.dumps(rows, ensure_ascii=False)
    yield "with an end of line", json.dumps(rows) + "\n"
    yield "over many lines", json.dumps(rows, indent=1)
    yield "an object a line", "\n".join(json.dumps(o) for o in rows)
    yield "an array a line", "\n".join(json.dumps(rows[i:i + 7], separators=(",", ":")) for i in range(0, len(rows), 7)) + "\n"


@pytest.mark.parametrize("split", [37, 400, 1 << 27])
def test_all_layouts_in_small_byte_ranges(spark, tmp_path, split):
    rows = objects(split, 30 if split == 37 else 120)
    want = sorted((o["id"], o["type"], o.get("delta"), None if o.get("value") is None else float(o["value"]), o.get("hash", "")) for o in rows)
    with with_conf(spark, {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}):
        for name, text in layouts(rows):
            p = tmp_path / f"{name}.json"
            p.write_text(text, encoding="utf-8")
            got = src.read_snapshot_json(spark, str(p), layout="array", with_at=True).collect()
            assert sorted(tuple(r)[:5] for r in got) == want, name
            in_order = [r.id for r in sorted(got, key=lambda r: tuple(r["at"]))]
            assert in_order == [o["id"] for o in rows], name


def test_one_line_is_many_tasks(spark, tmp_path):
    p = tmp_path / "state.json"
    p.write_text(json.dumps(objects(1, 3000)))
    with with_conf(spark, {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}):
        d = json_objects(spark, str(p))
        per_split = d.groupBy("block").count().collect()
        assert len(per_split) > 10 and max(r["count"] for r in per_split) < 600


def test_nulls_empty_and_broken_files(spark, tmp_path):
    def read(text, name="s.json"):
        p = tmp_path / name
        p.write_text(text)
        return sorted((r.json for r in json_objects(spark, str(p)).collect()), key=repr)

    assert read('[null,{"id":"a"}, null ]') == ["{\"id\":\"a\"}", None, None]
    assert read("[]") == [] and read("null\n") == [None] and read("") == []
    for bad in ['[{"id":"a"', '[{"id":"a', '[{"id":"a"},{"id":"b"', '[7]', '[{"id":"a"}] x', 'x [{"id":"a"}]']:
        with pytest.raises(Exception, match="snapshot|within an object"):
            read(bad)


def test_reads_arrays_by_their_first_character(spark, tmp_path):
    p = tmp_path / "dump"
    p.mkdir()
    (p / "a.json").write_text(' \n[{"id":"x","type":"counter","delta":1},{"id":"x","type":"counter","delta":2}]\n')
    (p / "b.json").write_text('[{"id":"g","type":"gauge","value":2.5}]')
    got = rows_of(src.read_snapshot_json(spark, str(p)))
    assert got == [("g", "gauge", None, 2.5, ""), ("x", "counter", 1, None, ""), ("x", "counter", 2, None, "")]


def test_summaries_combine():
    """The state at any cut of a text, from the summaries of what lies before it."""
    r = random.Random(7)
    for seed in range(60):
        segments = json.dumps(objects(seed, 12), ensure_ascii=False).split("}")[:-1]
        cuts = sorted(r.sample(range(len(segments)), 3))
        state = (False, 0)
        for a, b in zip([0, *cuts], [*cuts, len(segments)]):
            s = el.Summary()
            for x in segments[a:b]:
                s.add(x)
            inside, change, _ = s.state[int(state[0])]
            state = (inside, state[1] + change)
            one = el.Summary()
            for x in segments[:b]:
                one.add(x)
            assert state == tuple(one.state[0][:2])
        assert state == (False, 0)


def test_restore_takes_the_last_row_in_file_order(spark, tmp_path):
    """Repeated keys over files of unequal size: Spark packs small files into any partition."""
    rows = {"a": 3, "b": 4000, "c": 1, "d": 900}
    for name, n in rows.items():
        (tmp_path / f"{name}.json").write_text("".join(json.dumps({"id": "g", "type": "gauge", "value": ord(name) * 10000 + i}) + "\n" for i in range(n)))
    want = [("g", "gauge", None, float(ord("d") * 10000 + 899), "")]
    with with_conf(spark, {"spark.sql.files.maxPartitionBytes": "50000", "spark.sql.files.openCostInBytes": "1"}):
        snap = src.read_snapshot_json(spark, str(tmp_path), with_at=True)
        assert rows_of(restore_state(src.empty_state(spark), snap)) == want


def test_versions_are_read_line_by_line(spark):
    from tallyho.schema import METRIC
    base = scratch_path(spark, "snap")
    sk.write_snapshot_json(spark.createDataFrame([("a", "counter", 1, None, "")], METRIC), base, compression="gzip")
    assert not src._starts_with_array(spark, sk.current_path(spark, base))
    assert rows_of(src.read_snapshot_json(spark, base)) == [("a", "counter", 1, None, "")]
