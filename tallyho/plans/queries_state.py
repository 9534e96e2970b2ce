"""Queries over state tables: lookups, merge, restore, snapshots, display.

"Old" and "new" parts of the update log are split by time (``ts`` before /
from 2024-01-16): every row of ``events`` is used, one part or the other, and
the time filter is pushed into the Parquet scan.
"""

from __future__ import annotations


from ..operators import fold as fo
from ..operators import lookup as lk
from ..operators import merge as mg
from ..schema import COUNTER
from ..session import scratch_path
from ..sinks import bucketed as bk
from ..sinks import snapshot as sk
from ..sinks.bodies import cut_bodies
from ..sources import snapshot as src
from ..sources.events import UPDATES_SQL, WIDE_UPDATES_SQL, load_updates
from .queries_core import FOLD_SQL
from .registry import query

SPLIT_TS = "2024-01-16 00:00:00"


def _halves(spark, sf_dir, wide=False):
    u = load_updates(spark, sf_dir, wide=wide, with_ts=True)
    cut = f"TIMESTAMP_NTZ'{SPLIT_TS}'"
    return u.filter(f"ts < {cut}").drop("ts"), u.filter(f"ts >= {cut}").drop("ts")


def _fold_sql(where: str) -> str:
    return FOLD_SQL.replace("FROM u GROUP BY", f"FROM u WHERE {where} GROUP BY")


OLD_SQL = _fold_sql(f"ts < TIMESTAMP '{SPLIT_TS}'")
NEW_SQL = _fold_sql(f"ts >= TIMESTAMP '{SPLIT_TS}'")
# per-user keys: many keys occur in only one part, so appends happen
W_OLD_SQL = OLD_SQL.replace(UPDATES_SQL, WIDE_UPDATES_SQL)
W_NEW_SQL = NEW_SQL.replace(UPDATES_SQL, WIDE_UPDATES_SQL)

GAUGE_TEXT_SQL = r"regexp_replace(CAST(value AS VARCHAR), '\.0$', '')"
VALUE_TEXT_SQL = f"""coalesce(CASE WHEN mtype = 'gauge' THEN {GAUGE_TEXT_SQL}
                           WHEN mtype = 'counter' THEN CAST(delta AS VARCHAR) END, '')"""


@query("lookup_point", f"SELECT * FROM ({FOLD_SQL}) s WHERE id = 'click_3' AND mtype = 'counter'")
def q_lookup_point(spark, sf_dir):
    return lk.lookup(fo.fold_state(load_updates(spark, sf_dir)), "click_3", COUNTER)


@query("lookup_point_snapshot", f"SELECT * FROM ({FOLD_SQL}) s WHERE id = 'click_3' AND mtype = 'counter'")
def q_lookup_point_snapshot(spark, sf_dir):
    """The same point lookup against a persisted snapshot: the key filter is
    pushed into the Parquet scan (row groups without the key are skipped)."""
    base = scratch_path(spark, "snapshot-table")
    sk.write_snapshot_table(fo.fold_state(load_updates(spark, sf_dir)), base)
    return lk.lookup(src.read_snapshot_table(spark, base), "click_3", COUNTER)


@query("lookup_point_outcome", f"""
WITH r AS (SELECT unnest(['click_3', 'purchase_1', 'click_missing', 'click_3']) AS id,
                  unnest(['counter', 'gauge', 'counter', 'histogram']) AS mtype),
s AS ({FOLD_SQL})
SELECT r.id, r.mtype,
       CASE WHEN r.mtype = 'histogram' THEN 'unknown_metric_type' WHEN s.id IS NULL THEN 'not_found' ELSE 'ok' END AS outcome,
       CASE WHEN s.mtype = 'gauge' THEN regexp_replace(CAST(s.value AS VARCHAR), '\\.0$', '')
            WHEN s.mtype = 'counter' THEN CAST(s.delta AS VARCHAR) END AS value_text,
       s.delta, s.value,
       CASE WHEN r.mtype = 'histogram' THEN 400 WHEN s.id IS NULL THEN 404 ELSE 200 END AS status_text,
       CASE WHEN r.mtype = 'histogram' THEN 400 WHEN s.id IS NULL THEN 404 ELSE 200 END AS status_json
FROM r LEFT JOIN s ON r.id = s.id AND r.mtype = s.mtype
""")
def q_lookup_point_outcome(spark, sf_dir):
    """Four single lookups: two hits, a missing key and an unknown kind."""
    base = scratch_path(spark, "snapshot-table")
    sk.write_snapshot_table(fo.fold_state(load_updates(spark, sf_dir)), base)
    state = src.read_snapshot_table(spark, base)
    asked = [("click_3", COUNTER), ("purchase_1", "gauge"), ("click_missing", COUNTER), ("click_3", "histogram")]
    found = [lk.lookup_outcome(state, *key) for key in asked]
    return found[0].union(found[1]).union(found[2]).union(found[3])


def lookup_requests(spark, sf_dir):
    """One lookup per event; every 7th asks for an unknown id, every 11th for
    an unknown kind."""
    u = load_updates(spark, sf_dir)
    return u.selectExpr("seq AS req_id",
                        "CASE WHEN seq % 7 = 0 THEN concat(id, '_missing') ELSE id END AS id",
                        "CASE WHEN seq % 11 = 0 THEN 'histogram' ELSE mtype END AS mtype")


LOOKUP_BULK_SQL = f"""
WITH s AS ({FOLD_SQL}),
r AS (
  SELECT seq AS req_id,
         CASE WHEN seq % 7 = 0 THEN id || '_missing' ELSE id END AS id,
         CASE WHEN seq % 11 = 0 THEN 'histogram' ELSE mtype END AS mtype
  FROM ({UPDATES_SQL}) u),
j AS (
  SELECT r.req_id, r.id, r.mtype, s.delta, s.value, s.id IS NOT NULL AS hit,
         coalesce(CASE WHEN s.mtype = 'gauge' THEN regexp_replace(CAST(s.value AS VARCHAR), '\\.0$', '')
                       WHEN s.mtype = 'counter' THEN CAST(s.delta AS VARCHAR) END, '') AS vt
  FROM r LEFT JOIN s ON r.id = s.id AND r.mtype = s.mtype),
o AS (
  SELECT *, CASE WHEN mtype NOT IN ('counter', 'gauge') OR mtype IS NULL THEN 'unknown_metric_type'
                 WHEN NOT hit THEN 'not_found'
                 WHEN (mtype = 'counter' AND delta IS NULL) OR (mtype <> 'counter' AND value IS NULL) THEN 'nil_number'
                 ELSE 'ok' END AS outcome
  FROM j)
SELECT req_id, id, mtype, outcome,
       CASE WHEN outcome = 'ok' THEN vt END AS value_text,
       delta, value,
       CASE WHEN outcome = 'not_found' THEN 404 WHEN outcome = 'unknown_metric_type' THEN 400
            WHEN outcome = 'nil_number' THEN 500 ELSE 200 END AS status_text,
       CASE WHEN coalesce(id, '') = '' OR coalesce(mtype, '') = '' THEN 400
            WHEN outcome = 'not_found' THEN 404 WHEN outcome = 'unknown_metric_type' THEN 400
            ELSE 200 END AS status_json
FROM o
"""


@query("lookup_bulk", LOOKUP_BULK_SQL)
def q_lookup_bulk(spark, sf_dir):
    return lk.lookup_bulk(lookup_requests(spark, sf_dir), fo.fold_state(load_updates(spark, sf_dir)))


def _buckets(spark):
    """As many buckets as a shuffle has partitions: neither side of a join needs more."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("lookup_bulk_keyed", LOOKUP_BULK_SQL)
def q_lookup_bulk_keyed(spark, sf_dir):
    """The same lookups against a state in buckets of the key: only the requests move."""
    base = scratch_path(spark, "state-buckets")
    bk.write_bucketed(fo.fold_state(load_updates(spark, sf_dir)), base, _buckets(spark))
    return lk.lookup_bulk(lookup_requests(spark, sf_dir), bk.read_bucketed(spark, base), text_on="requests")


FIRST_SQL = f"""
SELECT id, mtype, arg_min_null(delta, seq) AS delta, arg_min_null(value, seq) AS value, arg_min_null(hash, seq) AS hash
FROM ({UPDATES_SQL}) u GROUP BY id, mtype
"""


@query("lookup_bulk_first", LOOKUP_BULK_SQL.replace(FOLD_SQL, FIRST_SQL))
def q_lookup_bulk_first(spark, sf_dir):
    """Lookups in a snapshot file that holds every key many times (the whole log): the first
    row in file order answers."""
    path = scratch_path(spark, "snapshot-log")
    u = load_updates(spark, sf_dir).repartitionByRange("seq").sortWithinPartitions("seq")
    sk.metric_json_columns(u).write.json(path)
    return lk.lookup_bulk(lookup_requests(spark, sf_dir), src.read_snapshot_json(spark, path, with_at=True))


@query("state_merge", FOLD_SQL)
def q_state_merge(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    return fo.merge_state(fo.fold_state(old), fo.fold_state(new))


@query("state_merge_keyed", FOLD_SQL)
def q_state_merge_keyed(spark, sf_dir):
    """A batch merged into a state in buckets, written as its next version: the state stays
    where it is, before and after."""
    old, new = _halves(spark, sf_dir)
    base = scratch_path(spark, "state-buckets")
    bk.write_bucketed(fo.fold_state(old), base, _buckets(spark))
    merged = fo.merge_state(bk.read_bucketed(spark, base), fo.fold_state(new))
    bk.write_bucketed(merged, base, _buckets(spark), start=sk.read_commit(spark, base))
    return bk.read_bucketed(spark, base)


@query("state_merge_seq", FOLD_SQL)
def q_state_merge_seq(spark, sf_dir):
    """Merge that carries ``last_seq``: the newer gauge wins whichever side
    it is on (here the newer part is passed first)."""
    old, new = _halves(spark, sf_dir)
    merged = fo.merge_state(fo.fold_state(new, keep_seq=True), fo.fold_state(old, keep_seq=True))
    return merged.drop("last_seq")


@query("all_rows", FOLD_SQL)
def q_all_rows(spark, sf_dir):
    return lk.all_rows(fo.fold_state(load_updates(spark, sf_dir)))


@query("scan_snapshot_file", OLD_SQL)
def q_scan_snapshot_file(spark, sf_dir):
    """A dump as the single-node service leaves it, arrays of objects on one line, read in
    byte ranges."""
    old, _ = _halves(spark, sf_dir)
    state = sk.metric_json_columns(fo.fold_state(old))
    rows = state.selectExpr("type", "id", "to_json(struct(id, type, delta, value, hash)) AS json")
    path = scratch_path(spark, "snapshot-array")
    cut_bodies(rows, "type", "id", "json").select("body").write.text(path)
    return src.read_snapshot_json(spark, path)


@query("scan_snapshot_lines", OLD_SQL)
def q_scan_snapshot_lines(spark, sf_dir):
    """A dump of this library: an object a line."""
    old, _ = _halves(spark, sf_dir)
    base = scratch_path(spark, "snapshot-json")
    sk.write_snapshot_json(fo.fold_state(old), base)
    return src.read_snapshot_json(spark, base)


@query("sink_overwrite_file", FOLD_SQL)
def q_sink_overwrite_file(spark, sf_dir):
    """Two dumps to one location: the second replaces the first whole."""
    old, _ = _halves(spark, sf_dir)
    base = scratch_path(spark, "snapshot-json")
    sk.write_snapshot_json(fo.fold_state(old), base)
    sk.write_snapshot_json(fo.fold_state(load_updates(spark, sf_dir)), base)
    return src.read_snapshot_json(spark, base)


@query("restore_state", FOLD_SQL)
def q_restore_state(spark, sf_dir):
    """State of the first part restored onto a state of the second part:
    counters add up, the snapshot's gauges replace."""
    old, new = _halves(spark, sf_dir)
    base = scratch_path(spark, "snapshot-json")
    sk.write_snapshot_json(fo.fold_state(new), base)
    return fo.restore_state(fo.fold_state(old), src.read_snapshot_json(spark, base))


@query("scan_snapshot_table", OLD_SQL)
def q_scan_snapshot_table(spark, sf_dir):
    old, _ = _halves(spark, sf_dir)
    base = scratch_path(spark, "snapshot-table")
    sk.write_snapshot_table(fo.fold_state(old), base)
    return src.read_snapshot_table(spark, base)


UPSERT_SQL = f"""
WITH a AS ({W_OLD_SQL}), b AS ({W_NEW_SQL})
SELECT coalesce(a.id, b.id) AS id, coalesce(a.mtype, b.mtype) AS mtype,
       CASE WHEN b.id IS NOT NULL THEN b.delta ELSE a.delta END AS delta,
       CASE WHEN b.id IS NOT NULL THEN b.value ELSE a.value END AS value,
       coalesce(a.hash, '') AS hash
FROM a FULL OUTER JOIN b ON a.id = b.id AND a.mtype = b.mtype
"""


@query("sink_upsert_table", UPSERT_SQL)
def q_sink_upsert_table(spark, sf_dir):
    """Dump of a newer state upserted into a stored table: replace, not add."""
    old, new = _halves(spark, sf_dir, wide=True)
    base = scratch_path(spark, "snapshot-table")
    sk.write_snapshot_table(fo.fold_state(old), base)
    start = sk.read_commit(spark, base)
    merged = mg.upsert_snapshot(src.read_snapshot_table(spark, base),
                                fo.fold_state(new, keep_seq=True), seq="last_seq")
    sk.write_snapshot_table(merged, base, start=start)
    return src.read_snapshot_table(spark, base)


PATCH_SQL = f"""
WITH a AS ({W_OLD_SQL}),
p AS (SELECT * FROM ({WIDE_UPDATES_SQL}) u WHERE ts >= TIMESTAMP '{SPLIT_TS}'),
g AS (SELECT id, mtype, arg_min_null(delta, seq) AS fd, arg_min_null(value, seq) AS fv,
             arg_max_null(delta, seq) AS ld, arg_max_null(value, seq) AS lv,
             arg_max_null(hash, seq) AS lh
      FROM p GROUP BY id, mtype)
SELECT a.id, a.mtype,
       CASE WHEN g.id IS NOT NULL AND a.mtype = 'counter' THEN g.ld ELSE a.delta END AS delta,
       CASE WHEN g.id IS NOT NULL AND a.mtype = 'gauge' THEN g.lv ELSE a.value END AS value,
       CASE WHEN g.id IS NOT NULL THEN g.lh ELSE a.hash END AS hash
FROM a LEFT JOIN g ON a.id = g.id AND a.mtype = g.mtype
UNION ALL
SELECT g.id, g.mtype,
       CASE WHEN g.mtype = 'counter' THEN g.ld ELSE g.fd END,
       CASE WHEN g.mtype = 'gauge' THEN g.lv ELSE g.fv END,
       g.lh
FROM g ANTI JOIN a ON a.id = g.id AND a.mtype = g.mtype
"""


@query("sink_patch_file", PATCH_SQL)
def q_sink_patch_file(spark, sf_dir):
    """Each later update saved as a single-row patch of a JSON snapshot."""
    old, new = _halves(spark, sf_dir, wide=True)
    base = scratch_path(spark, "snapshot-json")
    sk.write_snapshot_json(fo.fold_state(old), base)
    patched = mg.patch_snapshot(src.read_snapshot_json(spark, base), new)
    sk.write_snapshot_json(patched, base)
    return src.read_snapshot_json(spark, base)


@query("append_missing", f"""
WITH a AS ({W_OLD_SQL}), b AS ({W_NEW_SQL})
SELECT * FROM a
UNION ALL
SELECT b.* FROM b ANTI JOIN a ON a.id = b.id AND a.mtype = b.mtype
""")
def q_append_missing(spark, sf_dir):
    old, new = _halves(spark, sf_dir, wide=True)
    return mg.append_missing(fo.fold_state(old), fo.fold_state(new))


@query("project_display", f"""
SELECT id, mtype, id AS name, {VALUE_TEXT_SQL} AS value_text FROM ({FOLD_SQL}) s
""")
def q_project_display(spark, sf_dir):
    return lk.display_rows(fo.fold_state(load_updates(spark, sf_dir)))


@query("project_report_lines", f"""
SELECT id, mtype,
       '<p>' || replace(replace(replace(replace(replace(id || ':' || chr(9) || {VALUE_TEXT_SQL},
                '&', '&amp;'), '''', '&#39;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;') || '</p>' AS line
FROM ({FOLD_SQL}) s
""")
def q_project_report_lines(spark, sf_dir):
    return lk.report_lines(fo.fold_state(load_updates(spark, sf_dir)))
