"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation should be a system message at most, then user and assistant in
turn. Repairing one is a shortest path through a lattice: a node is a place
between two rows and the role that came last, an arc is an edit (Keep, Delete,
Rerole, Insert) with its integer cost. The auction algorithm keeps a price for
every node (never above an arc's cost plus the price at its end) and a path
from the origin. Where the path's last node is priced below its best arc, its
price rises to that and the path contracts; else the path extends along that
arc, until it meets the goal. Prices start at the least costs of the rows that
are left, which is always feasible. At the end every shortest path consists of
tight arcs (price = cost + price at the end), and the path that takes the
alphabetically least tight arc leading to the goal is the repair.

Conversations may be of any length. Rows are range-partitioned by conversation
and order, numbered, and cut into chunks of at most ``CHUNK`` rows, so no
conversation passes through one task as rows. A conversation of one chunk is
solved by itself. For longer ones the auction gives each chunk's costs between
entry and exit roles, a scan from the end (four numbers a conversation) turns
them into the price at each chunk's exit, all four entries of a chunk are then
traced, and a scan from the start picks the entries. Scans read one small
summary a chunk, in order, and hold nothing else.

Order of rows: by turn (nulls first); rows of one turn by role, the first 64
characters of the text, then a hash of it. Faults: the first that holds of
blank, duplicate (same role and text seen earlier) and truncated.

Defined cases: a null role or text is one space; a null conversation id is a
conversation of its own; an empty table gives an empty result; repeated rows
are duplicates; a role other than s..., u..., a... (also an empty one) can't be
kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import saved, small_batches, table

#: Rows of one chunk at most; a power of two.
CHUNK = 256
#: Rows of one part of a chunk, where all entries and exits are asked for: an auction's
#: work grows with the square of its rows when its exit is far from the cheapest one.
PART = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# Roles that came last: 0 none, 1 system, 2 user, 3 assistant. A repaired
# conversation ends in 0 or 3.
SYSTEM, USER, ASSISTANT = 1, 2, 3
#: Role that must follow (by a Rerole or an Insert).
FOLLOWS = (USER, USER, ASSISTANT, USER)
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: Cost and inserts from the last row to the end of the conversation, by the last role.
END = (0, 2 * INSERT, INSERT, 0)
END_INSERTS = (0, 2, 1, 0)
NEVER = 1 << 60

#: Characters of a blank text.
BLANK = " \t\n\v\f\r"

# Symbols of rows: s u a, or o for another role; in capitals when truncated; x when
# the row has to go.


def least(symbol: str) -> int:
    """Cheapest edit of a row, whatever stands around it."""
    if symbol == "x":
        return DELETE
    return min(DELETE, (KEEP if symbol.lower() in KEPT else REROLE) + (TRUNCATED if symbol.isupper() else 0))


def arcs(symbol: str, i: int, q: int) -> list[tuple[str, int, int]]:
    """(edit, cost, node) from node ``4 * i + q``, by edit in alphabetical order."""
    nxt = FOLLOWS[q]
    out = [("D", DELETE, 4 * (i + 1) + q), ("I", INSERT, 4 * i + nxt)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = KEPT.get(symbol.lower(), (None,) * 4)[q]
        if kept is not None:
            out.append(("K", KEEP + extra, 4 * (i + 1) + kept))
        out.append(("R", REROLE + extra, 4 * (i + 1) + nxt))
    return out


class Lattice:
    """The lattice of a chunk's symbols, with the prices at its exits."""

    def __init__(self, symbols: str, exits: tuple[int, ...]):
        n = len(symbols)
        self.goal, self.last = 4 * (n + 1), 4 * n
        self.out = [arcs(symbols[x // 4], x // 4, x % 4) for x in range(self.last)]
        self.out += [[("", exits[q], self.goal)] for q in range(4)]
        price, low = [], min(exits)
        for s in ["", *reversed(symbols)]:
            low += least(s) if s else 0
            price += [low] * 4
        self.price = price[::-1] + [0]
        #: No path that reaches an exit costs more: what does is a dead end.
        self.most = DELETE * n + 4 * INSERT + max([e for e in exits if e < NEVER], default=0)

    def auction(self, origin: int) -> int:
        """Length of the shortest path from ``origin`` to the goal; prices converge on it."""
        price, path = self.price, [origin]
        while True:
            node = path[-1]
            best, to = min((cost + price[end], end) for _, cost, end in self.out[node])
            if best > self.most:  # a dead end
                price[node] = NEVER
                if len(path) == 1:
                    return NEVER
                path.pop()
            elif price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif to == self.goal:
                return price[origin]
            else:
                path.append(to)

    def trace(self, origin: int) -> list[tuple[str, int]]:
        """(edit, node reached) along the alphabetically least path of tight arcs to the goal."""
        price, dead = self.price, set()
        path, choices = [], [iter(self.out[origin])]
        node = origin
        while True:
            for edit, cost, end in choices[-1]:
                if price[node] == cost + price[end] and end not in dead:
                    if end == self.goal:
                        return path
                    path.append((edit, end))
                    choices.append(iter(self.out[end]))
                    node = end
                    break
            else:  # no tight arc from here leads on
                dead.add(node)
                choices.pop()
                path.pop()
                node = path[-1][1] if path else origin


@lru_cache(maxsize=100_000)
def _between(symbols: str) -> tuple[int, ...]:
    out = [[NEVER] * 4 for _ in range(4)]
    for q in range(4):
        lattice = Lattice(symbols, tuple(0 if x == q else NEVER for x in range(4)))
        for entry in range(4):
            out[entry][q] = lattice.auction(entry)
    return tuple(c for row in out for c in row)


def between(symbols: str) -> tuple[int, ...]:
    """Costs from each entry role to each exit role of a chunk (16, NEVER: no way): by
    auctions over short parts, joined part by part."""
    costs = _between(symbols[:PART])
    for i in range(PART, len(symbols), PART):
        more = _between(symbols[i:i + PART])
        costs = tuple(min(min(costs[4 * a + x] + more[4 * x + b] for x in range(4)), NEVER) for a in range(4) for b in range(4))
    return costs


@lru_cache(maxsize=100_000)
def solve(symbols: str, entry: int, exits: tuple[int, ...]) -> tuple[int, int, tuple[str, ...], tuple[str, ...]]:
    """(cost up to the exit, exit role, edits by row, their roles). From any entry there is a
    way: every row may be deleted and the end reached by inserts."""
    lattice = Lattice(symbols, exits)
    cost = lattice.auction(entry)
    edits, roles, edit, role = [], [], "", ""
    node = entry
    for e, node in lattice.trace(entry):
        edit, role = edit + e, role + "-sua"[node % 4]
        if e != "I":
            edits.append(edit)
            roles.append(role)
            edit = role = ""
    return cost - exits[node % 4], node % 4, tuple(edits), tuple(roles)


def in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, at) of all rows: ``at`` ascends in order within every
    conversation, by 1 within one partition. Written to the shared folder."""
    d = rows.selectExpr(f"`{conv}` AS conv", f"CAST(`{turn}` AS BIGINT) AS turn", f"coalesce(`{role}`, ' ') AS role",
                        f"coalesce(`{text}`, ' ') AS text").withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text"), F.col("_row")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return saved(d.drop("_row"), "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """Rows in order → (conv, turn, at, initial, fault, symbol), written to the shared folder."""
    d = rows.withColumn("_last", F.right(F.rtrim("text", F.lit(BLANK)), F.lit(1)))
    # the first of equal rows of a conversation: one number a text, no row is gathered
    firsts = (d.where("_last <> ''").groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("at").alias("at"))
              .select("at", F.lit(True).alias("_first")))
    d = d.selectExpr("conv", "turn", "at", "_last",
                     "CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial")
    d = d.join(firsts, "at", "left").selectExpr(
        "conv", "turn", "at", "initial", "CASE WHEN _last = '' THEN 'blank' WHEN _first IS NULL THEN 'duplicate' "
        "WHEN _last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault")
    return saved(d.selectExpr("*", "CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(initial) "
                              "ELSE initial END AS symbol"), "conversation-faults")


def _mapped(df: DataFrame, schema: T.StructType, step_of) -> DataFrame:
    """Each partition's rows, in order, through ``step_of()``: a function from a row (a
    tuple) to rows of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = step_of()
        for b in batches:
            rows = [r for x in zip(*(c.to_pylist() for c in b.columns)) for r in step(x)]
            cols = list(zip(*rows)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def _scanned(df: DataFrame, schema: T.StructType, order, step_of) -> DataFrame:
    """``_mapped`` along every conversation, in ``order``."""
    return _mapped(df.repartition("conv").sortWithinPartitions("conv", order), schema, step_of)


def _edited(conv, block, symbols, entry, exits):
    cost, q, edits, roles = solve(symbols, entry, tuple(exits))
    return conv, block, cost, q, list(edits), list(roles)


def _by_itself():
    return lambda r: [_edited(*r, 0, END)]


def _with_costs():
    return lambda r: [(*r, list(between(r[2])))]


def _from_the_end():
    """Chunks of a conversation, last first → the price at each one's exits."""
    now = [object(), END]

    def step(r):
        conv, block, symbols, costs = r
        if conv != now[0]:
            now[:] = [conv, END]
        exits = now[1]
        now[1] = tuple(min(costs[4 * q + x] + exits[x] for x in range(4)) for q in range(4))
        return [(conv, block, symbols, list(exits))]

    return step


def _all_entries():
    return lambda r: [(r[0], r[1], *zip(*[_edited(*r[:3], q, r[3])[2:] for q in range(4)]))]


def _from_the_start():
    """Chunks of a conversation with the results of all entries → those of the entry taken."""
    now = [object(), 0]

    def step(r):
        conv, block, *results = r
        q = now[1] if conv == now[0] else 0
        taken = [x[q] for x in results]
        now[:] = [conv, taken[1]]
        return [(conv, block, *taken)]

    return step


def chunks_of(faulty: DataFrame) -> DataFrame:
    """(conv, block, first, symbols, initials): the rows of one conversation within
    ``CHUNK`` numbers, in order."""
    line = "array_join(transform(_rows, x -> x.{}), '')"
    d = faulty.groupBy("conv", F.expr(f"at DIV {CHUNK} AS block")).agg(
        F.expr("array_sort(collect_list(struct(at, symbol, initial))) AS _rows"))
    return d.selectExpr("conv", "block", "_rows[0].at AS first", f"{line.format('symbol')} AS symbols",
                        f"{line.format('initial')} AS initials")


def repair(faulty: DataFrame) -> DataFrame:
    """Rows' faults → (conv, block, first, symbols, initials, cost, last_role,
    edits, roles) a chunk: ``edits`` has for every row its inserts, then its own edit;
    ``roles`` the initials that these give (for a deleted row the one before)."""
    chunks = saved(chunks_of(faulty), "conversation-chunks")
    keys = [chunks.schema["conv"], chunks.schema["block"]]
    symbols, strings = T.StructField("symbols", T.StringType()), T.ArrayType(T.StringType())
    four = T.ArrayType(T.LongType())
    found = [("cost", T.LongType()), ("last_role", T.LongType()), ("edits", strings), ("roles", strings)]
    result = T.StructType([*keys, *(T.StructField(n, t) for n, t in found)])

    many = chunks.groupBy("conv").count().where("count > 1").select(F.col("conv").alias("_many"))
    same = F.col("conv").eqNullSafe(F.col("_many"))
    short = chunks.join(many, same, "left_anti").select("conv", "block", "symbols")
    done = _mapped(short, result, _by_itself)
    long = chunks.join(many, same, "left_semi").select("conv", "block", "symbols")
    long = _mapped(long.repartition("conv", "block"), T.StructType([*keys, symbols, T.StructField("costs", four)]), _with_costs)
    long = _scanned(long, T.StructType([*keys, symbols, T.StructField("exits", four)]), F.desc("block"), _from_the_end)
    entries = T.StructType([*keys, *(T.StructField(n, T.ArrayType(t)) for n, t in found)])
    long = _mapped(long.repartition("conv", "block"), entries, _all_entries)
    long = _scanned(long, result, "block", _from_the_start)
    both = done.union(long).withColumnsRenamed({"conv": "_conv", "block": "_block"})
    # a block's chunks have different conversations
    joined = chunks.join(both, (F.col("block") == F.col("_block")) & F.col("conv").eqNullSafe(F.col("_conv")))
    return saved(joined.drop("_conv", "_block"), "conversation-repairs")


ROLES = "CASE {} WHEN 's' THEN 'system' WHEN 'u' THEN 'user' ELSE 'assistant' END"


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv, at, step, edit, role, text): the conversations as they are after the repair, in
    order of ``at`` and ``step``; ``edit`` is I, K or R. Inserts at a conversation's end
    follow its last row."""
    plan = repairs.selectExpr("conv AS _conv", "block AS _block", "first", "edits", "roles")
    d = rows.withColumn("_b", F.expr(f"at DIV {CHUNK}"))
    d = d.join(plan, (F.col("_b") == F.col("_block")) & F.col("conv").eqNullSafe(F.col("_conv")))
    d = d.selectExpr("conv", "at", "role", "text", "edits[CAST(at - first AS INT)] AS _e", "roles[CAST(at - first AS INT)] AS _r")
    d = d.selectExpr("conv", "at", "role", "text", "_r", "posexplode(split(_e, '')) AS (step, edit)").where("edit <> 'D'")
    given = ROLES.format("substr(_r, step + 1, 1)")
    d = d.selectExpr("conv", "at", "step", "edit", f"CASE edit WHEN 'K' THEN role ELSE {given} END AS role",
                     "CASE edit WHEN 'I' THEN '' ELSE text END AS text")
    ends = (repairs.groupBy("conv").agg(F.expr("max(block) AS _block"), F.expr("max_by(struct(first, size(edits) AS n, last_role), block) AS x"))
            .selectExpr("conv", "x.first + x.n - 1 AS at", "x.last_role AS q"))
    left = f"CASE q WHEN {USER} THEN array('assistant') WHEN {SYSTEM} THEN array('user', 'assistant') ELSE array() END"
    ends = ends.selectExpr("conv", "at", f"posexplode({left}) AS (step, role)")
    return d.union(ends.selectExpr("conv", "at", f"step + {1 << 20} AS step", "'I' AS edit", "role", "'' AS text"))


def hashes(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of conversations after repair: ``role:text``, newline-joined. A hash
    takes its texts one by one, so a conversation's pass one task as a stream."""
    small_batches(rows.sparkSession)
    schema = T.StructType([rows.schema["conv"], T.StructField("sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for b in batches:
            done = []
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if sha is None or conv != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                    sha.update(f"{role}:{text}".encode())
                else:
                    sha.update(f"\n{role}:{text}".encode())
            cols = list(zip(*done)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow[0].type), pa.array([sha.hexdigest()])], schema=arrow)

    d = rows.repartition("conv").sortWithinPartitions("conv", "at", "step")
    return d.select("conv", "role", "text").mapInArrow(run, schema)


#: Role initials that may stand side by side.
PAIRS = "('su', 'ua', 'au')"
NO_ROWS = hashlib.sha256().hexdigest()


def report(convs: DataFrame, faulty: DataFrame, repairs: DataFrame, after: DataFrame) -> DataFrame:
    """One row per conversation of ``convs`` (column conv): its faults, the cost and the edits
    of its repair, and the hash of what it is then. Conversations without rows: zeros."""
    by_turn = faulty.groupBy("conv", "turn").agg(
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    stats = by_turn.groupBy("conv").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(turn), 0) AS gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")))
    wrong = f"size(filter(transform(sequence(1, length({{0}})), i -> substr({{0}}, i, 2)), p -> length(p) = 2 AND p NOT IN {PAIRS}))"
    paths = repairs.selectExpr(
        "conv", "block", "cost", f"{wrong.format('initials')} AS n", "left(initials, 1) AS a", "right(initials, 1) AS z",
        "array_join(edits, '') AS e", "last_role").groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.expr("array_sort(collect_list(struct(block, e, a, z, n))) AS x"),
        F.expr("max_by(last_role, block) AS q"))
    borders = f"size(filter(sequence(0, size(x) - 2, 1), i -> x[i].z || x[i + 1].a NOT IN {PAIRS}))"
    paths = paths.selectExpr(
        "conv", f"cost + CASE q WHEN {USER} THEN {END[USER]} WHEN {SYSTEM} THEN {END[SYSTEM]} ELSE 0 END AS cost",
        f"aggregate(x, 0, (t, c) -> t + c.n) + CASE WHEN size(x) > 1 THEN {borders} ELSE 0 END AS illegal",
        f"array_join(transform(x, c -> c.e), '') || CASE q WHEN {USER} THEN 'I' WHEN {SYSTEM} THEN 'II' ELSE '' END AS audit")
    facts = convs.select("conv").unionByName(stats, True).unionByName(paths, True).unionByName(hashes(after), True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return facts.groupBy("conv").agg(
        *(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.lit(NO_ROWS)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage, by the checksum of ``conv_id:turn`` modulo 20: 0 drops a row, 1
    empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    what = "crc32(CAST(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' ')) AS BINARY)) % 20"
    d = rows.selectExpr("conv_id", "turn", "role", "text", f"{what} AS _d").where("_d <> 0")
    return d.selectExpr(
        "conv_id", "turn", "CASE WHEN _d = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role",
        "CASE _d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '') ELSE coalesce(text, ' ') END AS text",
        "explode(CASE WHEN _d = 3 THEN array(0, 1) ELSE array(0) END) AS _copy").drop("_copy")


# The damage's checksum bit by bit, then the cheapest edits row by row: up to two
# inserts, then an edit of the row; of each last role the best (cost, audit) stays.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce([4294967295] || [ascii(x) for x in string_split(
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')],
         lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 20 AS h
  FROM conversations),
a AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM a),
f AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
             left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS prev FROM o),
r AS (SELECT *, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM f),
ins(q, q1, c, e, t) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']),
  (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])),
ops(e, q1, ini, q2, c, role) AS (VALUES ('K', 0, 's', 1, 0, NULL), ('K', 0, 'u', 2, 0, NULL), ('K', 1, 'u', 2, 0, NULL),
  ('K', 3, 'u', 2, 0, NULL), ('K', 2, 'a', 3, 0, NULL), ('R', 0, NULL, 2, 3, 'user'), ('R', 1, NULL, 2, 3, 'user'),
  ('R', 3, NULL, 2, 3, 'user'), ('R', 2, NULL, 3, 3, 'assistant'), ('D', 0, NULL, 0, 4, NULL), ('D', 1, NULL, 1, 4, NULL),
  ('D', 2, NULL, 2, 4, NULL), ('D', 3, NULL, 3, 4, NULL)),
w AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM o
  UNION ALL
  SELECT conv_id, pos, q, x.cost, x.audit, x.lines FROM (
    SELECT r.conv_id, r.pos, ops.q2 AS q, min(struct_pack(cost := w.cost + ins.c + ops.c + CASE WHEN ops.e <> 'D' AND r.truncated THEN 3 ELSE 0 END,
             audit := w.audit || ins.e || ops.e,
             lines := w.lines || ins.t || CASE ops.e WHEN 'D' THEN [] ELSE [coalesce(ops.role, r.role) || ':' || r.text] END)) AS x
    FROM w JOIN ins ON ins.q = w.q JOIN ops ON ops.q1 = ins.q1
    JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
    WHERE (ops.ini IS NULL OR ops.ini = r.ini) AND (ops.e = 'D' OR NOT (r.blank OR r.duplicate))
    GROUP BY r.conv_id, r.pos, ops.q2)),
n AS (SELECT conv_id, max(pos) AS pos, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (pos > 1 AND coalesce(prev, '') || coalesce(ini, '') NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
z AS (SELECT w.conv_id, min(struct_pack(cost := w.cost + ins.c, audit := w.audit || ins.e, lines := w.lines || ins.t)) AS x
      FROM w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.pos = w.pos JOIN ins ON ins.q = w.q AND ins.q1 IN (0, 3) GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
       coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(z.x.cost, 0) AS cost, coalesce(z.x.audit, '') AS audit,
       sha256(coalesce(array_to_string(z.x.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def query(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = in_order(damaged(given), "conv_id", "turn", "role", "text")
    faulty = faults(rows)
    repairs = repair(faulty)
    convs = given.selectExpr("conv_id AS conv").distinct()
    return report(convs, faulty, repairs, repaired(rows, repairs)).withColumnRenamed("conv", "conv_id")
