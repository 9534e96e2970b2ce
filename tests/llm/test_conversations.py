import hashlib
import itertools
import random
from zlib import crc32

import pytest

from tallyho.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, at long, conv string, block int, fault string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "c", 1, "f") for r in rows], SCHEMA)


def cheapest(symbols):
    """(cost, audit) by trying all edits row by row, keeping the best of each last role."""
    best = {0: (0, "")}

    def relax(d, q, v):
        if q not in d or v < d[q]:
            d[q] = v

    def inserted(b):
        for _ in range(3):
            for q, (c, a) in list(b.items()):
                relax(b, C.FOLLOWS[q], (c + 3, a + "I"))
        return b

    for s in symbols:
        new = {}
        for q, (c, a) in inserted(best).items():
            relax(new, q, (c + 4, a + "D"))
            if s != "x":
                more = 3 if s.isupper() else 0
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((q, s.lower()))
                if to is not None:
                    relax(new, to, (c + more, a + "K"))
                relax(new, C.FOLLOWS[q], (c + 3 + more, a + "R"))
        best = new
    best = inserted(best)
    return min(best[q] for q in (0, 3) if q in best)


def ours(symbols):
    cost, q, edits, _ = C.solve(symbols, 0, C.END)
    return cost + C.END[q], "".join(edits) + "I" * C.END_INSERTS[q]


def test_every_short_conversation_is_solved_at_least_cost_and_first_audit():
    for n in range(5):
        for t in itertools.product("suaoUx", repeat=n):
            assert ours("".join(t)) == cheapest("".join(t))


def test_longer_conversations():
    r = random.Random(3)
    for i in range(400):
        t = "".join(r.choice("suaosuaSUAOxuauaua") for _ in range(r.randint(1, 60 if i else 256)))
        assert ours(t) == cheapest(t)


def test_prices_are_feasible_and_tight_along_the_path():
    lattice = C.Lattice("ssuUaxaouu", C.END)
    length = lattice.auction(0)
    for node, out in enumerate(lattice.out):
        assert all(lattice.price[node] <= cost + lattice.price[end] for _, cost, end in out)
    assert length == lattice.price[0] == cheapest("ssuUaxaouu")[0]


def test_costs_between_parts_add_up():
    r = random.Random(5)
    for n in (1, 15, 16, 17, 50):
        t = "".join(r.choice("suaoUAx") for _ in range(n))
        costs = C.between(t)
        whole = [min(costs[4 * q + x] + C.END[x] for x in range(4)) for q in range(4)]
        assert whole[0] == cheapest(t)[0]
        for q in range(4):
            assert C.Lattice(t, C.END).auction(q) == whole[q]


def brute(rows):
    """The query's contract on (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            h = crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else "".join(x for x in text if x not in ".!?") if h == 2 else text
            after += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in after:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            ini = role[:1] if role[:1] in tuple("sua") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else ini.upper() if fault else ini
        cost, audit = cheapest(symbols)
        kept, q, i = [], 0, 0
        for e in audit:
            if e == "D":
                i += 1
                continue
            given = ["", "", "user", "assistant"][C.FOLLOWS[q]]
            if e == "I":
                kept.append(f"{given}:")
            else:
                kept.append(f"{after[i][1] if e == 'K' else given}:{after[i][2]}")
                i += 1
            q = {"s": 1, "u": 2, "a": 3}[kept[-1][0]]
        turns = {t for t, _, _ in after if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(after, after[1:])]
        out[conv] = (gaps, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def awkward():
    r = random.Random(11)
    rows = []
    for c in range(40):
        for t in range(r.randint(1, 14)):
            text = r.choice(["Yes.", "No!", "so\n", "", " \t", "a. b? c", "Ünï日本𝄞.", "x" * 90 + r.choice("ab.")])
            rows.append((c, t + r.choice([0, 0, 0, 5]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Student"]), text))
    rows += [(None, t, r.choice(["user", None]), r.choice([None, "Hi.", "Hi"])) for t in (None, None, 1, 2, 2, 3)]
    rows += [(90, None, "user", "Hi."), (90, None, "assistant", "Yes.")] + [(91, 1, "user", "Same.")] * 30
    # dropped whole (the checksum of 99:k is 0 modulo 20)
    gone = next(t for t in range(100) if crc32(f"99:{t}".encode()) % 20 == 0)
    return rows + [(99, gone, "user", "Hi.")] + [(50, t, "assistant" if t % 2 else "user", f"Text {t}.") for t in range(1, 120)]


@pytest.mark.parametrize("chunk", [4, 256])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, chunk):
    """Chunks of 4 rows cut most conversations: border prices and entries must agree."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    rows = awkward()
    rows_of(spark, rows).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in C.query(spark, str(tmp_path)).collect()}
    assert got == brute(rows)
    assert got[99] == (0, 0, 0, 0, 0, 0, "", C.NO_ROWS)


def test_repaired_rows_and_empty_table(spark):
    rows = C.in_order(rows_of(spark, [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "tool", "c."), (1, 3, "user", "")]),
                      "conv_id", "turn", "role", "text")
    repairs = C.repair(C.faults(rows))
    got = [(r.edit, r.role, r.text) for r in C.repaired(rows, repairs).orderBy("at", "step").collect()]
    # one Insert between the two, an Insert or a Rerole of the third: the audit first in order
    assert "".join(repairs.first().edits) == cheapest("uuox")[1]
    assert [x[1] for x in got] == ["user", "assistant", "user", "assistant"][:len(got)]
    none = C.in_order(rows_of(spark, []), "conv_id", "turn", "role", "text")
    assert C.repaired(none, C.repair(C.faults(none))).collect() == []
