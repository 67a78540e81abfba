"""Conversation repair against an exhaustive search over edits, turn by turn."""

import hashlib
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from epochfold.llm import repair

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WHITE = " \t\n\x0b\x0c\r"


def damaged(data):
    out = []
    for conv, turn, role, text in data:
        name = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(name).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, lines): the least of all edits, for turns of (role, text, fault)."""

    @lru_cache(maxsize=None)
    def best(i, state, room):
        ways = []
        if i == len(turns) and state in ("", "a"):
            ways.append((0, "", ()))
        if room:
            new = "a" if state == "u" else "u"
            cost, audit, lines = best(i, new, room - 1)
            line = {"u": "user:", "a": "assistant:"}[new]
            ways.append((cost + 5, "I" + audit, (line, *lines)))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, audit, lines = best(i + 1, state, 2)
            ways.append((cost + 2, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in legal:
                    cost, audit, lines = best(i + 1, role[0], 2)
                    ways.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                new = "assistant" if state == "u" else "user"
                cost, audit, lines = best(i + 1, new[0], 2)
                ways.append((cost + extra + 1, "R" + audit, (f"{new}:{text}", *lines)))
        return min(ways, default=(1 << 40, "", ()))

    # from the end, so that no call goes deep
    for i in range(len(turns), -1, -1):
        for state in ("", "s", "u", "a"):
            best(i, state, 2)
    return best(0, "", 2)


def judged(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.rstrip(WHITE)
        fault = None
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif body[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain(data, ids=None):
    out = {}
    for conv in {c for c, *_ in (ids or data)}:
        turns = [r for r in data if r[0] == conv]
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = judged([(role, text) for _, _, role, text in turns])
        numbers = {t for _, t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        faults = [f for *_, f in found]
        pairs = zip(turns, turns[1:])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, lines = cheapest(tuple(found))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def got(rows):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def run(df):
    return got(r.asDict() for r in repair.report(df, repair.repair(df)).collect())


def test_op13(spark, sf_dir, result):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = result("op13_")
    assert len(rows) == len({c for c, *_ in data})
    assert got(rows) == plain(damaged(data), data)


ODD = [
    (1, None, None, None),
    (1, None, "user", "before the first."),
    (1, 3, "user", "x."),
    (1, 3, "user", "x."),
    (1, 3, "assistant", "x."),
    (1, 9, "system", " \t\n"),
    (None, 1, "user", "no id!"),
    (None, 1, "user", "no id!"),
    (None, 5, "", "no role?  "),
    (2, None, "unknown", "kept as it begins with u."),
    (3, 1, "system", "only a system turn."),
    (4, 1, "user", ""),
    (5, -7, "assistant", "long " * 30_000),
    (5, 9_000_000_000, "Über", "cut"),
    (6, 1, "user", "a "),
    (6, 2, "assistant", "é."),
]


def filled(data):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [4096, 2])
def test_odd_rows(rows, monkeypatch, segment):
    """Nulls in any column, empty and long texts, ties and repeated rows, clashing names."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    df = rows(SCHEMA, ODD, part="1", n="2", at="'x'", CONV_ID="5")
    assert run(df) == plain(filled(ODD))
    hurt = repair.damage(df)
    have = got(r.asDict() for r in repair.report(df, repair.repair(hurt)).collect())
    assert have == plain(damaged(ODD), ODD)


def test_empty_table(rows):
    assert run(rows(SCHEMA, [])) == {}


def test_nothing_left(rows):
    """A conversation whose rows the damage drops has a row of zeros."""
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = rows(SCHEMA, [(7, turn, "user", "gone.")])
    (row,) = repair.report(df, repair.repair(repair.damage(df))).collect()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversations(spark, rows, monkeypatch):
    """One conversation in several segments and tasks, and one row in a third of the table."""
    monkeypatch.setattr(repair, "SEGMENT", 16)
    roles = ["user", "assistant", "system", "tool"]
    data = [(1, i, roles[i * i % 7 % 4], f"{i % 97}{'.' if i % 5 else ''}") for i in range(600)]
    data += [(2, 5, "user", "again.")] * 500 + [(2, 6, "assistant", "yes.")]
    data += [(3, i, "user", "same.") for i in range(300)]
    found = run(rows(SCHEMA, data))
    assert found == plain(data)


SYMBOLS = [0, *range(1, 9)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(SYMBOLS), st.integers(1, 9)), max_size=6))
def test_unroll(runs):
    """Runs by powers give what single turns give, and the audit that the search gives."""
    roles = ["system", "user", "assistant", "tool"]
    turns = []
    for symbol, n in runs:
        for _ in range(n):
            role, cut = ("user", 0) if symbol == 0 else (roles[(symbol - 1) // 2], (symbol - 1) % 2)
            turns.append((role, "", "blank" if symbol == 0 else "truncated" if cut else None))
    cost, audit, _ = cheapest(tuple(turns))
    costs, pieces, states = repair.unroll(runs, repair._BOUNDARY)
    assert costs[0] == cost
    assert pieces[0] + "I" * repair._MISSING[states[0]] == audit


def test_turns(rows):
    """The repaired turns and edits themselves."""
    data = [(1, 1, "user", "Hi."), (1, 2, "user", "Hello?"), (1, 3, "user", "Hi."), (1, 4, "user", "Bye.")]
    done = repair.repair(rows(SCHEMA, data))
    order = ["part", "number", "at", "step"]
    found = [(r.action, r.turn, r.role, r.text, r.n) for r in done.turns.orderBy(*order).collect()]
    assert found == [
        ("D", 1, "user", "Hi.", 1),
        ("K", 2, "user", "Hello?", 1),
        ("D", 3, "user", "Hi.", 1),
        ("R", 4, "assistant", "Bye.", 1),
    ]
