"""Operator 13: every conversation against the least (cost, audit) over all edit strings."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from churnlens.llm import repair

STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """(fault, role, text) of each row."""
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, repaired lines) by the least (cost, audit) at each place and state, front to back."""
    def inserts(states):
        queue = list(states)
        while queue:
            state = queue.pop()
            cost, audit, lines = states[state]
            for role, to in STEPS[state].items():
                if role != "s":
                    new = (cost + 3, audit + "I", (*lines, f"{NAMES[role]}:"))
                    if to not in states or new[:2] < states[to][:2]:
                        states[to] = new
                        queue.append(to)
        return states

    states = inserts({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults(rows)):
        after = {}

        def put(to, new):
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for state, (cost, audit, lines) in states.items():
            put(state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if role[:1] and role[:1] in STEPS[state]:
                put(STEPS[state][role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for given, to in STEPS[state].items():
                if given != "s":
                    put(to, (cost + more + 3, audit + "R", (*lines, f"{NAMES[given]}:{text}")))
        states = inserts(after)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def summary(rows):
    """``rows`` (turn, role, text) in order -> counts, cost, audit, digest."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    said = [(r, t) for _, r, t in rows]
    f = faults(said)
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
    cost, audit, lines = best(said)
    return (gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(r, n):
    """Rows with turns in order, some of them null, repeated or left out."""
    turns = sorted(r.choices(range(2 * n + 2), k=n)) if r.random() < 0.3 else list(range(n))
    rows = [[t, r.choice(("user", "assistant", "user", "assistant", "system", "tool", "", "unknown")),
             f"{r.choice(('yes', 'no', 'é', 'a longer text'))}{i // 2 if r.random() < 0.5 else ''}" +
             r.choice((".", "!", "? ", ".\n", "", " \t", ",", "…"))] for i, t in enumerate(turns)]
    for row in rows:
        if r.random() < 0.1:
            row[2] = r.choice(("", " ", "\n\t"))
        if r.random() < 0.1:
            row[1] = "user" if row[1] == "assistant" else "assistant"
    return [tuple(row) for row in rows]


def test_tables():
    t = repair.tables()
    assert len(t.vectors) < 250 and t.block_before.shape == (len(t.vectors), 9 ** repair.BLOCK)
    r = random.Random(1)
    for _ in range(50):  # a block's entry is its symbols' entries in turn, last first
        block, v, cost = [r.randrange(9) for _ in range(repair.BLOCK)], r.randrange(len(t.vectors)), 0
        at = v
        for x in reversed(block):
            cost, at = cost + t.added[at, x], t.before[at, x]
        (code,), rest = repair._codes(block)
        assert (at, cost, rest) == (t.block_before[v, code], t.block_added[v, code], [])


def test_edits():
    r = random.Random(7)
    for n in [*range(1, 9)] * 60 + [30, 61, 200]:
        rows = [(role, text) for _, role, text in conversation(r, n)]
        symbols = [repair.symbol_of(role, f) for (role, _), f in zip(rows, faults(rows))]
        edits, state = repair.trace(symbols, repair.vectors_after(symbols, 0), repair.START)
        edits = repair._with_end(edits, state)
        cost, audit, lines = best(rows)
        assert ("".join(e for e, _, _ in edits), sum(c for _, _, c in edits)) == (audit, cost)
        assert "".join(x for _, x, _ in edits) == "".join(line[:1] for line in lines)
        left, added = repair.piece_map(symbols)  # the whole as one piece
        assert added[0] + repair.tables().vectors[left[0]][repair.START] == cost


@pytest.mark.parametrize("piece", [20_000, 7])
def test_conversations(spark, piece):
    """Whole conversations, ones cut at ranges' ends, and one of a third of all rows in many pieces."""
    r = random.Random(piece)
    given = {c: conversation(r, r.randrange(1, 12)) for c in range(60)}
    given[99] = [(i, role, text) for i, (_, role, text) in enumerate(conversation(r, 260))]
    rows = [(c, *row) for c, turns in given.items() for row in turns]
    r.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges of so few rows
    try:
        out = repair.repair(turns, piece).collect()
        counts = {x.conv_id: x for x in repair.report(repair.repair(turns, piece)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == len(rows) and len({x.part for x in out}) == 4
    assert len({(x.part, x.piece) for x in out if x.conv_id == 99}) > (1 if piece > 7 else 30)
    for c in given:
        mine = sorted((x for x in out if x.conv_id == c), key=lambda x: (x.part, x.piece, x.pos))
        expected = summary([(x.turn, x.role, x.text) for x in mine])
        assert [x.turn for x in mine] == sorted(t for t, _, _ in given[c])
        assert ("".join(x.edits for x in mine), sum(x.cost for x in mine)) == (expected[6], expected[5])
        assert tuple(counts[c])[1:] == expected[:6]


def test_query(spark, tmp_path):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    r = random.Random(4)
    rows += [(c, *row) for c in range(1000, 1150) for row in conversation(r, r.randrange(1, 10))]
    rows = list({(c, t): (c, t, a, b) for c, t, a, b in rows}.values())
    rows += [(None, 1, "user", "Yes."), (None, 2, "assistant", None), (2000, None, None, None), (2001, None, "user", "x."),
             (2002, 5, "user", "Long " * 5000 + "."), (2002, 6, "assistant", "Fine."), (2002, 9, "assistant", "Fine.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {x.conv_id: tuple(x)[1:] for x in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    given = {}
    for c, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        given.setdefault(c, []).extend([(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    for turns in given.values():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert {x[0]: x[1:] for x in con.sql(repair.ORACLE).fetchall()} == found
    assert found.keys() == given.keys()
    for c, turns in given.items():
        assert found[c] == (summary(turns) if turns else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())), c


def test_nothing_and_clashing_names(spark):
    schema = "conv_id long, turn int, role string, text string, part string, piece int, pos int, edit string, n int"
    assert repair.repair(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 1, "user", "Hello.", "p", 1, 2, "e", 3), (1, 1, "user", "Hello.", "p", 1, 2, "e", 3), (1, None, None, None, "p", 1, 2, "e", 3)]
    out = sorted(repair.repair(spark.createDataFrame(rows, schema)).collect(), key=lambda x: x.pos)
    assert [(x.fault, x.edits) for x in out] == [("blank", "D"), (None, "K"), ("duplicate", "DI")]
