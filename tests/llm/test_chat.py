"""Operator 8: windows give back every turn, targets once, within the budget."""

import random
import re

from churnlens.llm import chat

TURNS = [(1, 0, "system", "be <brief> \\ now"), (1, 1, "user", "hi </turn>\n there"), (1, 2, "assistant", "\\l \\b <turn user>\n"),
         (2, 0, "assistant", chat.ADDED), (3, 0, "user", None), (3, 1, None, "no role"), (3, 1, None, "no role"), (3, 2, "a>b\n<c", "odd"),
         (None, 0, "user", "x"), (None, 1, "assistant", "y"), (4, None, "user", "first"), (4, 0, "assistant", ""), (5, 0, "system", "only")]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """conv_id -> turns in order."""
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in out.items()}


def check(spark, rows, window, history):
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pos", "2 as tokens", "'w' as window"), window, history)
    back = {}
    for r in chat.read_back(windows).collect():
        back.setdefault(r.conv_id, []).append((r.window, [(t.role, t.text) for t in r.turns], r.target))
    want = expected(rows)
    assert set(back) == set(want)
    for c, parts in back.items():
        parts.sort()
        assert [w for w, _, _ in parts] == list(range(len(parts)))
        assert [t for _, turns, _ in parts for t in turns] == want[c]
        assert "".join(t for _, _, t in parts) == "".join(x for r, x in want[c] if r == "assistant")
    return windows, want


def tokens(text):
    return chat.TURN + len(re.findall(r"[^\W_]+|[^\w\s]|_", text))


def test_odd_turns(spark):
    check(spark, TURNS, 1024, 192)
    check(spark, TURNS, 16, 6)
    assert chat.format_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_budget_system_and_history(spark):
    random.seed(9)
    rows = []
    for c in range(12):
        if c % 2:
            rows.append((c, 0, "system", "you are kind " * random.randint(1, 4)))
        rows += [(c, 1 + t, "user" if t % 2 == 0 else "assistant", "word " * random.randint(0, 60)) for t in range(random.randint(1, 40))]
    windows, want = check(spark, rows, 120, 40)
    for r in windows.collect():
        turns = re.findall(r"<turn (\w+)>\n(.*?)</turn>\n", r.formatted, re.S)
        assert len(turns) == r.n_turns and "".join(f"<turn {a}>\n{b}</turn>\n" for a, b in turns) == r.formatted
        costs = [tokens(b) for _, b in turns]
        held = costs[0] if turns[0][0] == "system" else 0
        new = sum(costs[r.n_repeated:]) - (held if r.window == 0 else 0)
        repeated = sum(costs[:r.n_repeated]) - (held if r.window else 0)
        assert repeated <= 40 and (new <= max(120 - 40 - held, 30) or len(costs) - r.n_repeated == 1)
        assert (turns[0][0] == "system") == (want[r.conv_id][0][0] == "system")
        assert r.n_repeated < r.n_turns
        spans = [r.formatted[s.start:s.start + s.length] for s in r.loss]
        assert spans == [b for a, b in turns[r.n_repeated:] if a == "assistant"]


def test_long_conversation_over_ranges(spark):
    """A third of all rows in one conversation: it lies in several ranges, and its windows are those of one range."""
    random.seed(4)
    rows = [(7, 0, "system", "be kind")] + [(7, 1 + t, "user" if t % 2 == 0 else "assistant", "word " * random.randint(0, 30)) for t in range(300)]
    rows += [(c, t, random.choice(["user", "assistant", "system"]), "word " * random.randint(0, 90)) for c in range(100) for t in range(random.randint(1, 8))]
    key = lambda x: sorted((r.conv_id, r.window, r.formatted, [(s.start, s.length) for s in r.loss], r.n_turns, r.n_repeated) for r in x.collect())
    one = key(check(spark, rows, 120, 40)[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, SCHEMA)
        scratch = chat.Scratch(spark, "chat-test")
        assert chat._in_ranges(turns, scratch).where("conv_id = 7").select("part").distinct().count() > 1
        many = key(check(spark, rows, 120, 40)[0])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert one == many and sum(r[0] == 7 for r in one) > 30
