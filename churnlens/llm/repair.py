"""Operator 13: conversation repair by Four-Russians block tables.

A repaired conversation has role initials ``(s?(ua)+)?``. Edits of a turn: K
keeps it (cost 0), R gives it the role user or assistant (3), D deletes it (4;
blank and duplicate turns must go), I inserts an empty user or assistant turn
(3); a truncated turn that stays costs 3 more. Of the cheapest edits the
ASCII-least string of initials is taken.

The role pattern has four states (nothing yet, after s, after u, after a). Read
from the end, a conversation has a vector of costs to go, one for each state.
The differences inside such vectors are bounded, so there are few of them
(``tables`` lists them all), and a turn has one of nine symbols. For every
vector and every block of ``BLOCK`` symbols a table holds the vector before the
block and the cost it adds. Vectors at block borders come from one look-up a
block, last block first; then each block is expanded backward from its right
border, and the edits are read off from the front, the least letter first of
those that keep the cost: a table of (vector, symbol, state). As the costs to go
are exact there, ties are safe.

Turns are sorted over the whole table by conversation and turn, in ranges, so a
conversation of any length is spread over tasks. One that lies inside a range is
repaired there. The rest (at a range's ends, or of more than ``PIECE`` turns) is
cut into pieces of at most ``PIECE`` turns. A piece's table maps each vector at
its right to that at its left; these maps are chained over a conversation's
pieces (one row each), every piece is then traced from all four states, and the
states are chained in turn.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import Scratch

BLOCK, PIECE = 4, 20_000
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SPACES = " \t\n\x0b\f\r"
#: States: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Where an inserted or re-roled turn leads, and its role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
GIVEN = ("u", "u", "a", "u")
KEEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: Symbols: 2 * (place of the initial in CLASSES) + truncated; the last one must be deleted.
CLASSES = ("s", "u", "a", "")
GONE, SYMBOLS = 8, 9
#: At the conversation's end: what is still inserted, the roles and the cost.
END = (("", "", 0), ("II", "ua", 2 * INSERT), ("I", "a", INSERT), ("", "", 0))
LEGAL = {"su", "ua", "au"}


class Tables(NamedTuple):
    vectors: tuple  # all vectors of costs to go, the least being 0; the first is the end's
    before: np.ndarray  # (vector, symbol) -> the vector before it
    added: np.ndarray  # (vector, symbol) -> the cost that the symbol adds to all states
    block_before: np.ndarray  # the same for blocks, whose code has the first symbol as its highest digit
    block_added: np.ndarray
    edit: list  # [vector after][symbol][state] -> (edits, roles, cost, state after)


def _moves(vector: tuple, symbol: int) -> list[dict[str, tuple[int, int]]]:
    """For each state the edits of a turn: letter -> (cost to go, state after)."""
    out = []
    for state in range(4):
        moves = {"D": (DELETE + vector[state], state)}
        if symbol != GONE:
            more = TRUNCATED * (symbol % 2)
            kept = KEEPS.get((state, CLASSES[symbol // 2]))
            if kept is not None:
                moves["K"] = (more + vector[kept], kept)
            moves["R"] = (REROLE + more + vector[NEXT[state]], NEXT[state])
        out.append(moves)
    return out


def _step(vector: tuple, symbol: int) -> list[int]:
    """Costs to go before a turn, inserts in front of it included."""
    least = [min(c for c, _ in m.values()) for m in _moves(vector, symbol)]
    u, a = least[AFTER_U], least[AFTER_A]
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(least[START], INSERT + u), min(least[AFTER_S], INSERT + u), u, a]


def _edit(vector: tuple, symbol: int, state: int) -> tuple[str, str, int, int]:
    """The least edits from ``state`` up to and with the turn, by the costs to go after it."""
    moves, costs = _moves(vector, symbol), _step(vector, symbol)
    edits = roles = ""
    spent = 0
    while True:
        options = {letter: cost for letter, (cost, _) in moves[state].items()}
        options["I"] = INSERT + costs[NEXT[state]]
        letter = min(x for x, cost in options.items() if cost == costs[state])
        edits += letter
        if letter == "I":
            roles, spent, state = roles + GIVEN[state], spent + INSERT, NEXT[state]
            continue
        after = moves[state][letter][1]
        if letter != "D":
            roles += CLASSES[symbol // 2] if letter == "K" else GIVEN[state]
        spent += moves[state][letter][0] - vector[after]
        return edits, roles, spent, after


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    """All vectors, found from the end's by every symbol, and the tables over them."""
    end = tuple(c for _, _, c in END)
    number, vectors, steps = {end: 0}, [end], []
    for vector in vectors:  # grows while it is read
        row = []
        for symbol in range(SYMBOLS):
            costs = _step(vector, symbol)
            low = min(costs)
            left = tuple(c - low for c in costs)
            if left not in number:
                number[left] = len(vectors)
                vectors.append(left)
            row.append((number[left], low))
        steps.append(row)
    grid = np.array(steps, np.int64)
    before, added = grid[..., 0], grid[..., 1]
    block_before, block_added = before, added
    for _ in range(BLOCK - 1):  # one more symbol in front
        block_added = (block_added[:, None, :] + added[block_before].transpose(0, 2, 1)).reshape(len(vectors), -1)
        block_before = before[block_before].transpose(0, 2, 1).reshape(len(vectors), -1)
    edit = [[[_edit(v, x, s) for s in range(4)] for x in range(SYMBOLS)] for v in vectors]
    return Tables(tuple(vectors), before, added, block_before, block_added, edit)


def _codes(symbols: list[int]) -> tuple[list[int], list[int]]:
    """Codes of the whole blocks, and the symbols left over at the end."""
    whole = len(symbols) // BLOCK * BLOCK
    digits = np.array(symbols[:whole], np.int64).reshape(-1, BLOCK)
    return (digits @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1, dtype=np.int64)).tolist(), symbols[whole:]


def vectors_after(symbols: list[int], right: int) -> list[int]:
    """The vector after each turn, given the one after the last: blocks by look-up from the
    end, then each block expanded backward from its right border."""
    t = tables()
    codes, rest = _codes(symbols)
    out = [0] * len(symbols)
    for i in range(len(symbols) - 1, len(symbols) - len(rest) - 1, -1):
        out[i] = right
        right = int(t.before[right, symbols[i]])
    borders = [right]
    for code in reversed(codes):
        borders.append(int(t.block_before[borders[-1], code]))
    for k, right in enumerate(reversed(borders[:-1])):  # the right border of block k
        for i in range(BLOCK * k + BLOCK - 1, BLOCK * k - 1, -1):
            out[i] = right
            right = int(t.before[right, symbols[i]])
    return out


def trace(symbols: list[int], after: list[int], state: int) -> tuple[list[tuple[str, str, int]], int]:
    """(edits, roles, cost) of each turn from ``state`` on, and the state after the last."""
    edit, out = tables().edit, []
    for symbol, vector in zip(symbols, after):
        edits, roles, cost, state = edit[vector][symbol][state]
        out.append((edits, roles, cost))
    return out, state


def piece_map(symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every vector at the piece's right: the one at its left, and the cost between."""
    t = tables()
    codes, rest = _codes(symbols)
    at, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64)
    for symbol in reversed(rest):
        cost += t.added[at, symbol]
        at = t.before[at, symbol]
    for code in reversed(codes):
        cost += t.block_added[at, code]
        at = t.block_before[at, code]
    return at, cost


def _with_end(edits: list[tuple[str, str, int]], state: int) -> list[tuple[str, str, int]]:
    """The last turn's edits with what the end of the conversation still needs."""
    last, end = edits[-1], END[state]
    return [*edits[:-1], (last[0] + end[0], last[1] + end[1], last[2] + end[2])]


def symbol_of(role: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return GONE
    initial = role[:1]
    return 2 * (CLASSES.index(initial) if initial and initial in CLASSES else 3) + (fault == "truncated")


def _fault(role: str, text: str, seen: set) -> str | None:
    shown = text.rstrip(SPACES)
    if not shown:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    seen.add((role, text))
    return None if shown[-1] in ".!?" else "truncated"


_EDIT = pa.struct([("edits", pa.string()), ("roles", pa.string()), ("cost", pa.int64())])
_COLUMNS = {"conv_id": pa.int64(), "part": pa.int32(), "piece": pa.int32(), "pos": pa.int32(), "turn": pa.int64(),
            "role": pa.string(), "text": pa.string(), "fault": pa.string(), "illegal": pa.bool_(), "new_turn": pa.bool_(),
            "edit": _EDIT}
_ROW = ("conv_id long, part int, piece int, pos int, turn long, role string, text string, fault string, "
        "illegal boolean, new_turn boolean")
_SPARK_EDIT = "struct<edits:string,roles:string,cost:long>"


def _scan(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Repair the conversations inside a range; mark the pieces of the others, whose ``edit`` is null.

    Rows come sorted by conversation and turn. The range's first and last
    conversations may go on in its neighbours, so they stay open."""
    none = object()
    conv, turns, piece, part, is_open, out = none, [], 0, 0, True, []

    def flush(whole: bool) -> None:
        nonlocal turns, piece
        if not turns:
            return
        seen: set = set()
        faults = [_fault(role, text, seen) for _, role, text in turns]
        edits: list = [None] * len(turns)
        if whole:
            symbols = [symbol_of(role, f) for (_, role, _), f in zip(turns, faults)]
            found, state = trace(symbols, vectors_after(symbols, 0), START)
            edits = [dict(zip(("edits", "roles", "cost"), e)) for e in _with_end(found, state)]
        before = None
        for pos, ((turn, role, text), fault, edit) in enumerate(zip(turns, faults, edits)):
            illegal = before is not None and before[1][:1] + role[:1] not in LEGAL
            new = turn is not None and (before is None or before[0] != turn)
            out.append((conv, part, piece, pos, turn, role, text, fault, illegal, new, edit))
            before = (turn, role)
        turns, piece = [], piece + 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(_COLUMNS)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COLUMNS.values())], names=list(_COLUMNS))

    for given in batches:
        columns = (given.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "part"))
        for c, turn, role, text, part in zip(*columns):
            if c != conv or conv is none:
                first = conv is none
                flush(not is_open)
                conv, is_open = c, first
            elif len(turns) >= longest:
                is_open = True
                flush(False)
            turns.append((turn, role, text))
        yield batch()
    flush(False)
    yield batch()


def _rows(table: pa.Table, *order: str) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: tuple(r[c] for c in order))


def _symbols(rows: list[dict]) -> list[int]:
    return [symbol_of(r["role"], r["fault"]) for r in rows]


_PIECE = ("conv_id long, part int, piece int, left array<int>, first_turn long, last_turn long, last_role string")
_CHAIN = "part int, piece int, right int, ends boolean, starts boolean, turn_before long, role_before string"


def _piece(table: pa.Table) -> pa.Table:
    rows = _rows(table, "pos")
    left, _ = piece_map(_symbols(rows))
    first, last = rows[0], rows[-1]
    return pa.table({"conv_id": pa.array([first["conv_id"]], pa.int64()), "part": pa.array([first["part"]], pa.int32()),
                     "piece": pa.array([first["piece"]], pa.int32()), "left": pa.array([left.tolist()], pa.list_(pa.int32())),
                     "first_turn": pa.array([first["turn"]], pa.int64()), "last_turn": pa.array([last["turn"]], pa.int64()),
                     "last_role": pa.array([last["role"]], pa.string())})


def _chain(table: pa.Table) -> pa.Table:
    """The vector at each piece's right, from the conversation's last piece on, and the turn before each piece."""
    rows = _rows(table, "part", "piece")
    right = [0] * len(rows)
    for i in range(len(rows) - 1, 0, -1):
        right[i - 1] = rows[i]["left"][right[i]]
    before = [None, *rows[:-1]]
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()),
                     "piece": pa.array([r["piece"] for r in rows], pa.int32()),
                     "right": pa.array(right, pa.int32()),
                     "ends": pa.array([i == len(rows) - 1 for i in range(len(rows))], pa.bool_()),
                     "starts": pa.array([b is None for b in before], pa.bool_()),
                     "turn_before": pa.array([b and b["last_turn"] for b in before], pa.int64()),
                     "role_before": pa.array([b and b["last_role"] for b in before], pa.string())})


def _trace(table: pa.Table) -> pa.Table:
    """A piece's edits from each of the four states, and the states after it (with its first turn)."""
    rows = _rows(table, "pos")
    first = rows[0]
    if not first["starts"]:
        first["illegal"] = first["role_before"][:1] + first["role"][:1] not in LEGAL
        first["new_turn"] = first["turn"] is not None and first["turn"] != first["turn_before"]
    symbols = _symbols(rows)
    after = vectors_after(symbols, first["right"])
    ways, exits = [], []
    for state in range(4):
        edits, state = trace(symbols, after, state)
        ways.append(_with_end(edits, state) if first["ends"] else edits)
        exits.append(state)
    names = [c for c in _COLUMNS if c != "edit"]
    columns = {c: pa.array([r[c] for r in rows], _COLUMNS[c]) for c in names}
    columns["ways"] = pa.array([[dict(zip(("edits", "roles", "cost"), e)) for e in four] for four in zip(*ways)], pa.list_(_EDIT))
    columns["exits"] = pa.array([exits] + [None] * (len(rows) - 1), pa.list_(pa.int32()))
    return pa.table(columns)


def _walk(table: pa.Table) -> pa.Table:
    """The state before each piece."""
    rows, state, states = _rows(table, "part", "piece"), START, []
    for r in rows:
        states.append(state)
        state = r["exits"][state]
    return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()),
                     "piece": pa.array([r["piece"] for r in rows], pa.int32()), "state": pa.array(states, pa.int32())})


def _across(scanned: DataFrame, scratch: Scratch) -> DataFrame:
    """The open pieces' rows, repaired over all pieces of their conversations."""
    rows = scanned.where("edit is null").drop("edit")
    # a text that an earlier piece has too; each piece brings a text once, so groups have a row a piece
    same = Window.partitionBy("conv_id", "key").orderBy("part", "piece")
    again = (rows.where("fault is null or fault = 'truncated'")
             .select("conv_id", "part", "piece", "pos", F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256).alias("key"))
             .withColumn("n", F.row_number().over(same)).where("n > 1").select("part", "piece", "pos", F.lit(True).alias("again")))
    rows = rows.join(again, ["part", "piece", "pos"], "left")
    rows = scratch.save(rows.withColumn("fault", F.when(F.col("again"), "duplicate").otherwise(F.col("fault"))).drop("again"), "open")
    pieces = rows.select(*[c for c in rows.columns if c != "text"]).groupBy("part", "piece").applyInArrow(_piece, _PIECE)
    chain = pieces.groupBy("conv_id").applyInArrow(_chain, _CHAIN)
    traced = rows.join(chain, ["part", "piece"]).groupBy("part", "piece").applyInArrow(
        _trace, f"{_ROW}, ways array<{_SPARK_EDIT}>, exits array<int>")
    traced = scratch.save(traced, "traced")
    states = traced.where("exits is not null").select("conv_id", "part", "piece", "exits").groupBy("conv_id").applyInArrow(
        _walk, "part int, piece int, state int")
    return traced.join(states, ["part", "piece"]).withColumn("edit", F.get("ways", "state")).select(*scanned.columns)


def repair(turns: DataFrame, longest: int = PIECE) -> DataFrame:
    """The edits of every turn of ``turns`` (conv_id, turn, role, text).

    A conversation's turns go by turn (nulls first), then role, then the
    text's first 32 characters, then its hash. One row for each row: conv_id,
    part, piece, pos (together the order), turn, role, text, fault (the first
    that holds: blank, no character but ASCII white space; duplicate, role and
    text seen earlier; truncated, last such character not ``.!?``; or null),
    illegal (its role's initial may not follow the one before), new_turn (not
    null and not the turn before), edits, roles (initials of what the edits
    put out), cost. Inserts at the end belong to the last turn.

    Null ids are one conversation; null roles and texts are empty; repeated
    rows are duplicates. An empty table gives no rows; other columns are
    ignored. ``longest``: most turns of a piece."""
    scratch = Scratch(turns.sparkSession, "repair")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    order = ["conv_id", "turn", "role", F.substring("text", 1, 32), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    scanned = scratch.save(rows.mapInArrow(functools.partial(_scan, longest=longest), f"{_ROW}, edit {_SPARK_EDIT}"), "scanned")
    all_rows = scanned.where("edit is not null").unionByName(_across(scanned, scratch))
    return all_rows.select("*", "edit.edits", "edit.roles", "edit.cost").drop("edit")


def repaired_turns() -> Column:
    """Of a row of ``repair``: the turns that its edits put out, array<struct<role, text>>."""
    names = F.create_map(F.lit("u"), F.lit("user"), F.lit("a"), F.lit("assistant"))
    letters = F.split(F.replace("edits", F.lit("D"), F.lit("")), "")
    letters = F.when(F.length(F.replace("edits", F.lit("D"), F.lit(""))) > 0, letters).otherwise(F.array().cast("array<string>"))
    return F.transform(letters, lambda x, i: F.struct(
        F.when(x == "K", F.col("role")).otherwise(F.element_at(names, F.substring(F.col("roles"), i + 1, F.lit(1)))).alias("role"),
        F.when(x == "I", "").otherwise(F.col("text")).alias("text")))


def report(repaired: DataFrame) -> DataFrame:
    """Counts of each conversation of ``repair``'s rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost."""
    fault = lambda x: F.count_if(F.coalesce(F.col("fault") == x, F.lit(False))).alias(x)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0).cast("long"))
    return repaired.groupBy("conv_id").agg(gaps.alias("gaps"), fault("blank"), fault("duplicate"), fault("truncated"),
                                           F.count_if("illegal").alias("illegal"), F.sum("cost").alias("cost"))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with the query's fixed damage (nulls are one space)."""
    def blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return (turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"),
                         text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("_times"), kind.alias("_kind"))
            .where("_kind <> 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times")))
            .select("conv_id", "turn", "role", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of all ``conversations`` after the fixed damage.

    The audit and the digest cover a whole conversation, so those two are one value each here."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    scratch = Scratch(spark, "repaired")
    rows = scratch.save(repair(damaged(turns)), "rows")
    line = lambda x: F.concat(x["role"], F.lit(":"), x["text"])
    lines = rows.select("conv_id", F.struct("part", "piece", "pos", "edits", F.transform(repaired_turns(), line).alias("lines")).alias("r"))
    whole = lines.groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("r"))
    whole = whole.select("conv_id", F.array_join("r.edits", "").alias("audit"),
                         F.sha2(F.array_join(F.flatten("r.lines"), "\n"), 256).alias("repaired_sha256"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = report(rows).withColumnRenamed("conv_id", "_id")
    whole = whole.withColumnRenamed("conv_id", "_whole")
    ids = turns.select("conv_id").distinct()
    return (ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
            .join(whole, F.col("conv_id").eqNullSafe(F.col("_whole")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def _oracle() -> str:
    """The query's result for DuckDB: the least (cost, audit) of each state, row by row from the front.

    A way is a list: cost in eight digits and then the audit; the lines put out, each after a line break."""
    def go(way: str, cost: str, letter: str, line: str = "''") -> str:
        return (f"case when {way} is not null then [lpad(cast(cast(left({way}[1], 8) as int) + {cost} as varchar), 8, '0') "
                f"|| substr({way}[1], 9) || '{letter}', {way}[2] || {line}] end")

    def least(*ways: str) -> str:
        return "list_min([" + ", ".join(f"({w})" for w in ways) + "])"

    def line(role: str, text: str) -> str:
        return f"chr(10) || {role} || ':' || {text}"

    def insert(way: str, role: str) -> str:
        return go(way, str(INSERT), "I", line(f"'{role}'", "''"))

    def drop(way: str) -> str:
        return go(way, str(DELETE), "D")

    def keep(way: str, initial: str) -> str:
        return f"case when initial = '{initial}' and not gone then {go(way, 'more', 'K', line('role', 'body'))} end"

    def rerole(way: str, role: str) -> str:
        return f"case when not gone then {go(way, f'more + {REROLE}', 'R', line(repr(role), 'body'))} end"

    space = r"\x20\x09-\x0D"
    return f"""
with recursive crc(t) as (select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n))),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as body,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
kinds as (
  select *, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: cast(ascii(substr(key, i, 1)) as bigint)),
    lambda c, b: xor(c >> 8, t[cast((xor(c, b) & 255) + 1 as int)]), 4294967295), 4294967295) % 20 as kind from given, crc),
damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(body, '[.!?]', '', 'g') else body end as body
  from kinds, (values (1), (2)) c(copy) where kind <> 0 and (copy = 1 or kind = 3)),
numbered as (
  select *, dense_rank() over (order by conv_id nulls first) as c,
    row_number() over (partition by conv_id order by turn nulls first, role, body) as i from damaged),
marked as (
  select *, left(role, 1) as initial, not regexp_matches(body, '[^{space}]') as blank,
    row_number() over (partition by c, role, body order by i) > 1 as again,
    regexp_extract(body, '([^{space}])[{space}]*$', 1) not in ('.', '!', '?') as cut,
    lag(left(role, 1)) over (partition by c order by i) || left(role, 1) not in ('su', 'ua', 'au') as bad from numbered),
turns as (
  select *, blank or again as gone, not blank and again as duplicate, not blank and not again and cut as truncated,
    case when not blank and not again and cut then {TRUNCATED} else 0 end as more from marked),
ways as (
  select distinct c, cast(0 as bigint) as i, ['00000000', ''] as z, cast(null as varchar[]) as s,
    ['0000000{INSERT}I', chr(10) || 'user:'] as u, ['0000000{2 * INSERT}II', chr(10) || 'user:' || chr(10) || 'assistant:'] as a from turns
  union all
  select c, i, z, s, u, {least("a", insert("u", "assistant"))} as a from (
    select c, i, z, s, a, {least("u", insert("z", "user"), insert("s", "user"), insert("a", "user"))} as u from (
      select w.c, t.i, {drop("w.z")} as z, {least(drop("w.s"), keep("w.z", "s"))} as s,
        {least(drop("w.u"), *(f(w, x) for f, x in ((keep, "u"), (rerole, "user")) for w in ("w.z", "w.s", "w.a")))} as u,
        {least(drop("w.a"), keep("w.u", "a"), rerole("w.u", "assistant"))} as a
      from ways w join turns t on t.c = w.c and t.i = w.i + 1))),
found as (
  select c, {least("z", "a")} as way from ways qualify row_number() over (partition by c order by i desc) = 1),
counts as (
  select c, any_value(conv_id) as conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count_if(blank) as blank, count_if(duplicate) as duplicate, count_if(truncated) as truncated, count_if(bad) as illegal
  from turns group by c)
select g.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(cast(left(way[1], 8) as int), 0) as bigint) as cost,
  coalesce(substr(way[1], 9), '') as audit, sha256(coalesce(substr(way[2], 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) g left join counts on counts.conv_id is not distinct from g.conv_id
  and counts.c is not null left join found using (c)
"""


ORACLE = _oracle()
