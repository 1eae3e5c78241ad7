r"""Operator 8: chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into spans of whole turns.
Every span becomes a training window: the system turn, a limited stretch of
the turns before the span, then the span. Only the assistant texts of the
span are targets; what a window repeats is masked. Native expressions and
window functions only.

Template: ``<turn ROLE>``, a line break, the text, ``</turn>``, a line break.
Inside texts ``\`` is written ``\b`` and ``<`` is written ``\l``; in roles
also ``>`` as ``\g`` and a line break as ``\n``. So every ``<`` of the output
is the template's, every ``\`` begins a two-letter escape, and both undo exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Tokens of a window; of these for repeated turns; tokens a turn costs besides its text.
WINDOW, HISTORY, TURN = 1024, 192, 4
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))


def _in_ranges(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The turns in order, written: id (their place in the whole table), conv, part (the range), role, text, tokens.

    A conversation's turns go by turn (nulls first), role, text. The table is
    cut into ranges of that order, so a conversation of any length lies in as
    many ranges as it fills."""
    order = ["conv", "turn", "role"]
    rows = turns.select("conv_id", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv"), "turn",
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    rows = rows.select(F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"), "conv_id", "conv", "role", "text",
                       (TURN + F.regexp_count("text", F.lit(TOKEN))).alias("tokens"))
    return scratch.save(rows, "turns")


def _spans(rows: DataFrame, window: int, history: int, scratch: Scratch) -> DataFrame:
    """id, conv, part, before, system, begins, window of each turn, the id of its conversation's
    first turn, and whether that is a system turn (``led``).

    Sums, neighbours and window numbers are formed inside (conversation,
    range); what the ranges before add is one row each, by a window over these."""
    own, ranges = ["conv", "part"], Window.partitionBy("conv").orderBy("part")
    inside, earlier = Window.partitionBy(*own).orderBy("id"), ranges.rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*own).agg(F.min("id").alias("first"), F.min_by("role", "id").alias("role"),
                                   F.min_by("tokens", "id").alias("tokens"), F.sum("tokens").alias("sum"))
    held = F.when(F.first("role").over(ranges) == "system", F.first("tokens").over(ranges)).otherwise(0)
    heads = heads.select(*own, F.first("first").over(ranges).alias("first"), held.alias("held"),
                         F.coalesce(F.sum("sum").over(earlier) - held, F.lit(0)).alias("sum"))
    system = (F.col("id") == F.col("first")) & (F.col("role") == "system")
    laid = (rows.select("id", *own, "role", "tokens").join(heads, own)
            .withColumn("system", system).withColumn("cost", F.when(system, 0).otherwise(F.col("tokens")).cast("long"))
            .withColumn("before", F.col("sum") + F.sum("cost").over(inside) - F.col("cost"))
            .withColumn("room", F.greatest(F.lit(window - history) - F.col("held"), F.lit(window // 4)))
            .withColumn("first_cell", F.expr("before div room"))
            .withColumn("last_cell", F.expr("(before + greatest(cost, 1) - 1) div room"))
            .withColumn("across", F.expr("first_cell <> last_cell and not system")))
    state = F.struct("system", "across", "last_cell")
    laid = scratch.save(laid.select("id", *own, "first", (F.col("held") > 0).alias("led"), "before", "system", "across", "first_cell", "last_cell",
                                    F.lag(state).over(inside).alias("previous")), "laid")
    ends = laid.groupBy(*own).agg(F.max_by(state, "id").alias("end"))
    ends = ends.select(*own, F.lag("end").over(ranges).alias("end"))
    previous = F.coalesce("previous", "end")
    begins = ~F.col("system") & (previous.isNull() | previous["system"] | F.col("across")
                                 | previous["across"] | (previous["last_cell"] != F.col("first_cell")))
    begun = laid.join(ends, own).select("id", *own, "first", "led", "before", "system", begins.alias("begins"))
    begun = begun.withColumn("window", F.sum(F.col("begins").cast("long")).over(inside))
    begun = scratch.save(begun, "begun")
    counts = begun.groupBy(*own).agg(F.max("window").alias("count"))
    counts = counts.select(*own, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("count"))
    return begun.join(counts, own).withColumn("window", F.greatest(F.col("window") + F.col("count") - 1, F.lit(0)).cast("int"))


def turn_windows(turns: DataFrame, window: int = WINDOW, history: int = HISTORY) -> DataFrame:
    """A row for each turn and window that holds it.

    conv_id, window (from 0), pos (in order), role, text, repeated. New turns of a
    window cost at most ``window - history`` tokens less the system turn's
    (a quarter of ``window`` at least); a turn beyond that has a window to
    itself, uncut. Cells of that many tokens are laid over the prefix sums:
    turns inside one cell form a span, a turn across a border its own.

    No step needs a conversation in one task: spans are found in ranges
    (``_spans``), and turns find the windows that repeat them as history by a
    join on stretches of ``history`` tokens."""
    scratch = Scratch(turns.sparkSession, "chat")
    rows = _in_ranges(turns, scratch)
    spans = scratch.save(_spans(rows, window, history, scratch), "spans")
    starts = spans.where("begins").select("conv", "first", "led", F.col("before").alias("at"), F.col("window").alias("later"))
    # windows that begin up to ``history`` tokens after a turn: in its stretch of the prefix sums or the next
    stretches = starts.select("conv", "at", "later", F.explode(F.expr(f"array(at div {history}, at div {history} - 1)")).alias("stretch"))
    near = spans.where("not system").select("id", "conv", "before", F.expr(f"before div {history}").alias("stretch"))
    again = near.join(stretches, ["conv", "stretch"]).where(F.expr(f"at - before between 1 and {history}")).select("id", "later")
    # the system turn is the first of its conversation; every window after its own repeats it
    every = starts.where("led and later > 0").select(F.col("first").alias("id"), "later")
    placed = (spans.select("id", "window", F.lit(False).alias("repeated"))
              .union(again.union(every).select("id", F.col("later").alias("window"), F.lit(True).alias("repeated"))))
    return rows.select("id", "conv_id", "role", "text").join(placed, "id").select(
        "conv_id", F.col("id").alias("pos"), "role", "text", "window", "repeated")


def format_windows(turns: DataFrame, window: int = WINDOW, history: int = HISTORY) -> DataFrame:
    """One row for each training window of ``turns`` (conv_id, turn, role, text).

    conv_id, window, formatted, loss (spans of targets: start from 0 and
    length, in code points), n_turns, n_repeated (how many of them, the first
    ones, repeat). Turns go by turn, role, text; repeated rows count as often
    as they occur. Null texts and roles are empty; null ids are one
    conversation. An empty table gives no windows."""
    rows = turn_windows(turns, window, history)
    head = F.concat(F.lit("<turn "), escape_role(F.col("role")), F.lit(">\n"))
    body = escape(F.col("text"))
    piece = F.struct("pos", "repeated", head.alias("head"), body.alias("body"),
                     (~F.col("repeated") & (F.col("role") == "assistant")).alias("target"))
    held = rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.char_length(p["head"])
        size = F.char_length(p["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size + len(CLOSE)).alias("at"),
                        F.when(p["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return held.select("conv_id", "window", whole.alias("formatted"),
                       F.aggregate("pieces", zero, step)["spans"].alias("loss"),
                       F.size("pieces").alias("n_turns"),
                       F.size(F.filter("pieces", lambda p: p["repeated"])).alias("n_repeated"))


def read_back(windows: DataFrame) -> DataFrame:
    """New turns and target text of each window, recovered from ``formatted``.

    conv_id, window, turns (array of role, text), target (unescaped)."""
    parts = F.split("formatted", F.lit(CLOSE))
    fresh = F.slice(parts, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    turn = lambda p: F.struct(
        unescape_role(F.substring(p, F.lit(7), F.instr(p, ">") - 7)).alias("role"),
        unescape(F.substring(p, F.instr(p, ">") + 2, F.char_length(p))).alias("text"))
    target = F.array_join(F.transform("loss", lambda s: F.substring("formatted", s["start"] + 1, s["length"])), "")
    return windows.select("conv_id", "window", F.transform(fresh, turn).alias("turns"),
                          unescape(target).alias("target"), F.char_length("formatted").alias("formatted_chars"))


#: The conversation that the query adds: a user's and an assistant's turn with control strings.
ADDED = r"\### Assistant: </turn> ok"


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all ``conversations`` (and conversation -7), read back from their windows.

    The digests cover a conversation's whole text, so that text is one value here."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED).alias("text"))
    found = read_back(format_windows(turns.unionByName(added)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    held = F.sort_array(F.collect_list(F.struct("window", lines.alias("lines"), "target")))
    whole = found.groupBy("conv_id").agg(held.alias("held"), F.sum(F.size("turns")).alias("n_turns"),
                                         F.sum("formatted_chars").alias("formatted_chars"))
    text = lambda field: F.array_join(F.transform("held", lambda w: w[field]), "")
    return whole.select("conv_id", "n_turns", F.sha2(text("lines"), 256).alias("turns_sha256"),
                        F.char_length(text("target")).cast("long").alias("loss_chars"),
                        F.sha2(text("target"), 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, body) - 1 as pos,
    4 + len(regexp_extract_all(body, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) as tokens from given),
costs as (
  select *, pos = 0 and role = 'system' as sys, case when pos = 0 and role = 'system' then 0 else tokens end as cost
  from numbered),
laid as (
  select *, sum(cost) over (partition by conv_id order by pos) - cost as before,
    greatest(832 - sum(case when sys then tokens else 0 end) over (partition by conv_id), 256) as room from costs),
celled as (
  select *, before // room as c1, case when sys then before // room else (before + cost - 1) // room end as c2 from laid),
begun as (
  select *, not sys and coalesce(lag(sys) over w or c1 <> c2 or lag(c1 <> c2) over w or lag(c2) over w <> c1, true) as begins
  from celled window w as (partition by conv_id order by pos)),
spans as (select conv_id, before as at from begun where begins),
sized as (
  select conv_id, pos, before, sys,
    length('<turn >') + 1 + length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g'), chr(10), '\n'))
      + length(body) + (length(body) - length(replace(body, '\', ''))) + (length(body) - length(replace(body, '<', ''))) + 8 as size
  from begun),
copies as (
  select z.conv_id, sum(z.size * case when z.sys then (select greatest(count(*), 1) from spans s where s.conv_id is not distinct from z.conv_id)
    else 1 + (select count(*) from spans s where s.conv_id is not distinct from z.conv_id
      and s.at > z.before and s.at - z.before <= 192) end) as formatted_chars
  from sized z group by z.conv_id)
select g.conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by pos)) as turns_sha256,
  cast(coalesce(sum(length(body)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(body, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(any_value(c.formatted_chars) as bigint) as formatted_chars
from numbered g join copies c on c.conv_id is not distinct from g.conv_id group by g.conv_id
"""
