"""Records of quoted CSV files, read by many tasks per file (A1).

A quoted value may hold line breaks, so a task that starts in the middle of a
file cannot tell from its first line whether it is inside a value. What a line
does to that state can be told, though: from each of the two states (outside,
inside a quoted value) it leads to one of them. These maps compose:

1. Each split composes the maps of its lines (``_split_maps``); only lines with
   a quote are looked at, as all others keep the state.
2. A file's splits are chained in order, from "outside" (``_state_changes``).
   What is kept are the splits that end in another state than they start in:
   two for each record that crosses a border.
3. Each task starts in its split's true state and puts lines together to
   records. Pieces of records that cross borders are joined by file and place.

A record is parsed by Spark's own CSV parser. The files are scanned twice, and
once more if a record crosses a border; every scan is split like any text.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Quoted text up to (not with) its closing quote; a field and its comma; a value that the line doesn't close.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+)?,)*+'
_OPEN = rf'"{_QUOTED}$'
#: Lines that end inside a value if they start outside one, and if they start inside one.
STARTS_VALUE = rf'(?s)^{_FIELD}{_OPEN}'
STAYS_INSIDE = rf'(?s)^{_QUOTED}(?:$|"[^,]*+,{_FIELD}{_OPEN})'
#: What a line does to the state: bit 0 is the state after it from outside, bit 1 from inside.
SAME, SWAP, TO_OUT, TO_IN = 0b10, 0b01, 0b00, 0b11
MAX_HEADERS = 100


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file (a hash of its path), block (where its split begins), whole (the file is one split), map."""
    rows = spark.read.option("lineSep", "\n").text(path)
    m = "_metadata"
    quoted = F.col("value").contains('"')
    effect = (F.when(F.col("value").rlike(STARTS_VALUE), 1).otherwise(0)
              + F.when(F.col("value").rlike(STAYS_INSIDE), 2).otherwise(0))
    return rows.select("value", F.xxhash64(F.col(f"{m}.file_path")).alias("file"), F.col(f"{m}.file_block_start").alias("block"),
                       (F.col(f"{m}.file_block_length") == F.col(f"{m}.file_size")).alias("whole"),
                       F.when(quoted, effect).otherwise(SAME).cast("tinyint").alias("map"))


def _after(maps: np.ndarray, start: int) -> np.ndarray:
    """The state (0 outside, 1 inside) after each line, from ``start``."""
    swaps = np.cumsum(maps == SWAP)
    fixed = (maps == TO_OUT) | (maps == TO_IN)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(maps)), -1))
    base = np.where(last >= 0, (maps[last] == TO_IN).astype(np.int64), start)
    return (base + swaps - np.where(last >= 0, swaps[last], 0)) & 1


def _changes(batch: pa.RecordBatch, *names: str) -> list[int]:
    """Indices where a batch's rows go over to another split, with 0 and the end."""
    new = np.zeros(batch.num_rows, bool)
    for name in names:
        column = batch.column(name)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    return [0, *np.flatnonzero(new).tolist(), batch.num_rows]


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its map, and its first line that may be a header."""
    at, ends, header = None, (0, 1), None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([ends[0]], pa.int32()),
             pa.array([ends[1]], pa.int32()), pa.array([header], pa.string())], names=["file", "block", "from_out", "from_in", "header"])

    for batch in batches:
        if not batch.num_rows:
            continue
        borders = _changes(batch, "file", "block")
        maps = batch.column("map").to_numpy().astype(np.int64)
        for a, b in zip(borders, borders[1:]):
            here = (batch.column("file")[a].as_py(), batch.column("block")[a].as_py())
            if here != at:
                if at is not None:
                    yield row()
                at, ends, header = here, (0, 1), None
            ends = tuple(int(_after(maps[a:b], start)[-1]) for start in ends)
            if header is None:
                header = next((x for x in batch.column("header").slice(a, b - a).to_pylist() if x is not None), None)
    if at is not None:
        yield row()


def _chain(table: pa.Table) -> pa.Table:
    """Of one file: the splits that end in another state than they start in."""
    state, rows = 0, []
    for r in sorted(table.to_pylist(), key=lambda r: r["block"]):
        after = r["from_in"] if state else r["from_out"]
        if after != state:
            rows.append((r["file"], r["block"], after))
        state = after
    files, blocks, states = zip(*rows) if rows else ((), (), ())
    return pa.table({"file": pa.array(files, pa.int64()), "block": pa.array(blocks, pa.int64()), "state": pa.array(states, pa.int32())})


def _records(changes: dict[int, list[tuple[int, int]]], headers: list[str]):
    """Put lines together; kind 0: a record, 1: more of one from an earlier split, 2: one that goes on in the next."""
    names = ["record", "file", "block", "kind", "closed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, first, head, pending = None, 0, False, False, []

        def out(records: pa.Array, kind: int, closed: bool) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays([records, pa.array([at[0]] * n, pa.int64()), pa.array([at[1]] * n, pa.int64()),
                                               pa.array([kind] * n, pa.int32()), pa.array([closed] * n, pa.bool_())], names=names)

        def rest() -> Iterator[pa.RecordBatch]:
            if pending:
                yield out(pa.array(["\n".join(pending)], pa.string()), 1 if head else 2, False)

        for batch in batches:
            if not batch.num_rows:
                continue
            borders = _changes(batch, "file", "block")
            all_maps = batch.column("map").to_numpy().astype(np.int64)
            for a, b in zip(borders, borders[1:]):
                here = (batch.column("file")[a].as_py(), batch.column("block")[a].as_py())
                if here != at:
                    yield from rest()
                    at, pending = here, []
                    known = changes.get(at[0], [])
                    before = bisect.bisect_left(known, (at[1], -1))
                    state = known[before - 1][1] if before else 0
                    first, head = at[1] == 0, state == 1
                values, after = batch.column("value").slice(a, b - a), _after(all_maps[a:b], state)
                prior = np.concatenate([[state], after[:-1]])
                state = int(after[-1])
                alone = (prior == 0) & (after == 0)
                if first:  # the file's first record is its header
                    alone[0] = False
                if alone.all():
                    yield out(values, 0, True)
                    continue
                made = []
                for i in np.flatnonzero(~alone).tolist():
                    pending.append(values[i].as_py())
                    if after[i]:
                        continue
                    text, pending = "\n".join(pending), []
                    if head:
                        yield out(pa.array([text], pa.string()), 1, True)
                    elif not first:
                        made.append(text)
                    elif text not in headers:
                        raise ValueError(f"no header with the columns that are read, but {text[:200]!r}")
                    first = head = False
                yield out(values.filter(pa.array(alone)), 0, True)
                yield out(pa.array(made, pa.string()), 0, True)
        yield from rest()
    return run


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross borders: each begins with a piece of kind 2 and takes the following ones of kind 1."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    rows = pieces.where("kind > 0").withColumn("number", F.sum((F.col("kind") == 2).cast("int")).over(order))
    held = rows.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    return held.select("file", F.array_join("parts.record", "\n").alias("record"))


def _parser(names: list[str], wanted: list[str], corrupt: str) -> Column:
    """Spark's CSV parser over ``record`` for a header, the wanted columns and the unfitting line picked."""
    schema = StructType([StructField(n, StringType()) for n in [*names, corrupt]])
    options = {"multiLine": "true", "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    row = F.from_csv("record", schema.simpleString(), options)
    return F.struct(*[row[n].alias(n) for n in [*wanted, corrupt]])


def header_names(line: str) -> list[str]:
    """Names in a header line."""
    import csv

    return next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]), [])


def read(spark: SparkSession, path: str, wanted: list[str], corrupt: str) -> DataFrame:
    """The columns ``wanted`` (text) and ``corrupt`` of the CSV files at ``path``.

    Quotes are doubled inside quoted values. Each file has a header line that
    names its columns, in any order; a file without one of the wanted columns,
    or with a line break inside its header, is an error. Empty lines are no
    records, empty files have none. Lines end with ``\\n`` or ``\\r\\n``."""
    lines = _lines(spark, path)
    named = F.lit(True)
    for n in wanted:
        named &= F.col("value").contains(n)
    header = F.when((F.col("block") == 0) & named, F.col("value"))
    looked = lines.withColumn("header", header).where((F.col("map") != SAME) & ~F.col("whole") | F.col("header").isNotNull())
    splits = looked.select("file", "block", "map", "header").mapInArrow(
        _split_maps, "file long, block long, from_out int, from_in int, header string").persist()
    try:
        # a few rows for each record across a border, and one for each distinct header
        changes: dict[int, list[tuple[int, int]]] = {}
        for r in splits.groupBy("file").applyInArrow(_chain, "file long, block long, state int").collect():
            changes.setdefault(r.file, []).append((r.block, r.state))
        headers = [r[0] for r in splits.where("block = 0").select("header").distinct().limit(MAX_HEADERS + 1).collect()]
        by_file = [(r.file, r.header) for r in splits.where("block = 0").select("file", "header").collect()] if len(headers) > 1 else []
    finally:
        splits.unpersist()
    if not headers:  # no file, an empty one, or one without the columns
        first = lines.where("block = 0 and value <> ''").select("value").first()
        if first is None:
            return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in [*wanted, corrupt]))
        headers = [first.value]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    for v in changes.values():
        v.sort()

    for h in headers:
        names = header_names(h)
        missing = [n for n in wanted if n not in names]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {names}")

    schema = "record string, file long, block long, kind int, closed boolean"
    shared = spark.sparkContext.broadcast((changes, headers))
    columns = ["value", "file", "block", "map"]
    pieces = lines.select(*columns).mapInArrow(lambda batches: _records(*shared.value)(batches), schema)
    rows = pieces.where("kind = 0").select("record", "file")
    if changes:
        crossed = lines.where(F.col("file").isin(list(changes))).select(*columns).mapInArrow(
            lambda batches: _records(*shared.value)(batches), schema)
        rows = rows.unionByName(_joined(crossed).select("record", "file"))
    rows = rows.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    if len(headers) == 1:
        parsed = _parser(header_names(headers[0]), wanted, corrupt)
    else:
        known = spark.createDataFrame(by_file, "file long, header string")
        rows = rows.join(known, "file")
        parsed = F.coalesce(*[F.when(F.col("header") == h, _parser(header_names(h), wanted, corrupt)) for h in headers])
    return rows.select(parsed.alias("row")).select("row.*")
