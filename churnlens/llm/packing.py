"""Operator 7: best-fit packing planned on the length histogram.

Texts are tokenised and cut into pieces of at most ``CAPACITY`` tokens. The
driver sees only the histogram of piece lengths (at most ``CAPACITY``
counts): best-fit decreasing places counts, so all sequences with equal
contents are one entry of the plan. Pieces then take planned slots by
joining on (length, rank within length). Ranks are formed in parts of each
length, more of them for more pieces, so a length that many share is spread out.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch
from .pretokens import BYTE_LEVEL, byte_alphabet

CAPACITY, END_ID = 2048, 0
#: Ranks are formed in at least ``SALTS`` parts of each length, of about ``PART`` pieces at most.
SALTS, PART = 64, 200_000


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    """The byte-level BPE of a tokenizers file, run by tiktoken: its merges are
    in the order of its ids, so both libraries give the same ids (tested)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {k: v for k, v in ranks.items() if v not in special.values()}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)


#: Characters that the pattern's ``\s`` takes (Unicode White_Space), and runs of them that are cut out of a text.
_WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_WHITE = 10_000
_white_runs = re.compile(_WHITE + "{50,}").finditer


def token_ids(path: str, text: str) -> np.ndarray:
    """Ids of a text as the tokenizers library gives them (special strings become their ids).

    The pattern's look-ahead steps back through a run of white space and fails
    on very long ones. By the pattern such a run is one piece: all of it at the
    end of the text or before a special string, else all but its last
    character. So long runs are merged by themselves."""
    encoding = _encoding(path)
    runs = [m.span() for m in _white_runs(text) if m.end() - m.start() >= LONG_WHITE] if len(text) >= LONG_WHITE else []
    parts, begin = [], 0
    for start, end in runs:
        alone = end == len(text) or text.startswith(tuple(encoding.special_tokens_set), end)
        stop = end if alone else end - 1
        parts += [encoding.encode_to_numpy(text[begin:start], allowed_special="all"),
                  np.array(encoding._encode_single_piece(text[start:stop]), np.uint32)]
        begin = stop
    rest = encoding.encode_to_numpy(text[begin:], allowed_special="all")
    return np.concatenate([*parts, rest]) if parts else rest


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(token_ids(path, text or ""), END_ID).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths (1 to ``capacity``).

    Returns slots (length, rank, count, sequence, step, offset): the pieces
    of that length with ranks rank .. rank + count - 1 go to sequences
    sequence, sequence + 1, ... , ``step`` pieces to each, the first at
    ``offset``, the next right after it."""
    space: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, how many)
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            free = min((f for f in space if f >= length), default=None)
            if free is None:
                fits = capacity // length
                full, rest = divmod(left, fits)
                runs = [(full, fits)] * bool(full) + [(1, rest)] * bool(rest)
                first, free = sequences, capacity
                sequences += full + bool(rest)
            else:
                first, many = space[free].pop()
                if not space[free]:
                    del space[free]
                fits = free // length
                full, rest = divmod(left, fits)
                if full >= many:
                    runs = [(many, fits)]
                else:
                    runs = [(full, fits)] * bool(full) + [(1, rest)] * bool(rest)
                    spare = many - full - bool(rest)
                    if spare:
                        space.setdefault(free, []).append((first + many - spare, spare))
            for many, step in runs:
                slots.append((length, rank, many * step, first, step, capacity - free))
                if free - step * length:
                    space.setdefault(free - step * length, []).append((first, many))
                first, rank, left = first + many, rank + many * step, left - many * step
    return slots


def ranked(pieces: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """``pieces`` with a rank from 0 within their length, and the histogram.

    The rank is the rank within (length, salt) after the counts of the
    length's earlier salts."""
    salts = max(SALTS, pieces.count() // PART)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = scratch.save(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    rows = (salted.withColumn("_rank", F.row_number().over(order) - 1).join(before, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("_rank")).drop("_rank", "before", "salt"))
    return rows, histogram


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack the tokens of ``docs`` (doc_id, text) into sequences.

    A document is its ids and then ``END_ID``; a null or empty text is the
    end id alone. Only documents longer than ``capacity`` are cut, the first
    piece taking the remainder. One row for each piece: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset. Repeated rows are packed as often
    as they occur. An empty table gives no rows."""
    scratch = Scratch(spark, "packing")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows, histogram = ranked(scratch.save(pieces, "pieces"), scratch)
    # a few slots for each length: bounded by the capacity, not by the data
    slots = spark.createDataFrame(plan(histogram, capacity),
                                  "length long, first long, count long, sequence long, step long, at long")
    rows = rows.join(F.broadcast(slots), "length").where("rank >= first and rank < first + count")
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32",
                       F.expr("sequence + (rank - first) div step").alias("sequence_id"),
                       F.expr("at + (rank - first) % step * length").alias("offset"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all ``documents`` into sequences of 2048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))
