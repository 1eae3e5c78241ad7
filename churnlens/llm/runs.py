"""Operator 11: periodic runs of words, seeded by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and length of
at least ``max(24, 3 * q)`` that no neighbouring word extends keeping period q.
Periods up to ``SHORT`` come from direct lag scans. Longer ones are divided
into scales (low, high] with high <= 1.5 * low. At each scale every word
starts a gram of ``high`` words, and the minimizers are the grams that are the
smallest of some window of ``2 * low + 3 - high`` neighbouring grams. Inside a
run of such a period q

* gram and window fit twice, q apart, as ``high + window - 1 + q <= 3 * q``, so
  the minimizer of the run's first window comes again q words later;
* a gram of at least q words recurs at multiples of q only, so that one is the
  next minimizer of equal gram, and no other pair need be looked at.

Pairs of neighbouring equal minimizers (low, high] apart are extended both ways
on the words themselves. So no run is lost and none is made up; grams are
compared by 64-bit hashes, which only choose the seeds.

Work is by rows: no shuffle. A task handles texts in slices of about
``SLICE`` characters (a longer text by itself).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, slices

#: Least length of a run in words and in periods; longest period that lag scans find.
LEAST, TIMES, SHORT = 24, 3, 8
SLICE = 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring grams together (not linear, so that no text defeats it)."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:len(x) - step], x[step:])
        done += step
    return x


def minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the smallest gram of some window."""
    if len(grams) < window:
        return np.empty(0, np.int64)
    low = _sliding(grams, window, np.minimum)
    pad = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), window, np.maximum) == grams)


def seeds(grams: np.ndarray, window: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(period, position) of neighbouring equal minimizers, by period, then position."""
    at = minimizers(grams, window)
    at = at[np.argsort(grams[at], kind="stable")]
    apart = at[1:] - at[:-1]
    found = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (apart > low) & (apart <= high))
    order = np.lexsort((at[found], apart[found]))
    yield from zip(apart[found][order].tolist(), at[found][order].tolist())


def extend(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The greatest [begin, end) around ``at`` where each word equals the one ``period`` later."""
    end, step, last = at, 64, len(words) - period
    while end < last:
        stop = min(end + step, last)
        other = np.flatnonzero(words[end:stop] != words[end + period:stop + period])
        if len(other):
            end += int(other[0])
            break
        end, step = stop, step * 2
    begin, step = at, 64
    while begin > 0:
        start = max(begin - step, 0)
        other = np.flatnonzero(words[start:begin] != words[start + period:begin + period])
        if len(other):
            begin = start + int(other[-1]) + 1
            break
        begin, step = start, step * 2
    return begin, max(begin, end)


def periodic_stretches(words: np.ndarray, longest: int) -> dict[tuple[int, int], int]:
    """(start, end) -> period of all runs in ``words`` (int64), of which no text has more than
    ``longest`` words. Texts are parted by numbers that occur once."""
    runs: dict[tuple[int, int], int] = {}

    def add(begin: int, end: int, period: int) -> None:
        if end + period - begin >= max(LEAST, TIMES * period):
            key = (begin, end + period)
            runs[key] = min(period, runs.get(key, period))

    for q in range(1, min(SHORT, len(words) - 1) + 1):
        breaks = np.flatnonzero(words[:-q] != words[q:])
        breaks = np.concatenate([[-1], breaks, [len(words) - q]])
        for i in np.flatnonzero(np.diff(breaks) > LEAST - q).tolist():
            add(int(breaks[i]) + 1, int(breaks[i + 1]), q)

    power, base = 1, words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    base = _join(base, base)
    low, high = SHORT, SHORT * 3 // 2
    while TIMES * (low + 1) <= longest and high < len(words):
        while power * 2 <= high:
            base = _join(base[:-power], base[power:])
            power *= 2
        starts = len(words) - high + 1
        grams = _join(base[:starts], base[high - power:high - power + starts])
        done = (0, -1)  # the period and the end of the stretch found last
        for period, at in seeds(grams, 2 * low + 3 - high, low, high):
            if period != done[0] or at >= done[1]:
                begin, end = extend(words, at, period)
                add(begin, end, period)
                done = (period, end)
        low, high = high, high * 3 // 2
    return runs


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words as numbers, each text followed by a number of its own; where each text begins."""
    ids = defaultdict(count().__next__)
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    flat = np.empty(int(starts[-1]), np.int64)
    for i, words in enumerate(texts):
        flat[starts[i]:starts[i + 1] - 1] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        flat[starts[i + 1] - 1] = -1 - i
    return flat, starts


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # texts of like length together, so that short ones don't go through the long ones' scales
    size = np.array([max(len(t), 1).bit_length() for t in texts])
    for bits in np.unique(size).tolist():
        group = np.flatnonzero(size == bits).tolist()
        flat, starts = _numbered([texts[i] for i in group])
        found = periodic_stretches(flat, max(len(texts[i]) for i in group))
        for (begin, end), period in found.items():
            i = int(np.searchsorted(starts, begin, side="right")) - 1
            out[group[i]].append((begin - int(starts[i]), end - begin, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that some run holds after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in slices(texts, SLICE, lambda t: len(t or "") + 64):
            words = [(t or "").encode().split() for t in texts[a:b]]  # bytes: ASCII white space alone parts them
            found = runs_of(words)
            structs = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array([len(w) for w in words], pa.int64()),
                 pa.array(structs, pa.list_(_RUN)),
                 pa.array([collapse(w, r).decode() for w, r in zip(words, found)], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """All periodic runs of each text of ``docs`` (doc_id, text).

    Words are runs without ASCII white space, numbered from 0. One row for
    each row of ``docs`` (repeated rows and null ids too): doc_id, n_words,
    runs (start, length, period; by start, then period), collapsed (the words
    joined by one space, without those that a run repeats). Null, empty and
    blank texts have no words and no runs; an empty table gives no rows.
    Other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_find, SCHEMA)


def most_repeated(runs: Column) -> Column:
    """The run of greatest length / period (compared exactly), ties by start, then period; null if none."""
    def compare(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, compare), F.lit(0))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the query's fixed changes: where crc32 of the decimal
    doc_id is divisible by 10, the words from a place on repeat that place's first words."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rest = F.floor(number / 10).cast("long")
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(rest, F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (F.pmod(rest, F.lit(8)) + 3))
        places = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(places, " ")).otherwise("")
    return docs.select("doc_id", F.when(number % 10 == 0, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all ``documents``, a tenth of them with planted repeats, and texts without the repeats."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return find_runs(with_repeats(docs)).withColumn("best", most_repeated(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words")
