"""Operator 10: language identification by cross-parsing entropy.

For each language a suffix automaton accepts every substring of a labelled
sample. A text is cross-parsed against it: each phrase is the longest match
from where the last one ended. Fewer phrases mean a closer language; counts
are normalised by the text's length and by the log of the sample's length
(an entropy estimate in bits a symbol), and the smallest wins.

The sample is bounded: ``SAMPLE_DOCS`` documents of each language in hash
order, a stretch of ``SAMPLE_CHARS`` characters of each (at a place that a hash
of the text chooses), and of these ``MODEL_SYMBOLS`` symbols divided among the
languages, but ``LEAST_SYMBOLS`` for each at least, however many languages
there are. Prediction reads whole texts; they are
parsed in blocks of ``BLOCK`` symbols (all blocks side by side), each block
starting a new phrase. Only the text is used.

The most frequent letters are a symbol each; every other letter of a sample
is written as digits, so it matches as well. Only letters that no sample
holds match nothing.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices

SAMPLE_DOCS, SAMPLE_CHARS, MODEL_SYMBOLS, LEAST_SYMBOLS = 200, 1000, 120_000, 4000
BLOCK, SLICE_CHARS = 512, 1_000_000
#: Symbols: 0 letters in no sample, 1 any run of other characters, then the alphabet, digits of further letters, PAD after a block's end.
OTHER, GAP, ALPHABET, DIGIT, DIGITS, PAD, WIDTH = 0, 1, 61, 63, 16, 79, 80
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    """Per language the sampled text (normalised); the alphabet is shared."""

    languages: tuple[str, ...]
    samples: tuple[str, ...]
    alphabet: str


def normalise(text: str) -> str:
    """Lower case; every run of characters that aren't letters becomes one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def fit(docs: DataFrame, allowed: Column) -> Model:
    """Sample ``docs`` (doc_id, text, lang) where ``allowed``; rows without lang or text are left out."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    room = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    place = (F.pmod(F.xxhash64("text"), room) + 1).cast("int")
    rows = (docs.where(allowed & F.col("lang").isNotNull() & (F.length("text") > 0))
            .select("lang", "doc_id", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_DOCS)
            .orderBy("lang", "rank").select("lang", "text").collect())
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row.lang, []).append(normalise(row.text))
    each = max(MODEL_SYMBOLS // max(1, len(texts)), LEAST_SYMBOLS)
    samples = {k: " ".join(v)[:each] for k, v in texts.items() if "".join(v).strip()}
    common = Counter("".join(samples.values()).replace(" ", "")).most_common()
    letters = sorted(common, key=lambda x: (-x[1], x[0]))[:ALPHABET]
    return Model(tuple(sorted(samples)), tuple(samples[k] for k in sorted(samples)),
                 "".join(c for c, _ in letters))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    move: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = new
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(move)
                move.append(dict(move[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return move


def _further(model: Model) -> str:
    """Letters of the samples that aren't in the alphabet, by code point; each is written as its number's digits."""
    return "".join(sorted({c for s in model.samples for c in s if c.isalpha()}.difference(model.alphabet)))


def _written(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols for ``codes`` (from WIDTH on: WIDTH + a letter's number, as ``size`` digits), and how many each has."""
    far = codes >= WIDTH
    counts = np.where(far, size, 1)
    if not far.any():
        return codes, counts
    out = np.repeat(codes, counts)
    begin = (np.cumsum(counts) - counts)[far]
    for i in range(size):
        out[begin + i] = DIGIT + (codes[far] - WIDTH) // DIGITS ** (size - 1 - i) % DIGITS
    return out, counts


@functools.lru_cache(maxsize=2)
def _tables(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Code of each code point (see ``_written``), the moves of all automata, their starts, log2 of sample sizes, digits of a letter.

    A move is (next state * WIDTH) + 1 if a phrase ended before the symbol. A symbol
    that the sample doesn't hold is a phrase of its own: it leads to an added last
    state, which every symbol leaves for a new phrase."""
    symbol = np.full(0x110000, GAP, np.int32)
    symbol[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
    for i, c in enumerate(model.alphabet):
        symbol[ord(c)] = 2 + i
    further, size = _further(model), 1
    while DIGITS ** size < len(further):
        size += 1
    for i, c in enumerate(further):
        symbol[ord(c)] = WIDTH + i
    parts, starts, lengths, at = [], [], [], 0
    for sample in model.samples:
        codes, _ = _written(symbol[np.frombuffer(sample.encode("utf-32-le"), np.uint32)], size)
        lengths.append(len(codes))
        move = suffix_automaton(codes.tolist())
        move[0].pop(OTHER, None)
        move.append({})
        fresh = np.full(WIDTH, (at + len(move) - 1) * WIDTH + 1, np.int32)
        for c, s in move[0].items():
            fresh[c] = (at + s) * WIDTH + 1
        table = np.tile(fresh, (len(move), 1))
        table[0] -= 1  # a block's first phrase is counted already
        state, c, to = np.array([(s, c, t) for s, m in enumerate(move) for c, t in m.items() if c != OTHER]).T
        table[state, c] = (at + to) * WIDTH
        table[:, PAD] = at * WIDTH
        parts.append(table)
        starts.append(at * WIDTH)
        at += len(move)
    sizes = np.log2([max(2, n) for n in lengths])
    return symbol, np.concatenate(parts).reshape(-1), np.array(starts, np.int32), sizes, size


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits a symbol of each text (rows) under each language, and whether it has a letter."""
    symbol, table, starts, logs, size = _tables(model)
    lower = [t.lower() for t in texts]
    codes = symbol[np.frombuffer(" ".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lower])
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = codes != GAP
    keep[1:] |= (codes[:-1] != GAP) & ~first[1:]  # one gap after letters; none at a text's start
    codes, counts = _written(codes[keep], size)
    owner = np.repeat(owner[keep], counts)
    sizes = np.bincount(owner, minlength=len(texts))
    letters = np.bincount(owner, weights=codes != GAP, minlength=len(texts)) > 0
    blocks = -(-sizes // BLOCK)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - np.repeat(begin, sizes)
    row = np.repeat(np.cumsum(blocks) - blocks, sizes) + place // BLOCK
    grid = np.full((BLOCK, int(blocks.sum())), PAD, np.int32)
    grid[place % BLOCK, row] = codes
    state = np.repeat(starts[:, None], grid.shape[1], axis=1)
    phrases = np.ones(state.shape, np.int64)
    for column in grid:
        state = table[state + column]
        ended = state & 1
        phrases += ended
        state -= ended
    total = np.zeros((len(texts), len(starts)))
    np.add.at(total, np.repeat(np.arange(len(texts)), blocks), phrases.T)
    return total * logs / np.maximum(sizes, 1)[:, None], letters


def _predict(model: Model, columns: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for i, j in slices(texts, SLICE_CHARS):
                    if not model.languages:
                        names, scores = [UNDETERMINED] * (j - i), np.zeros(j - i)
                    else:
                        bits, letters = entropies(model, texts[i:j])
                        best = bits.argmin(axis=1)
                        low = bits.min(axis=1)
                        second = np.partition(bits, 1, axis=1)[:, 1] if bits.shape[1] > 1 else np.full(len(low), np.inf)
                        scores = np.where(letters, 1 - low / np.maximum(second, 1e-12), 0.0)
                        names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
                    yield pa.RecordBatch.from_arrays(
                        [*[c[i:j] for c in batch.columns], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                        names=[*batch.schema.names, *columns])
        finally:
            _tables.cache_clear()  # the worker goes on to other tasks; building them again takes half a second
    return run


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``keep`` columns, lang_pred, score (or ``names``), one row for each row of ``docs``.

    ``und`` with score 0 for a null text or one without letters; otherwise
    the score is the relative lead over the next language (0 for a tie, which
    goes to the first name). Without any labelled sample all are ``und``."""
    chosen = docs.select(*[F.col(c) for c in keep], *([] if "text" in keep else ["text"]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    fields += [f"`{names[0]}` string", f"`{names[1]}` double"]
    return chosen.mapInArrow(_predict(model, names), ", ".join(fields)).select(*keep, *names)


def held_out() -> Column:
    """Rows that are never learned from: crc32 of the id's text is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
