"""Operator 4: BPE encoding and decoding over a lexicon transducer.

The most frequent words of the corpus are compiled, with their token ids as
output, into a minimal acyclic automaton: equal endings are shared, and each
edge carries the number of words that sort before the words behind it, so
the sum along a path is the word's place in the table of outputs. The file
goes to every executor once and its workers map it into memory. Words that
it lacks are merged exactly, so the lexicon's size changes speed only.

Texts are handled as the file says: special strings first, then NFC and
lower case, words by pattern, bytes as letters, ``</w>`` at a word's end.
Without a decoder in the file, decoding joins the tokens with a space.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import re
import struct
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, most_frequent, slices
from .pretokens import WordLevel, byte_alphabet

#: Words in the transducer; words that a worker counts, or keeps merged, at a time; characters handled together.
LEXICON, HELD_WORDS, SLICE_CHARS = 100_000, 300_000, 3_000_000


class Merges:
    """The vocabulary and merges of a word-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_alphabet()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + end] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {a << 32 | b: i for i, (a, b, _) in enumerate(pairs)}
        self.merged = [c for _, _, c in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (vocab | self.special).items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.split_words = WordLevel()

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special strings are words of their own."""
        if "<|" not in text:
            return self._words(text)
        out: list[str] = []
        for i, part in enumerate(self.split_special(text)):
            out.extend([part] if i % 2 else self._words(part))
        return out

    def _words(self, text: str) -> list[str]:
        # letter by letter, so a capital sigma has one small form
        return self.split_words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def merge(self, word: str) -> list[int]:
        """Token ids of a word: the pair of lowest rank first, from the left."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in data[:-1]] + [self.final[data[-1]]]
        if len(ids) > 100:
            return self._merge_long(ids)
        rank, merged, none = self.rank.get, self.merged, len(self.merged)
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = new = merged[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | new, none)
            if i < len(ranks):
                ranks[i] = rank(new << 32 | ids[i + 1], none)
        return ids

    def output(self, word: str) -> tuple[bytes, bytes]:
        """A word's ids (little-endian, 32 bits each) and its decoded text (UTF-8)."""
        ids = self.merge(word)
        token = self.token
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([token[i] for i in ids]).encode("utf-8")

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words of any length."""
        n, rank = len(ids), self.rank.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[best], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0:
                    a, b = ids[left], ids[after[left]]
                    if (r := rank(a << 32 | b)) is not None:
                        heapq.heappush(heap, (r, left, a, b))
        return [x for x in ids if x >= 0]


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def compile_lexicon(words: Iterable[str], model: Merges) -> bytes:
    """The transducer's file: four counts, then edges in order (state * 256 +
    byte, target, words before), final states, where each word's outputs
    begin, and the outputs."""
    keys = sorted({w.encode("utf-8", "surrogatepass") for w in words if w})
    register: dict[tuple, int] = {}
    states: list[tuple] = []

    def settle(final: bool, edges: list) -> int:
        state = (final, tuple(map(tuple, edges)))
        if state not in register:
            register[state] = len(states)
            states.append(state)
        return register[state]

    # open states along the last word, the start first: [final, [[byte, target], ...]]
    path: list[list] = [[False, []]]
    last = b""
    for key in [*keys, None]:
        shared = 0
        if key is not None:
            while shared < min(len(last), len(key)) and last[shared] == key[shared]:
                shared += 1
        while len(path) > shared + 1:
            closed = path.pop()
            path[-1][1][-1][1] = settle(*closed)
        if key is None:
            break
        for byte in key[shared:]:
            path[-1][1].append([byte, -1])
            path.append([False, []])
        path[-1][0] = True
        last = key
    start = settle(*path[0])
    # targets come before the states that lead to them
    counts, rows = [], []
    for number, (final, edges) in enumerate(states):
        before = int(final)
        for byte, target in edges:
            rows.append((number * 256 + byte, target, before))
            before += counts[target]
        counts.append(before)
    outputs = [model.output(k.decode("utf-8", "surrogatepass")) for k in keys]
    table = np.array(rows, np.int64).reshape(-1, 3)
    parts = [table[:, 0], table[:, 1], table[:, 2], np.array([f for f, _ in states], np.int64),
             *(np.cumsum([0, *map(len, column)]) for column in ([p for p, _ in outputs], [d for _, d in outputs]))]
    head = np.array([len(table), len(states), len(keys), start], np.int64)
    return b"".join([*(p.astype("<i8").tobytes() for p in [head, *parts]),
                     *(p for p, _ in outputs), *(d for _, d in outputs)])


class Transducer:
    """The compiled lexicon, over any buffer (a memory map, or bytes)."""

    def __init__(self, buffer):
        edges, states, words, self.start = np.frombuffer(buffer, "<i8", 4).tolist()
        ends = np.cumsum([4, edges, edges, edges, states, words + 1, words + 1])
        data = np.frombuffer(buffer, "<i8", ends[-1])
        self.edge, self.target, self.before, self.final, packed, decoded = (
            data[a:b] for a, b in zip(ends, ends[1:]))
        self.packed = (packed + 8 * ends[-1]).tolist()
        self.decoded = (decoded + self.packed[-1]).tolist()
        self.buffer = buffer

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the table of outputs, -1 if it isn't there."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        place = np.zeros(len(words), np.int64)
        state = np.full(len(words), self.start, np.int64)
        alive = np.flatnonzero(sizes) if len(self.edge) else np.empty(0, np.int64)
        step = 0
        while len(alive):
            wanted = state[alive] * 256 + data[begin[alive] + step]
            at = np.minimum(np.searchsorted(self.edge, wanted), len(self.edge) - 1)
            hit = self.edge[at] == wanted
            state[alive] = np.where(hit, self.target[at], -1)
            place[alive] += np.where(hit, self.before[at], 0)
            step += 1
            alive = alive[hit & (sizes[alive] > step)]
        found = (state >= 0) & (sizes > 0) & (self.final[state] == 1)
        return np.where(found, place, -1)

    def output(self, place: int) -> tuple[bytes, bytes]:
        """The packed ids and the decoded text of the word at ``place``."""
        return (self.buffer[self.packed[place]:self.packed[place + 1]],
                self.buffer[self.decoded[place]:self.decoded[place + 1]])


@functools.lru_cache(maxsize=2)
def _mapped(name: str) -> Transducer:
    with open(SparkFiles.get(name), "rb") as f:
        return Transducer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


_merged: dict[str, tuple[bytes, bytes]] = {}  # of this worker's last words outside the lexicon


def encode_words(lexicon: Transducer, model: Merges, words: list[str]) -> list[tuple[bytes, bytes]]:
    """Packed ids and decoded text of distinct words: from the transducer, or merged."""
    if len(_merged) > HELD_WORDS:
        _merged.clear()
    out = []
    for word, place in zip(words, lexicon.find([w.encode("utf-8", "surrogatepass") for w in words]).tolist()):
        if place >= 0:
            out.append(lexicon.output(place))
            continue
        found = _merged.get(word)
        if found is None:
            found = _merged[word] = model.output(word)
        out.append(found)
    return out


def encode(lexicon: Transducer, model: Merges, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
    """Of each text the ids (little-endian, 32 bits) and the decoded text (UTF-8)."""
    for i, j in slices(texts, SLICE_CHARS):
        split = [model.words(t) for t in texts[i:j]]
        flat = [w for words in split for w in words]
        codes, distinct = pd.factorize(np.array([*flat, None], dtype=object)[:-1])
        outputs = encode_words(lexicon, model, distinct.tolist())
        packed, decoded = [p for p, _ in outputs], [d for _, d in outputs]
        codes, at = codes.tolist(), 0
        for words in split:
            own = codes[at:at + len(words)]
            at += len(words)
            yield b"".join([packed[c] for c in own]), b" ".join([decoded[c] for c in own])


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held = merges(path), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.encode("utf-8", "surrogatepass") for w in held], pa.binary()),
                 pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(model.words(text or ""))
                if len(held) > HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()
    return run


def frequent_words(docs: DataFrame, path: str, size: int = LEXICON) -> list[str]:
    """The ``size`` most frequent words of all texts, counted over the whole corpus."""
    counts = (docs.select("text").mapInArrow(_count(path), "word binary, n long")
              .groupBy("word").agg(F.sum("n").alias("n")))
    scratch = Scratch(docs.sparkSession, "bpe-words")
    top = most_frequent(scratch.save(counts, "counts"), "word", "n", size)
    scratch.drop("counts")
    return [bytes(w).decode("utf-8", "surrogatepass") for w in top]


def publish(spark: SparkSession, lexicon: bytes) -> str:
    """Put the transducer's file where executors fetch it; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}"
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    path = f"{Scratch(spark, 'bpe').root}/{name}"
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(lexicon))
    stream.close()
    sc.addFile(path)
    return name


def _encode_rows(path: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lexicon = merges(path), _mapped(name)
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            texts = [t or "" for t in batch.column("text").to_pylist()]
            held: list[tuple] = []
            for packed, decoded in encode(lexicon, model, texts):
                held.append((packed, decoded))
                if len(held) == len(texts) - at or sum(map(len, held[-1])) > SLICE_CHARS or len(held) % 500 == 0:
                    yield pa.RecordBatch.from_arrays(
                        [ids[at:at + len(held)], pa.array([x for x, _ in held], pa.binary()),
                         pa.array([x.decode("utf-8") for _, x in held], pa.string())],
                        names=["doc_id", "ids", "decoded"])
                    at, held = at + len(held), []
    return run


def _digest_rows(path: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encode_rows(path, name)(batches):
            ids, decoded = batch.column("ids").to_pylist(), batch.column("decoded").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x).hexdigest() for x in decoded])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _apply(spark: SparkSession, docs: DataFrame, path: str, rows, schema: str, size: int) -> DataFrame:
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    name = publish(spark, compile_lexicon(frequent_words(docs, path, size), merges(path)))
    return docs.mapInArrow(rows(path, name), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, size: int = LEXICON) -> DataFrame:
    """doc_id, ids (binary: little-endian, 32 bits each) and decoded text of
    each row of ``docs``. A null or empty text has no ids and decodes to the
    empty text. An empty table gives no rows."""
    return _apply(spark, docs, path, _encode_rows, "ids binary, decoded string", size)


def op4_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of all ``documents``."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _apply(spark, docs, public_tokenizers.path("word_bpe_49k.json"), _digest_rows,
                  "n_tokens long, ids_sha256 string, decoded_sha256 string", LEXICON)
