"""Operator 1: masked pseudo-likelihood under a bidirectional window network.

The network predicts a token from ``SIDE`` tokens on each side: each context
place has its own input table, their rows are summed into a hidden layer
(tanh), and a two-level softmax (class, then token within class) gives the
token's probability. The most frequent words are tokens of their own. All
others share ``RARE`` tokens, by ending and length, and a word's probability is
its token's times its share of the token's words in the corpus. So the
vocabulary is that of the corpus, a Spark table of all its words, and a
document's score is the sum of its words' log probabilities, each given its
neighbours on both sides.

Texts are split into words once. Every task numbers the words of a block of
texts (``_blocks``); the blocks' distinct words are counted over the corpus
(``learn_words``), and the blocks are written again as tokens (``encode``),
which training and scoring read. All texts are trained on. Training is synchronous
averaging: in a round every task runs Adagrad in numpy over all its blocks from
the shared weights and sends its weights; the average, weighted by words, is
formed in a grouped aggregate over parameter rows. So the weights, of fixed
size, depend on how the table is dealt to tasks as well as on its rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, most_frequent, slices

SIDE, HIDDEN, CLASSES, ROUNDS = 2, 24, 32, 2
#: Tokens; the last RARE stand for all words that have none of their own, by their ending and length.
VOCABULARY, RARE, EDGE = CLASSES * CLASSES, 256, 0
KNOWN = VOCABULARY - RARE - 1
#: A block ends at about so many distinct words, or words in all. Its slices have about so many characters.
BLOCK_WORDS, BLOCK_LENGTH, SLICE_CHARS, BATCH, RATE = 400_000, 4_000_000, 1_500_000, 4096, 0.1
_SEED = 1


@dataclass(frozen=True)
class Model:
    """The corpus's words (word, token, log_share), and the weights by name."""

    vocabulary: DataFrame
    weights: dict[str, np.ndarray]


def start() -> dict[str, np.ndarray]:
    """First weights: small and random, the same for every task."""
    rng = np.random.default_rng(_SEED)
    places = 2 * SIDE
    return {"context": rng.normal(0, 0.1, (places * VOCABULARY, HIDDEN)).astype(np.float32),
            "hidden": np.zeros((1, HIDDEN), np.float32),
            "class": rng.normal(0, 0.1, (CLASSES, HIDDEN + 1)).astype(np.float32),
            "word": rng.normal(0, 0.1, (VOCABULARY, HIDDEN + 1)).astype(np.float32)}


def centres(sizes: np.ndarray) -> np.ndarray:
    """Where the words of each text are among its tokens."""
    begin = np.cumsum(sizes + 2 * SIDE) - sizes - SIDE
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _context(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of the input tables for each centre: (centres, places), small enough for 16 bits."""
    out = np.empty((len(at), 2 * SIDE), np.int16)
    for i, o in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, i] = stream[at + o] + i * VOCABULARY
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over the first axis: rows of many columns are added and compared at once."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _by_class(stream: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The centres in the order of their tokens' classes: their order, the
    classes, and (class, begin, end) of the classes that occur."""
    classes = (stream[at] // CLASSES).astype(np.uint8)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    return order, classes, [(c, a, b) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def _hidden(w: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    total = np.take(w["context"], context[:, 0], axis=0, mode="clip")
    for i in range(1, context.shape[1]):
        total += np.take(w["context"], context[:, i], axis=0, mode="clip")
    total += w["hidden"]
    out = np.ones((len(context), HIDDEN + 1), total.dtype)
    np.tanh(total, out=out[:, :HIDDEN])
    return out


def _forward(w: dict[str, np.ndarray], hidden: np.ndarray, ranges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the classes, and of the tokens in each centre's own class: (CLASSES, centres)."""
    columns = np.ascontiguousarray(hidden.T)
    inner = np.empty((CLASSES, len(hidden)), hidden.dtype)
    words = w["word"].reshape(CLASSES, CLASSES, HIDDEN + 1)
    for c, a, b in ranges:
        inner[:, a:b] = words[c] @ columns[:, a:b]
    return _softmax(w["class"] @ columns), _softmax(inner)


def log_probabilities(w: dict[str, np.ndarray], stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of the token at each centre given both sides."""
    out = np.empty(len(at))
    for i in range(0, len(at), BATCH):
        own = at[i:i + BATCH]
        order, classes, ranges = _by_class(stream, own)
        own = own[order]
        top, inner = _forward(w, _hidden(w, _context(stream, own)), ranges)
        rows = np.arange(len(own))
        p = top[classes, rows] * inner[stream[own] % CLASSES, rows]
        out[i + order] = np.log(np.maximum(p, 1e-30))
    return out


def gradients(w: dict[str, np.ndarray], stream: np.ndarray, at: np.ndarray) -> dict[str, tuple]:
    """Of minus the centres' summed log probability: name -> (rows, gradient of these rows)."""
    order, classes, ranges = _by_class(stream, at)
    at = at[order]
    context = _context(stream, at)
    hidden = _hidden(w, context)
    top, inner = _forward(w, hidden, ranges)
    rows = np.arange(len(at))
    top[classes, rows] -= 1
    inner[stream[at] % CLASSES, rows] -= 1
    back = top.T @ w["class"]
    words = w["word"].reshape(CLASSES, CLASSES, HIDDEN + 1)
    word = np.zeros_like(words)
    for c, a, b in ranges:
        part = inner[:, a:b]
        word[c] = part @ hidden[a:b]
        back[a:b] += part.T @ words[c]
    back = back[:, :HIDDEN] * (1 - hidden[:, :HIDDEN] ** 2)
    # equal input rows are summed: sorted by row, added up by runs
    flat = context.reshape(-1)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    # two columns are added as one complex number
    pairs = np.take(back, order // (2 * SIDE), axis=0, mode="clip").view(np.result_type(back.dtype, np.complex64))
    summed = np.add.reduceat(pairs, first, axis=0).view(back.dtype)
    everything = slice(None)
    return {"class": (everything, top @ hidden), "word": (everything, word.reshape(VOCABULARY, HIDDEN + 1)),
            "hidden": (everything, back.sum(axis=0, keepdims=True)), "context": (flat[first], summed)}


def train(w: dict[str, np.ndarray], squares: dict[str, np.ndarray], stream: np.ndarray, at: np.ndarray) -> None:
    """One Adagrad pass over the centres, in place."""
    for i in range(0, len(at), BATCH):
        for name, (rows, gradient) in gradients(w, stream, at[i:i + BATCH]).items():
            total = squares[name][rows] + gradient * gradient
            squares[name][rows] = total
            w[name][rows] -= RATE * gradient / np.sqrt(total)


def bucket(word: bytes) -> int:
    """Which of the shared tokens a word has that has none of its own."""
    return (word[-1] * 31 + len(word) * 7 + word[-2:][0]) % RARE


def _buckets(words: pa.Array) -> np.ndarray:
    """``bucket`` of all words of an array (none of them empty)."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1]
    letters = np.frombuffer(words.buffers()[2], np.uint8).astype(np.int32)
    begins, last = ends[:-1], ends[1:] - 1
    return (letters[last] * 31 + (ends[1:] - begins) * 7 + letters[np.maximum(last - 1, begins)]) % RARE


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of an array of texts, A-Z lower-cased: the distinct ones in the order in which they
    appear, all words as places among these, and each text's number of words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, borders = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    there = pc.greater(pc.binary_length(words), 0)  # white space at a text's ends leaves empty ones
    before = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))]
    coded = words.filter(there).dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(), np.diff(before[borders])


def _planes(values: np.ndarray) -> bytes:
    """Integers as their lowest bytes, then the next ones: small numbers leave planes of zeros, which compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _integers(planes: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _blocks(kind: str):
    """Rows of two sorts: a slice of texts as numbers of their block's words, and each distinct word of a block.

    Words are runs without ASCII white space, A-Z lower-cased."""
    types = {"block": pa.int64(), "at": pa.int32(), "word": pa.binary(), "n": pa.int64(), "bucket": pa.int32(),
             "stream": pa.binary(), "sizes": pa.list_(pa.int32()), "ids": None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, chunk = TaskContext.get().partitionId(), 0, 0
        ids, n = defaultdict(count().__next__), np.zeros(0, np.int64)

        def batch_of(size: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["block"] = pa.array([task << 32 | made] * size, pa.int64())
            return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(size, t) for k, t in types.items()], names=list(types))

        def words() -> Iterator[pa.RecordBatch]:
            every = list(ids)
            for a in range(0, len(every), 50_000):
                some = pa.array(every[a:a + 50_000], pa.binary())
                yield batch_of(len(some), at=pa.array(np.arange(a, a + len(some), dtype=np.int32)), word=some,
                               n=pa.array(n[a:a + len(some)]), bucket=pa.array(_buckets(some)))

        for batch in batches:
            column, own = batch.column("text"), batch.column("doc_id")
            types["ids"] = pa.list_(own.type)
            lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for i, j in slices(lengths, SLICE_CHARS, lambda n: n + 50):
                distinct, places, sizes = _split(column.slice(i, j - i))
                flat = np.fromiter(map(ids.__getitem__, distinct.to_numpy(zero_copy_only=False)), np.int32, len(distinct))[places]
                n = np.bincount(flat, minlength=len(ids)) + np.pad(n, (0, len(ids) - len(n)))
                part = own.slice(i, j - i)
                yield batch_of(1, at=pa.array([chunk], pa.int32()), stream=pa.array([_planes(flat)], pa.binary()),
                               sizes=pa.array([sizes.tolist()], types["sizes"]),
                               ids=pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), pa.concat_arrays([part])))
                chunk += 1
                if len(ids) >= BLOCK_WORDS or n.sum() >= BLOCK_LENGTH:
                    yield from words()
                    ids, n, made, chunk = defaultdict(count().__next__), np.zeros(0, np.int64), made + 1, 0
        if ids:
            yield from words()
    return run, (f"block long, at int, word binary, n long, bucket int, stream binary, sizes array<int>, ids array<{kind}>")


def read_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text), written."""
    run, schema = _blocks(docs.schema["doc_id"].dataType.simpleString())
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return scratch.save(rows, "blocks")


def learn_words(blocks: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The corpus's vocabulary, and its words' places in the blocks (block, at, token, log_share),
    both read from written tables of words and totals.

    Vocabulary: word, token, log_share (0 for words with a token of their own).
    One row more for each shared token, without a word: the share of a word
    not seen. The blocks' words move once, by word: a word has at most one
    row a block, the first of which stands for it in the vocabulary."""
    spark = blocks.sparkSession
    same = Window.partitionBy("word")
    words = blocks.where("word is not null").select("block", "at", "word", "n", "bucket")
    words = words.withColumns({"total": F.sum("n").over(same), "first": F.min("block").over(same) == F.col("block")})
    words = scratch.save(words.drop("n"), "words")  # sorted by word, so equal words lie together
    counts = words.where("first").select("word", "total", "bucket")
    top = most_frequent(counts, "word", "total", KNOWN)
    known = F.broadcast(spark.createDataFrame([(bytes(w), i) for i, w in enumerate(top, 1)], "word binary, own int"))
    shared = F.col("bucket") + VOCABULARY - RARE
    totals = counts.join(known, "word", "left_anti").groupBy(shared.alias("token")).agg(F.sum("total").alias("all"))
    totals = spark.range(VOCABULARY - RARE, VOCABULARY).select(F.col("id").cast("int").alias("token")).join(totals, "token", "left")
    totals = scratch.save(totals.select("token", (F.coalesce("all", F.lit(0)) + 1).alias("all")), "totals")
    share = F.when(F.col("own").isNotNull(), 0.0).otherwise(F.log(F.col("total") / F.col("all")))
    placed = (words.join(known, "word", "left").withColumn("token", shared).join(F.broadcast(totals), "token")
              .select("block", "at", F.coalesce("own", "token").alias("token"), share.alias("log_share"), "word", "first"))
    unseen = totals.select(F.lit(None).cast("binary").alias("word"), "token", (-F.log("all")).alias("log_share"))
    vocabulary = placed.where("first").select("word", "token", "log_share").unionByName(unseen)
    return vocabulary, placed.select("block", "at", "token", "log_share")


def find_words(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The places of other blocks' words (block, at, token, log_share). A word that the vocabulary
    lacks has its shared token and that token's share of an unseen word."""
    unseen = vocabulary.where("word is null").select(F.col("token").alias("shared"), F.col("log_share").alias("least"))
    words = blocks.where("word is not null").select("block", "at", "word", (F.col("bucket") + VOCABULARY - RARE).alias("shared"))
    words = words.join(vocabulary.where("word is not null"), "word", "left").join(F.broadcast(unseen), "shared")
    return words.select("block", "at", F.coalesce("token", "shared").alias("token"), F.coalesce("log_share", "least").alias("log_share"))


def _tokens(stream: np.ndarray, sizes: np.ndarray, token: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slice's tokens, each text between SIDE edge tokens, and each text's summed log shares."""
    out = np.full(len(stream) + 2 * SIDE * len(sizes), EDGE, np.int16)
    out[centres(sizes)] = token[stream]
    return out, np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=share[stream], minlength=len(sizes))


def _encode(block: pa.Table, words: pa.Table) -> pa.Table:
    place = words.column("place").to_numpy()
    token, share = np.empty(len(place), np.int16), np.empty(len(place))
    token[place >> 16], share[place >> 16] = place & 0xFFFF, words.column("log_share").to_numpy()
    tokens, shares = [], []
    for planes, sizes in zip(block.column("stream"), block.column("sizes")):
        stream, summed = _tokens(_integers(planes.as_py(), np.int32), np.array(sizes.as_py(), np.int64), token, share)
        tokens.append(_planes(stream))
        shares.append(summed)
    return pa.table({"tokens": pa.array(tokens, pa.binary()), "sizes": block.column("sizes"), "ids": block.column("ids"),
                     "shares": pa.array(shares, pa.list_(pa.float64()))})


def encode(blocks: DataFrame, places: DataFrame, scratch: Scratch) -> DataFrame:
    """The blocks' slices as tokens, written: tokens (16 bits each), sizes, ids, shares."""
    words = places.select(F.col("block").alias("of"), (F.shiftleft(F.col("at").cast("long"), 16) + F.col("token")).alias("place"),
                          F.col("log_share").cast("float").alias("log_share"))
    texts = blocks.where("stream is not null").select("block", "stream", "sizes", "ids")
    kind = blocks.schema["ids"].dataType.simpleString()
    out = texts.groupBy("block").cogroup(words.groupBy("of")).applyInArrow(
        _encode, f"tokens binary, sizes array<int>, ids {kind}, shares array<double>")
    return scratch.save(out, "encoded")


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, tokens, sizes) of a batch's slices."""
    for i in range(batch.num_rows):
        yield (i, _integers(batch.column("tokens")[i].as_py(), np.int16),
               batch.column("sizes")[i].values.to_numpy().astype(np.int64))


def _train_task(weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        w = {k: v.copy() for k, v in weights.items()}
        squares = {k: np.full_like(v, 0.1) for k, v in w.items()}
        for batch in batches:
            for _, stream, sizes in _read(batch):
                train(w, squares, stream, centres(sizes))
                seen += int(sizes.sum())
        if seen:
            for name, matrix in w.items():
                n, width = matrix.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(n), pa.int32()), pa.array([seen] * n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)))],
                    names=["name", "row", "seen", "value"])
    return run


def _average(encoded: DataFrame, weights: dict[str, np.ndarray], scratch: Scratch, name: str) -> dict[str, np.ndarray]:
    """The tasks' weights after a pass, averaged by their numbers of tokens."""
    sent = encoded.select("tokens", "sizes").mapInArrow(_train_task(weights), "name string, row int, seen long, value array<float>")
    cells = [F.sum(F.get("value", F.lit(i)) * F.col("seen")) / F.sum(F.when(F.get("value", F.lit(i)).isNotNull(), F.col("seen")))
             for i in range(HIDDEN + 1)]
    mean = sent.groupBy("name", "row").agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
    out = {k: v.copy() for k, v in weights.items()}
    for r in scratch.save(mean, name).collect():  # as many rows as the network has
        row = out[r.name]
        row[r.row] = r[2:2 + row.shape[1]]
    return out


def learn_weights(encoded: DataFrame, scratch: Scratch) -> dict[str, np.ndarray]:
    """The network's weights after ``ROUNDS`` rounds over all blocks."""
    weights = start()
    for i in range(ROUNDS):
        weights = _average(encoded, weights, scratch, f"weights-{i}")
    return weights


def fit(spark: SparkSession, docs: DataFrame, scratch: Scratch) -> Model:
    """Vocabulary and weights from all texts of ``docs`` (doc_id, text)."""
    blocks = read_blocks(docs, scratch)
    vocabulary, places = learn_words(blocks, scratch)
    vocabulary = scratch.save(vocabulary, "vocabulary")
    return Model(vocabulary, learn_weights(encode(blocks, places, scratch), scratch))


def _score_rows(weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, stream, sizes in _read(batch):
                logs = log_probabilities(weights, stream, centres(sizes))
                sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=logs, minlength=len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(sizes), pa.array(sums + batch.column("shares")[i].values.to_numpy())],
                    names=["doc_id", "n_tokens", "log_likelihood"])
    return run


def score_encoded(encoded: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and its mean of the encoded texts."""
    kind = encoded.schema["ids"].dataType.elementType.simpleString()
    rows = encoded.mapInArrow(_score_rows(weights), f"doc_id {kind}, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return rows.withColumn("mean_log_likelihood", mean)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over words) and its mean, one row
    for each row of ``docs``. Texts that are null or blank have no words,
    likelihood 0 and a null mean. An empty table gives no rows."""
    scratch = Scratch(spark, "lm-score")
    blocks = read_blocks(docs, scratch)
    return score_encoded(encode(blocks, find_words(blocks, model.vocabulary), scratch), model.weights)


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document, by a network trained on all of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scratch = Scratch(spark, "lm")
    blocks = read_blocks(docs, scratch)
    encoded = encode(blocks, learn_words(blocks, scratch)[1], scratch)
    for used in ("blocks", "words"):
        scratch.drop(used)
    return score_encoded(encoded, learn_weights(encoded, scratch))
