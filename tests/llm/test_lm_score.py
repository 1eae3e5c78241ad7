"""Operator 1: the score against a direct evaluation, gradients against differences, and what training gains."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlens.llm import lm_score as lm
from churnlens.llm.common import Scratch


@pytest.fixture(scope="module")
def model(spark, documents):
    return lm.fit(spark, documents, Scratch(spark, "lm-test"))


@pytest.fixture(scope="module")
def table(model):
    """word -> (token, log share); None -> that of unseen words by token."""
    rows = model.vocabulary.collect()
    known = {bytes(r.word): (r.token, r.log_share) for r in rows if r.word is not None}
    return known, {r.token: r.log_share for r in rows if r.word is None}


def words_of(text):
    return (text or "").encode().lower().split()


def look_up(table, word):
    known, unseen = table
    shared = lm.VOCABULARY - lm.RARE + lm.bucket(word)
    return known.get(word, (shared, unseen[shared]))


def stream_of(table, words):
    edge = [lm.EDGE] * lm.SIDE
    return np.array([*edge, *(look_up(table, w)[0] for w in words), *edge], np.int16)


def direct(w, stream, at):
    """The log probability of one token, term by term."""
    total = w["hidden"][0].astype(float).copy()
    offsets = [*range(-lm.SIDE, 0), *range(1, lm.SIDE + 1)]
    for i, o in enumerate(offsets):
        total += w["context"][i * lm.VOCABULARY + stream[at + o]]
    hidden = np.append(np.tanh(total), 1.0)
    classes = w["class"] @ hidden
    target, block = divmod(int(stream[at]), lm.CLASSES)
    inner = w["word"][target * lm.CLASSES:(target + 1) * lm.CLASSES] @ hidden
    return (classes[target] - np.log(np.exp(classes).sum())) + (inner[block] - np.log(np.exp(inner).sum()))


def test_scores_are_sums_of_conditionals(spark, odd, model, table):
    rows = lm.score(spark, odd, model).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        words = words_of(texts[r.doc_id])
        assert r.n_tokens == len(words) and (r.mean_log_likelihood is None) == (not words)
        if 0 < len(words) < 100:
            stream = stream_of(table, words)
            expected = sum(direct(model.weights, stream, lm.SIDE + i) + look_up(table, w)[1] for i, w in enumerate(words))
            assert abs(expected - r.log_likelihood) < 1e-3


def test_vocabulary_is_the_corpus(documents, table):
    """Every word is there; its share is its part of the words that share its token."""
    known, unseen = table
    counts = Counter(w for r in documents.select("text").collect() for w in words_of(r.text))
    assert known.keys() == counts.keys()
    own = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:lm.KNOWN]}
    totals = Counter()
    for w, n in counts.items():
        if w not in own:
            totals[lm.VOCABULARY - lm.RARE + lm.bucket(w)] += n
    for w, (token, share) in known.items():
        expected = 0.0 if w in own else math.log(counts[w] / (totals[token] + 1))
        assert share == pytest.approx(expected) and (0 < token <= lm.KNOWN) == (w in own)
    assert sorted(t for t, _ in (known[w] for w in own)) == list(range(1, len(own) + 1))
    assert all(unseen[t] == pytest.approx(-math.log(totals[t] + 1)) for t in range(lm.VOCABULARY - lm.RARE, lm.VOCABULARY))


def test_training_beats_word_frequencies(spark, model, documents):
    """Over words, not shared tokens: better than each word's frequency by itself."""
    counts = Counter(w for r in documents.select("text").collect() for w in words_of(r.text))
    total = sum(counts.values())
    plain = sum(n * math.log(n / total) for n in counts.values()) / total
    found = lm.score(spark, documents, model).agg(F.sum("log_likelihood"), F.sum("n_tokens")).first()
    assert found[1] == total and found[0] / found[1] > plain + 0.2


def test_gradients_are_differences():
    rng = np.random.default_rng(3)
    w = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in lm.start().items()}
    stream = np.array([0, 0, 5, 9, 900, 5, 5, 33, 1023, 0, 0], np.int16)
    at = np.arange(lm.SIDE, len(stream) - lm.SIDE)
    for name, (rows, gradient) in lm.gradients(w, stream, at).items():
        whole = np.zeros_like(w[name])
        whole[rows] = gradient
        places = np.argwhere(whole != 0)
        for r, c in [*places[rng.choice(len(places), min(25, len(places)), replace=False)], (0, 0)]:
            values = []
            for step in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][r, c] += step
                values.append(-lm.log_probabilities(moved, stream, at).sum())
            assert whole[r, c] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4, abs=1e-7)


def test_probabilities_sum_to_one(model):
    stream = np.array([0, 0, 5, 9, 40, 0, 0], np.int16)
    total = 0.0
    for token in range(lm.VOCABULARY):
        stream[3] = token
        total += np.exp(lm.log_probabilities(model.weights, stream, np.array([3]))[0])
    assert abs(total - 1) < 1e-3


def test_empty_table_and_ties(spark, none, model):
    assert lm.score(spark, none, model).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert sorted(tuple(r) for r in lm.score(spark, blank, model).collect()) == [(i, 0, 0.0, None) for i in (1, 2, 3)]
    fresh = lm.fit(spark, none, Scratch(spark, "lm-none"))
    assert fresh.vocabulary.where("word is not null").count() == 0
    assert all((fresh.weights[k] == v).all() for k, v in lm.start().items())
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert lm.score(spark, twice, model).select(F.count_distinct("log_likelihood"), F.count("*")).first() == (1, 2)


def test_small_blocks_and_other_ids(spark, documents, model, monkeypatch):
    """Blocks of a few texts give the same scores; ids of any type come back."""
    monkeypatch.setattr(lm, "BLOCK_WORDS", 300)
    monkeypatch.setattr(lm, "SLICE_CHARS", 5000)
    assert lm.read_blocks(documents.coalesce(1), Scratch(spark, "lm-blocks")).where("stream is not null").count() > 10
    whole = {r.doc_id: r.log_likelihood for r in lm.score(spark, documents, model).collect()}
    named = documents.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text").repartition(7)
    parts = {r.doc_id: r.log_likelihood for r in lm.score(spark, named, model).collect()}
    assert len(parts) == len(whole) and all(parts[f"d{k}"] == pytest.approx(v, abs=1e-4) for k, v in whole.items())


def test_tasks_train_on_from_the_average(spark, documents, monkeypatch):
    """Every pass after the first begins with the weights that the one before gave."""
    given, made, average = [], [], lm._average

    def kept(encoded, weights, *rest):
        given.append(weights)
        made.append(average(encoded, weights, *rest))
        return made[-1]

    monkeypatch.setattr(lm, "_average", kept)
    lm.fit(spark, documents.limit(60), Scratch(spark, "lm-rounds"))
    assert len(given) >= 2
    for before, after in zip(made, given[1:]):
        assert all((before[k] == after[k]).all() for k in before)


def test_words_are_split_as_bytes_are():
    """In Arrow, whole slices at once: distinct words in the order in which they appear."""
    texts = ["x y", None, "", "  ", "\tB b\x0bA\x0c c\r\n", "x\x1cy z\x1f", " nÉ İ x", "c  B\x85 y "]
    distinct, places, sizes = lm._split(pa.array(["left out", *texts]).slice(1))
    expected = [words_of(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in expected]
    assert [distinct[i].as_py() for i in places] == [w for words in expected for w in words]
    assert distinct.to_pylist() == list(dict.fromkeys(w for words in expected for w in words))


def test_the_query_writes_what_it_reads(spark, tmp_path, monkeypatch):
    """Its vocabulary is derived from the written words, not written as a table that nothing reads."""
    rows = [(i, t) for i, t in enumerate(["one two two", "two three", None, "One"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    names, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: names.append(name) or save(self, df, name))
    out = lm.op1_pseudo_likelihood(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.n_tokens for r in out] == [3, 2, 0, 1] and {"words", "encoded"} <= set(names)
    assert "vocabulary" not in names
