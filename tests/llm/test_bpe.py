"""Operator 4 against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aAB1 \n\t'._<|>²éßŉſªʰ٣ \x1c\x85\xa0日🙂́sΣİſKÅ"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_texts_encode_and_decode_as_the_library_does(library):
    random.seed(5)
    model = bpe.merges(PATH)
    texts = ["".join(random.choice(SIGNS) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    texts += ["", "<|startoftext|>x<|endoftext|>y", "word " * 50, "x" * 900 + "aéß" * 300, "it's we'll 'S I'm"]
    for size in (0, 300):
        words = [w for t in texts for w in model.words(t)][:size]
        lexicon = bpe.Transducer(bpe.compile_lexicon(words, model))
        for text, (ids, decoded) in zip(texts, bpe.encode(lexicon, model, texts)):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, text
            assert decoded.decode() == library.decode(expected, skip_special_tokens=False)


def test_transducer_is_minimal_and_exact():
    model = bpe.merges(PATH)
    words = ["walking", "talking", "walked", "talked", "walk", "talk", "king", "é"]
    lexicon = bpe.Transducer(bpe.compile_lexicon(words, model))
    # one state for each distinct set of endings
    keys = [w.encode() for w in words]
    endings = {frozenset(k[len(p):] for k in keys if k.startswith(p)) for p in {k[:i] for k in keys for i in range(len(k) + 1)}}
    assert len(lexicon.final) == len(endings)
    asked = [*words, "wal", "walkin", "walkings", "x", "", "king"]
    places = lexicon.find([w.encode() for w in asked])
    assert sorted(places[:8]) == list(range(8)) and (places[8:13] == -1).all() and places[13] == places[6]
    for w, p in zip(words, places):
        assert lexicon.output(p) == model.output(w)


def test_query_on_documents_and_odd_rows(spark, odd, none, documents, library):
    for docs in (odd, documents):
        texts = {}
        for r in docs.select("doc_id", "text").collect():
            texts.setdefault(r.doc_id, []).append(r.text or "")
        rows = bpe.encode_documents(spark, docs, PATH, size=500).collect()
        assert len(rows) == sum(map(len, texts.values()))
        for r in rows:
            assert (bytes(r.ids), r.decoded) in [
                (np.array(e, "<u4").tobytes(), library.decode(e, skip_special_tokens=False))
                for e in (library.encode(t, add_special_tokens=False).ids for t in texts[r.doc_id])]
    assert bpe.encode_documents(spark, none, PATH).count() == 0


def test_digests(spark, library):
    from churnlens.llm.queries import QUERIES
    rows = QUERIES["op4_bpe_transducer"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
