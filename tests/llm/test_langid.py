"""Operator 10: against a plain cross-parse, and held-out accuracy."""

import random

from pyspark.sql import functions as F

from churnlens.llm import langid


def plain_phrases(sample, text):
    """Phrases of a text in blocks, each the longest match in the sample (a symbol at least)."""
    normal = "".join(c if c.isalpha() else " " for c in text.lower() + " ")
    kept = "".join(c for i, c in enumerate(normal) if c != " " or (i and normal[i - 1] != " "))
    count = 0
    for b in range(0, len(kept), langid.BLOCK):
        block, at = kept[b:b + langid.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end < len(block) and block[at:end + 1] in sample:
                end += 1
            count, at = count + 1, end
    return count, len(kept)


def test_phrases_are_longest_matches():
    random.seed(3)
    samples = tuple("".join(random.choice("abcde  ") for _ in range(300)).replace("  ", " ").strip() for _ in range(2))
    model = langid.Model(("aa", "bb"), samples, "abcde")
    texts = ["".join(random.choice("abcde ,X") for _ in range(random.randint(1, 1500))) for _ in range(20)] + ["a", "a b"]
    bits, letters = langid.entropies(model, texts)
    logs = langid._tables(model)[3]
    for t, row in zip(texts, bits):
        for sample, log, value in zip(samples, logs, row):
            count, size = plain_phrases(sample, t.replace("X", "x"))
            assert abs(value - count * log / max(size, 1)) < 1e-9
    assert letters.all()


def test_accuracy_on_documents_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~langid.held_out())
    out = langid.predict(docs.where(langid.held_out()), model, keep=("doc_id", "lang"))
    right, total = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 250 and right / total >= 0.97


def test_accuracy_with_the_least_sample(spark, monkeypatch):
    """What each language has when there are a great many of them."""
    monkeypatch.setattr(langid, "MODEL_SYMBOLS", 0)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~langid.held_out())
    assert all(len(s) == langid.LEAST_SYMBOLS for s in model.samples)
    out = langid.predict(docs.where(langid.held_out()), model, keep=("doc_id", "lang"))
    right, total = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 250 and right / total >= 0.97


def test_samples_come_from_anywhere(spark, monkeypatch):
    """Not from the texts' beginnings alone: an opening that all texts share is not what is learned."""
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 50)
    rows = [(i, "same opening " * 20 + f"{'abc' if i % 2 else 'xyz'} " * 200, "aa" if i % 2 else "bb") for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert all("abc" in s if n == "aa" else "xyz" in s for n, s in zip(model.languages, model.samples))


def test_only_the_text_counts(spark, documents):
    model = langid.fit(documents, ~langid.held_out())
    plain = langid.predict(documents, model).collect()
    other = langid.predict(documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), model).collect()
    assert sorted(plain) == sorted(other)


def test_odd_rows(spark, odd, none, documents):
    model = langid.fit(documents, ~langid.held_out())
    rows = langid.predict(odd, model, keep=("doc_id", "text", "key")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert {r.lang_pred for r in rows if r.doc_id in (9, 10)} == {"fr"}
    assert langid.predict(none, model).count() == 0
    unlabelled = langid.fit(documents.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in langid.predict(odd, unlabelled).collect()} == {"und"}


def test_letters_beyond_the_alphabet_match():
    """Many scripts at once, two languages in each: letters outside the alphabet tell them apart as well."""
    rng = random.Random(5)
    scripts = {"latin": "abcdefghijklmnopqrstuvwxyzàâäçéèêëîïñóôöùûüß", "greek": "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώ",
               "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "chinese": "".join(chr(0x4E00 + 7 * i) for i in range(600))}
    words = {f"{s}-{i}": ["".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(150)]
             for s, letters in scripts.items() for i in (1, 2)}
    names = tuple(sorted(words))
    samples = tuple(" ".join(rng.choice(words[n]) for _ in range(800)) for n in names)
    counts = {}
    for c in "".join(samples).replace(" ", ""):
        counts[c] = counts.get(c, 0) + 1
    alphabet = "".join(sorted(counts, key=lambda c: (-counts[c], c))[:langid.ALPHABET])
    model = langid.Model(names, samples, alphabet)
    assert len(counts) > 256 + langid.ALPHABET
    texts = [(n, " ".join(rng.choice(words[n]) for _ in range(30))) for n in names for _ in range(5)]
    bits, letters = langid.entropies(model, [t for _, t in texts])
    assert letters.all() and [names[i] for i in bits.argmin(axis=1)] == [n for n, _ in texts]
