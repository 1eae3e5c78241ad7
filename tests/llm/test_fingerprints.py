"""Operator 5: contract columns exactly, likenesses against true similarities."""

import hashlib

from pyspark.sql import functions as F

from churnlens.llm import fingerprints


def jaccard(a, b, k=5):
    def shingles(t):
        words = t.encode().lower().split()
        return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edited_texts(rows):
    """(doc_id, text, edited, next) in descending doc_id, nulls last, ties by text."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        yield d, t, t[:len(t) - half] + following[:half], following


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = fingerprints.fingerprint_documents(spark, docs).collect()
    expected = sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edited_texts(rows))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == expected
    return rows, found


def test_odd_rows(spark, odd):
    rows, found = check(spark, odd)
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[2] != prints[3] and prints[4] == prints[8] and prints[5] == prints[6] == {""}


def test_documents(spark, documents):
    rows, found = check(spark, documents)
    true = {d: (jaccard(t, e), jaccard(t, n)) for d, t, e, n in edited_texts(rows)}
    errors = [abs(x - y) for r in found for x, y in zip((r.near_edited, r.near_next), true[r.doc_id])]
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.02


def test_one_row_and_none(spark, none):
    one = spark.createDataFrame([(3, "a b c d e f g")], "doc_id long, text string")
    row, = fingerprints.fingerprint_documents(spark, one).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b c da b c ").hexdigest()
    assert fingerprints.fingerprint_documents(spark, none).count() == 0


def test_sketch_algebra(spark):
    text = " ".join(f"w{i}" for i in range(900))
    parts = spark.createDataFrame([(1, text, " ".join(text.split()[:600])), (1, text, "other words of five or so")], "g int, a string, b string")
    rows = parts.select("g", fingerprints.sketch("a").alias("a"), fingerprints.sketch("b").alias("b"))
    r = rows.select(fingerprints.resemblance("a", "b").alias("r"), fingerprints.containment("b", "a").alias("c"),
                    fingerprints.distinct_shingles("a").alias("d"), fingerprints.merge("a", "b").alias("m")).collect()
    assert abs(r[0].r - 596 / 896) < 0.15 and r[0].c == 1.0 and abs(r[0].d - 896) < 250 and r[1].r == 0.0
    assert len(r[0].m) == fingerprints.SIZE
    merged = fingerprints.merge_groups(rows.select("g", F.col("a").alias("sketch")), ["g"]).collect()[0].sketch
    assert merged == rows.select("a").first().a
