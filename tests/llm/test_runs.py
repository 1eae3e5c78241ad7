"""Operator 11: runs against their definition, word by word."""

import hashlib
import random
import zlib
from fractions import Fraction

from churnlens.llm import runs


def smallest_period(words):
    fail = [0] * (len(words) + 1)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k]
        k += words[i] == words[k]
        fail[i + 1] = k
    return len(words) - fail[len(words)]


def brute(words):
    """All runs, by trying every period at every place."""
    out = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and smallest_period(words[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(values):
    return [str(v).encode() for v in values]


def hard_texts():
    r = random.Random(5)
    for size in (2, 3, 5):
        for n in (23, 24, 60, 200, 400):
            yield [r.randrange(size) for _ in range(n)]
    fib, thue = [0], [0]
    while len(fib) < 900:
        fib = [x for v in fib for x in ((0, 1) if v == 0 else (0,))]
    while len(thue) < 1024:
        thue += [1 - v for v in thue]
    yield fib
    yield thue
    yield thue[:100] * 4
    yield [0] * 300
    yield [0] * 23
    for _ in range(60):  # runs inside other words, of every length of period, at and just below the least length
        period = r.randrange(1, 90)
        block = [r.randrange(r.choice((2, 4, 1000))) for _ in range(period)]
        length = r.choice((3 * period - 1, 3 * period, 3 * period + 1, 5 * period + 2))
        head, tail = ([r.randrange(1000) for _ in range(r.randrange(40))] for _ in range(2))
        yield head + [block[i % period] for i in range(length)] + tail
    nested = ([7, 8, 9] * 9 + [1, 2]) * 5
    yield nested + list(range(50)) + nested


def test_definition():
    texts = [numbers(t) for t in hard_texts()]
    expected = [brute(t) for t in texts]
    assert runs.runs_of(texts) == expected
    assert sum(map(len, expected)) > 100 and max(q for e in expected for _, _, q in e) > 80
    assert [runs.runs_of([t])[0] for t in texts[-20:]] == expected[-20:]


def digests(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(), len(words))


def check(rows, docs):
    assert sorted((tuple(r) for r in rows), key=str) == sorted((digests(d, t) for d, t in docs), key=str)


def test_query(spark, tmp_path):
    r = random.Random(3)
    given = [(d, t) for d, t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
             .select("doc_id", "text").collect() if len(t or "") < 8000]
    given += [(1000 + i, " ".join(str(r.randrange(50)) for _ in range(r.randrange(300)))) for i in range(80)]
    given += [(None, "a b " * 20), (5000, None), (5001, ""), (5002, " \t\n"), (5003, "x y z " * 9), (5003, "x y z " * 9)]
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = runs.op11_periodic_runs(spark, str(tmp_path))
    check(found.collect(), given)
    assert sum(r.n_runs > 0 for r in found.collect()) > 15


def test_odd_rows(spark, odd, none):
    found = runs.find_runs(odd).collect()
    assert len(found) == odd.count()
    at = {r.doc_id: r for r in found}
    assert at[5].n_words == at[6].n_words == at[7].n_words == 0 and at[5].collapsed == "" and not at[7].runs
    assert [tuple(r) for r in at[9].runs] == [(0, 24000, 6)] and at[9].collapsed == "une longue phrase avec des mots"
    assert [tuple(r) for r in at[10].runs] == [(0, 24000, 6)] and at[10].collapsed.endswith("mots fin")
    assert runs.find_runs(none).count() == 0
