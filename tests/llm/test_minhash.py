"""Operator 2 against brute force over all pairs."""

import random

import pytest

from churnlens.llm import minhash


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, k, percent=80):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, shingles(text, k))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def check(rows, found, k):
    expected = brute(rows, k)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = minhash.near_duplicates(spark, odd, 2, 80).collect()
    assert len(found) == len(rows)
    check(rows, found, 2)


def test_empty_table(spark, none):
    assert minhash.near_duplicates(spark, none, 5, 80).count() == 0


@pytest.mark.parametrize("shingles", [minhash.BLOCK_SHINGLES, 300])
def test_groups_of_near_copies(spark, monkeypatch, shingles):
    """Copies around a text that are near it but not all near each other, chains, and strangers;
    in whole buckets and in blocks of a few texts, cut by their shingles."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(minhash, "TOGETHER_SHINGLES", 10 * shingles)
    random.seed(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(4):
        base = random.choices(vocabulary, k=120)
        for edits in [0] + [random.randint(1, 7) for _ in range(30)]:
            words = list(base)
            for _ in range(edits):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    chain = random.choices(vocabulary, k=100)
    for _ in range(12):
        chain = chain[4:] + random.choices(vocabulary, k=4)
        rows.append((len(rows) * 3 + 1, " ".join(chain)))
    rows += [(len(rows) * 3 + 1 + i, " ".join(random.choices(vocabulary, k=30))) for i in range(20)]
    random.shuffle(rows)
    for k in (2, 5):
        found = minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), k, 80).collect()
        check(rows, found, k)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_slices_of_few_words(n):
    """All words of a slice together may be fewer than a shingle's; a text's set never depends on its slice."""
    text = " ".join("abcdef"[:n]).encode()
    (alone,) = minhash.shingle_sets([text], 5)
    assert len(alone) == max(1, n - 4)
    among = minhash.shingle_sets([b"some other words that fill up the slice", text, None, b""], 5)
    assert (among[1] == alone).all() and len(among[2]) == len(among[3]) == 0
