"""Operator 7: ids as the tokenizers library's, a valid and tight packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from churnlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, library, capacity):
    """Every document's pieces are there, whole, and sequences are gapless."""
    expected, held = Counter(), defaultdict(list)
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        cut = len(ids) % capacity or capacity
        bounds = [0, *range(cut, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_odd_rows_and_documents(spark, odd, none, documents):
    library = Tokenizer.from_file(PATH)
    for docs, capacity in ((odd, 128), (documents, 2048)):
        rows = packing.pack(spark, docs, PATH, capacity).collect()
        used = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library, capacity)
        assert used <= -(-sum(r.length for r in rows) // capacity) * 1.02 + 1
    assert packing.pack(spark, none, PATH).count() == 0


def test_ids_are_the_library_s():
    random.seed(2)
    library = Tokenizer.from_file(PATH)
    signs = "aB1 \n\t'._<|>²éßŉſªʰ٣ \x1c\x85\xa0日🙂́s"
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 50))) for _ in range(2000)]
    for text in [*texts, "<|endoftext|>x<|endoftext|>", "it's we'll 'sx", "  a  b\n\n c", "z" * 3000]:
        assert packing.token_ids(PATH, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_plan_places_all_and_is_best_fit():
    random.seed(1)
    for _ in range(150):
        sizes = [random.choice([random.randint(1, 100), random.randint(1, 12)]) for _ in range(random.randint(1, 300))]
        slots = packing.plan(dict(Counter(sizes)), 100)
        placed, contents = Counter(), defaultdict(list)
        for length, rank, count, sequence, step, at in slots:
            placed[length] += count
            for i in range(count):
                contents[sequence + i // step].append((at + i % step * length, length))
        assert placed == Counter(sizes)
        # best-fit decreasing, one piece at a time
        free = []
        for size in sorted(sizes, reverse=True):
            fit = min((f for f in free if f >= size), default=None)
            if fit is not None:
                free.remove(fit)
            free.append((100 if fit is None else fit) - size)
        assert sorted(100 - sum(l for _, l in p) for p in contents.values()) == sorted(free)


def test_long_white_space():
    """Runs of white space beyond what the pattern's look-ahead can step back through."""
    library = Tokenizer.from_file(PATH)
    end = "<|endoftext|>"
    texts = [w * 1_000_000 for w in (" ", "\t", "\n", "\u2003")] + [" " * 5_000_000, "\n" * 5_000_000, "\t" * 5_000_000]
    texts += ["a" + w * 1_000_000 + "b" for w in (" ", "\t", "\n")] + ["one " + " \n" * 600_000 + "two  three " + " " * 20_000 + "'s"]
    texts += ["x" + " " * 20_000 + end + " " * 20_000 + "y" + end + "\n" * 20_000, " " * 9_999 + "b", " " * 10_000 + "b", "\u200b" * 12_000,
              "\x1c" * 12_000 + "q", "\u3000" * 10_001 + "\u3042", "z" * 30_000 + " " * 30_000]
    for text in texts:
        assert packing.token_ids(PATH, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_ranks_in_many_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "PART", 2)  # more parts than the least number
    rows = packing.pack(spark, documents, PATH).collect()
    check(rows, [(r.doc_id, r.text) for r in documents.collect()], Tokenizer.from_file(PATH), 2048)
