"""Operator 9 against a plain extendible directory."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from churnlens.llm import sharding


def bits(doc):
    return bin(int("1" + hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:15], 16))[3:]


def plain(rows, limit):
    """Split buckets that are too large on their next bit; (doc, bytes) -> shard."""
    out, todo = {}, [("", rows)]
    while todo:
        name, own = todo.pop()
        if sum(b for _, b in own) <= limit or len(own) == 1:
            out.update({(d, b): name for d, b in own})
        else:
            parts = defaultdict(list)
            for d, b in own:
                parts[bits(d)[:len(name) + 1]].append((d, b))
            todo += parts.items()
    return out


def test_directory(spark):
    random.seed(3)
    rows = [(i, random.choice([0, 10, 100, 3000])) for i in range(700)]
    docs = spark.createDataFrame([(d, "x" * b) for d, b in rows], "doc_id long, text string")
    for limit in (500, 4000, 10**9):
        found = sharding.assign(spark, docs, limit).collect()
        want = plain(rows, limit)
        assert {(r.doc_id, r.bytes): r.shard for r in found} == want
        sums = defaultdict(int)
        for r in found:
            sums[r.shard] += r.bytes
            assert r.depth == len(r.shard)
        assert all(r.shard_bytes == sums[r.shard] for r in found)


def test_equal_ids_are_split_by_text_then_paged(spark):
    rows = [(1, "same text")] * 40 + [(1, f"other {i}") for i in range(40)] + [(2, "x")]
    found = sharding.assign(spark, spark.createDataFrame(rows, "doc_id long, text string"), 30).collect()
    assert len(found) == len(rows)
    sums = defaultdict(list)
    for r in found:
        sums[r.shard].append(r.bytes)
    assert all(sum(b) <= 30 or len(b) == 1 for b in sums.values())


def test_odd_rows(spark, odd, none, tmp_path):
    found = sharding.assign(spark, odd, 1000).collect()
    assert len(found) == odd.count()
    assert sharding.assign(spark, none).count() == 0
    shards = sharding.write_shards(spark, odd, f"file://{tmp_path}/shards", 1000)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    columns = [c for c in odd.columns if c != "shard"]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, odd.select(columns).collect()))
    assert shards.agg({"docs": "sum"}).first()[0] == odd.count()


def test_writer_keeps_every_row(spark, tmp_path):
    """Null and repeated ids, equal rows beyond a page: each row is in one shard, once."""
    rows = [(None, "a"), (1, "b"), (1, "b"), (1, "c"), (2, "d"), (None, "a"), (None, None)] + [(7, "same text")] * 20
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, _number0 int")
    sharding.write_shards(spark, docs, f"file://{tmp_path}/s", 30)
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert sorted(map(str, [(r.doc_id, r.text, r._number0) for r in back.collect()])) == sorted(map(str, [(*r, 5) for r in rows]))


def test_pages_of_many_partitions(spark):
    rows = spark.range(6).select(F.lit(1).alias("doc_id"), F.lit("s/").alias("stem"), F.col("id").alias("bits"), F.lit(9).cast("long").alias("bytes"))
    found = sharding._pages(rows, 20, part=F.lit(5000)).collect()
    assert {r.page for r in found} == {5_000_000_000} and len(found) == 6
