"""The pipeline's stages against brute force, on documents and on odd rows."""

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from .test_minhash import brute  # noqa: E402
from .test_packing import check  # noqa: E402


def stages(spark, docs, folder):
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def test_documents(spark, documents, tmp_path):
    spoilt = documents.withColumn("text", F.when(F.col("doc_id") == 3, None).when(F.col("doc_id") == 4, "12 ...").otherwise(F.col("text")))
    known, single, clean, packed = stages(spark, spoilt, tmp_path)
    assert known.columns == single.columns == clean.columns == documents.columns
    assert known.count() == documents.count() - 2
    kept = brute([(r.doc_id, r.text) for r in known.collect()], 5)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, (_, c) in kept.items() if d == c)
    assert clean.count() == single.count() and not clean.where(F.col("text").contains("@mail")).count()
    rows = packed.collect()
    check(rows, [(r.doc_id, r.text) for r in clean.collect()], Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 2048)


def test_odd_rows(spark, odd, documents, tmp_path):
    rows = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                      F.length("text").cast("long").alias("n_chars"), "key", "rank", "lang_pred")
    known, single, clean, packed = stages(spark, rows, tmp_path / "odd")
    assert known.count() == odd.count() - 3 and known.columns == rows.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted(map(str, [1, 3, 4, 9, 11, 12, None]))
    assert clean.count() == single.count() and packed.count() >= clean.count()
    assert not any(t.count() for t in stages(spark, rows.limit(0), tmp_path / "none"))


def test_two_texts_under_one_id(spark, tmp_path):
    """Rows of one id are judged by their texts; copies go whatever their ids."""
    words = [[f"{x}{i}" for i in range(40)] for x in "abc"]
    texts = [" ".join(w) for w in words]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (9, texts[0] + " more"), (3, texts[1] + " more"), (9, texts[2]), (None, texts[2])]
    docs = spark.createDataFrame([(d, t, d, "x") for d, t in rows], "doc_id long, text string, _row0 long, kept string")
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    found = sorted((str(r.doc_id), r.text) for r in left.collect())
    assert found == sorted([("7", texts[0]), ("3", texts[1] + " more"), ("9", texts[2]), ("None", texts[2])])


def test_long_white_space(spark, documents, tmp_path):
    """A text that a tokenizer's pattern can't step through passes all stages; a secret key takes effect."""
    long = "the first words " + " \n" * 600_000 + " and the last words"
    rows = documents.limit(20).union(spark.createDataFrame(
        [(10_001, long, "en", "s", len(long)), (10_002, "Mail ann.b@host.example.com for the first words", "en", "s", 47)], documents.schema))
    spark.conf.set(corpus_pipeline.SURROGATE_KEY, "k1")
    known, single, clean, packed = stages(spark, rows, tmp_path / "a")
    spark.conf.set(corpus_pipeline.SURROGATE_KEY, "k2")
    other = corpus_pipeline.pii(spark, single, "").where("doc_id = 10002").first().text
    spark.conf.unset(corpus_pipeline.SURROGATE_KEY)
    mine = clean.where("doc_id = 10002").first().text
    assert "ann.b" not in mine + other and mine != other
    check(packed.collect(), [(r.doc_id, r.text) for r in clean.collect()],
          Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 2048)
    assert packed.where("doc_id = 10001").agg({"length": "sum"}).first()[0] > 1_000_000
