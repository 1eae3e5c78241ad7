"""A training corpus from ``documents``: language ID, near-dedup, PII, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. Each stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import langid, minhash, packing, surrogates
from churnlens.llm.common import Scratch
from churnlens.session import ensure_checkpoint_dir

#: Five-word shingles; similarity of 0.8, in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80
#: The setting that holds the secret of a production run's surrogates.
SURROGATE_KEY = "spark.churnlens.surrogate.secret"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; ``lang`` becomes the prediction.

    The model learns from ``documents`` as given, outside the held-out part.
    Rejected are texts without a letter (null and empty ones too): ``und``."""
    del sf_dir
    model = langid.fit(docs, ~langid.held_out())
    names = ("_predicted_language", "_predicted_score")
    found = langid.predict(docs, model, keep=tuple(docs.columns), names=names)
    rows = found.where(F.col(names[0]) != langid.UNDETERMINED).withColumn("lang", F.col(names[0]))
    return rows.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of smallest doc_id.

    Every row has a number of its own and is judged by it, so rows of equal
    doc_id go only as copies of each other's texts; among them the first row
    stays. Rows without a doc_id stay. The numbered rows are written first:
    numbers must not change when a lost executor's rows are read again."""
    del sf_dir
    scratch = Scratch(spark, "near-dedup")
    row = next(name for i in itertools.count() if (name := f"_row{i}") not in docs.columns)
    rows = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    number = F.when(F.col("doc_id").isNotNull(), F.col(row))
    found = minhash.near_duplicates(spark, rows.select(number.alias("doc_id"), "text"), SHINGLE_WORDS, SIMILARITY)
    groups = (found.where("doc_id is not null").select(F.col("doc_id").alias(row), "component_id")
              .join(rows.select(row, "doc_id"), row))
    first = groups.groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias("first"))
    gone = groups.select(row).join(first.select(f"first.{row}"), row, "left_anti")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data in every text; all rows stay. The key is
    the session's ``SURROGATE_KEY``, a public one (for tests) where it is unset."""
    del sf_dir
    key = spark.conf.get(SURROGATE_KEY, surrogates.QUERY_KEY)
    return surrogates.replace_entities(spark, docs, key).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens."""
    del sf_dir
    import public_tokenizers

    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", pii), ("best_fit_packing", best_fit_packing)]

#: Neither the models nor the tokenizer are SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}-{name}")
        docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
