"""Operator 5: document fingerprints as bottom-k sketches of shingle hashes.

A sketch is the sorted array of the ``SIZE`` smallest distinct 64-bit hashes
of a text's five-word shingles (all of them if there are fewer). Sketches
merge by union, and estimate resemblance, containment and the number of
distinct shingles. Everything is a Spark expression.

A-Z is lower-cased, words are runs without ASCII white space. A text of one
to four words has one shingle, a null or blank text an empty sketch.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, let

SIZE, WORDS = 128, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bottom(hashes: Column, size: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def sketch(text: Column | str, size: int = SIZE, words: int = WORDS) -> Column:
    """The sketch of a text: array<bigint>, ascending, never null."""
    parts = F.split(F.translate(F.coalesce(_col(text), F.lit("")), _UPPER, _LOWER), "[ \\t\\n\\x0B\\f\\r]+")
    hashed = F.transform(F.array_remove(parts, ""), lambda w: F.xxhash64(w))
    starts = lambda h: F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1)))
    shingles = let(hashed, lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(starts(h), lambda i: F.xxhash64(F.slice(h, i, words)))))
    return _bottom(shingles, size)


def merge(a: Column | str, b: Column | str, size: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_groups(parts: DataFrame, by: list[str], column: str = "sketch", size: int = SIZE) -> DataFrame:
    """One merged sketch for each group. Each task first keeps a group's ``size``
    smallest hashes (a limit on the rank), so a group of any size stays small."""
    order = Window.partitionBy(*by).orderBy("_hash")
    hashes = parts.select(*by, F.explode(column).alias("_hash")).distinct()
    low = hashes.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
    return low.groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column | str, b: Column | str, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity (exact for small sets): the share of the
    union's smallest hashes found in both; 1 for two empty sketches."""
    def share(u: Column) -> Column:
        return F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)
    return let(merge(a, b, size), lambda u: F.when(F.size(u) == 0, 1.0).otherwise(share(u)))


def containment(a: Column | str, b: Column | str, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too; 1 if a is empty."""
    a, b = _col(a), _col(b)
    top = F.lit((1 << 63) - 1)
    reach = F.least(F.when(F.size(a) >= size, F.array_max(a)).otherwise(top),
                    F.when(F.size(b) >= size, F.array_max(b)).otherwise(top))
    seen = F.size(F.filter(a, lambda x: x <= reach))
    both = F.size(F.filter(F.array_intersect(a, b), lambda x: x <= reach))
    return F.when(F.size(a) == 0, 1.0).when(seen == 0, 0.0).otherwise(both / seen)


def distinct_shingles(a: Column | str, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    a = _col(a)
    reach = (F.array_max(a).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / reach)


def fingerprint(a: Column | str) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def with_next(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, text) in ranges of doc_id, and the window in whose
    order the next row is the next document, descending doc_id.

    Ranges hold about as many documents each, four for each shuffle partition.
    Each range ends with a copy of the next range's first document (``copied``;
    after the last range: the first), so one shuffle serves all rows. Null
    ids come last; rows of equal id go by their text."""
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # where Spark's range partitioning of the ids cuts: as many numbers as ranges
    dealt = docs.where("doc_id is not null").select("doc_id").repartitionByRange(ranges, "doc_id")
    cuts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.col("doc_id").cast("double")).alias("least")).collect()
    cuts = sorted({r.least for r in cuts})[1:]
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("_id"))
    if cuts:
        docs = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_id", outputCol="_at").transform(docs)
    else:
        docs = docs.withColumn("_at", F.lit(0.0))
    docs = docs.withColumn("range", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("_at").cast("int")))
    docs = docs.select("range", F.lit(False).alias("copied"), "doc_id", "text")
    order = (F.col("copied"), F.col("doc_id").desc_nulls_last(), "text")
    inside = Window.partitionBy("range").orderBy(*order)
    firsts = docs.withColumn("_n", F.row_number().over(inside)).where("_n = 1").drop("_n")
    firsts = scratch.save(firsts, "firsts")
    # the range before each one, by number, the last one's after the first: one row a range
    numbers = Window.orderBy("range")
    goes = firsts.select("range", F.lead("range").over(numbers).alias("_next"), F.min("range").over(
        numbers.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_least"))
    copies = firsts.join(goes.select("range", F.coalesce("_next", "_least").alias("_to")), "range")
    copies = copies.select(F.col("_to").alias("range"), F.lit(True).alias("copied"), "doc_id", "text")
    return docs.unionByName(copies), inside


def edited(text: Column | str, following: Column | str) -> Column:
    """``text``, its last half (floor) replaced by as many first code points of ``following``."""
    text, half = _col(text), F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text (see ``edited``,
    with the next document by descending doc_id; the only document is its own
    next). One row for each row of ``docs``; null texts count as empty. An
    empty table gives no rows."""
    rows, order = with_next(docs, Scratch(spark, "fingerprints"))
    rows = (rows.withColumn("following", F.lead("text").over(order))
            .withColumn("edited", F.when(~F.col("copied"), edited("text", "following")))
            .select("range", "copied", "doc_id", "text", F.char_length("text").alias("n_chars"),
                    F.sha2("edited", 256).alias("edited_sha256"), sketch("text").alias("sketch"),
                    F.when(~F.col("copied"), sketch("edited")).alias("edited_sketch")))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order)).where("not copied")
    return rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                       fingerprint("sketch").alias("fingerprint"), fingerprint("edited_sketch").alias("edited_fingerprint"),
                       resemblance("sketch", "edited_sketch").alias("near_edited"),
                       resemblance("sketch", "next_sketch").alias("near_next"),
                       distinct_shingles("sketch").alias("n_shingles_estimate"),
                       containment("edited_sketch", "sketch").alias("edited_contained"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and their edited texts."""
    return fingerprint_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
