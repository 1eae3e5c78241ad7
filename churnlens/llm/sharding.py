"""Operator 9: shards by extendible hashing.

A document's key is hashed to 60 bits; the directory is indexed by a prefix
of these bits. A bucket over the byte limit splits on its next bit, only it,
until every shard fits. Splits are decided on sums of cells (prefixes a few
bits finer than the shards should need), so documents are read once and the
directory stays a table. Cells that alone exceed the limit go on with finer
bits, then with the bits of a hash of the text; rows equal in both are dealt
out to numbered pages.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

LIMIT, BITS, STEP = 1 << 20, 60, 12


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a value's text; a null is the empty text."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column | str, width: int, depth) -> Column:
    """The first ``depth`` bits of a number of ``width`` bits."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return F.call_function("shiftright", bits, (F.lit(width) - depth).cast("int"))


def _split(rows: DataFrame, base: int, depth: int, limit: int, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Shards among the cells of ``depth`` bits, and the cells that don't fit.

    ``rows``: stem (of what was split before), bits, bytes. Each cell takes
    its shortest prefix whose documents fit (or that holds one document)."""
    cells = rows.groupBy("stem", _prefix("bits", BITS, F.lit(depth)).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
    cells = scratch.save(cells, f"{name}-cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(depth))))
    levels = levels.withColumn("prefix", _prefix("cell", depth, F.col("depth")))
    fits = (levels.groupBy("stem", "depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
            .where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)))
    chosen = levels.select("stem", "cell", "depth", "prefix").join(fits, ["stem", "depth", "prefix"])
    chosen = (chosen.groupBy("stem", "cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("s"))
              .select("stem", "cell", "s.*"))
    shown = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    chosen = scratch.save(chosen.withColumn("shard", F.concat("stem", shown)), f"{name}-shards")
    return chosen, cells.join(chosen, ["stem", "cell"], "left_anti").select("stem", "cell")


def assign(spark: SparkSession, docs: DataFrame, limit: int = LIMIT, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The shard of each row of ``docs`` (doc_id, text).

    doc_id, bytes (of the text in UTF-8; null: 0), shard (hash bits as text;
    after ``/`` those of the text's hash, after ``#`` a page), depth (bits),
    shard_bytes, shard_docs. Every shard has at most ``limit`` bytes or one
    document. Rows of equal id part only where they don't fit together.
    An empty table gives no rows. Columns ``keep`` come along (names other
    than those above and stem, bits, content, cell)."""
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, F.col(key).alias("doc_id"), hash_bits(F.col(key)).alias("bits"),
                       F.xxhash64(text).alias("content"), F.octet_length(text).cast("long").alias("bytes"))
    rows = scratch.save(rows.withColumn("stem", F.lit("")), "rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    base, depth = 0, min(BITS, max(1, math.ceil(math.log2(max(2, total / limit))) + 3))
    out, stage = None, "key"
    while True:
        shards, rest = _split(rows, base, depth, limit, scratch, f"{stage}-{depth}")
        cell = _prefix("bits", BITS, F.lit(depth)).alias("cell")
        placed = (rows.select(*keep, "doc_id", "bytes", "stem", cell).join(shards, ["stem", "cell"])
                  .select(*keep, "doc_id", "bytes", "shard", F.lit(0).cast("long").alias("page"), "depth", "shard_bytes", "shard_docs"))
        out = placed if out is None else out.union(placed)
        if rest.isEmpty():
            break
        rows = scratch.save(rows.withColumn("cell", cell).join(rest, ["stem", "cell"]).drop("cell"), f"{stage}-{depth}-rest")
        if depth < BITS:
            base, depth = depth + 1, min(BITS, depth + STEP)
        elif stage == "key":
            stage, base, depth = "text", 0, STEP
            rows = rows.select(*keep, "doc_id", F.expr(f"shiftrightunsigned(content, {64 - BITS})").alias("bits"), "content", "bytes",
                               F.concat("stem", F.lpad(F.bin("bits"), BITS, "0"), F.lit("/")).alias("stem"))
        else:
            out = out.union(_pages(rows, limit, keep))
            break
    return out.select(*keep, "doc_id", "bytes", "shard", "page", "depth", "shard_bytes", "shard_docs")


def _pages(rows: DataFrame, limit: int, keep: tuple[str, ...] = (), part: Column | None = None) -> DataFrame:
    """Rows equal in id and text, dealt out: as many pages as needed by a hash of
    their place in the file, in each as many as fit (``page`` counts on)."""
    same = Window.partitionBy("stem", "bits", "part").orderBy("bytes")
    rows = (rows.withColumn("part", (F.spark_partition_id() if part is None else part).cast("long"))
            .withColumn("n", F.row_number().over(same) - 1)
            .withColumn("fit", F.greatest(F.lit(limit).cast("long") / F.greatest("bytes", F.lit(1)), F.lit(1)).cast("long"))
            .withColumn("page", (F.col("part") * 1_000_000 + F.expr("n div fit")))
            .withColumn("shard", F.concat("stem", F.lpad(F.bin("bits"), BITS, "0"), F.lit("#"), "page")))
    own = rows.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    return rows.join(own, "shard").select(*keep, "doc_id", "bytes", "shard", "page", F.lit(2 * BITS).alias("depth"),
                                          "shard_bytes", "shard_docs")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Write ``docs`` under ``path``, a folder for each shard (column ``shard``,
    in place of an input column of that name); returns the shards.

    Every row is written once, to its own shard: rows are numbered and written
    to the shared folder first, so null and repeated ids are no different and
    numbers don't change when a lost executor's rows are read again."""
    scratch = Scratch(spark, "shards")
    number = next(name for i in itertools.count() if (name := f"_number{i}") not in docs.columns)
    rows = scratch.save(docs.drop("shard").withColumn(number, F.monotonically_increasing_id()), "rows")
    shards = scratch.save(assign(spark, rows, limit, keep=(number,)), "assigned")
    placed = rows.join(shards.select(number, F.concat(F.lit("s"), "shard").alias("shard")), number).drop(number)
    placed.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
    return shards.groupBy("shard").agg(F.first("depth").alias("depth"), F.sum("bytes").alias("bytes"),
                                       F.count("*").alias("docs"))


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB for all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign(spark, docs).drop("page")


ORACLE = """
with docs as (
  select doc_id, cast(coalesce(octet_length(encode(text)), 0) as bigint) bytes,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) bits from documents),
levels as (select doc_id, bytes, bits, unnest(range(0, 31)) depth from docs),
sums as (select *, sum(bytes) over w shard_bytes, count(*) over w shard_docs from levels
  window w as (partition by depth, bits >> (60 - depth))),
fit as (select doc_id, bytes, min(depth) depth, first(bits) bits, arg_min(shard_bytes, depth) shard_bytes,
    arg_min(shard_docs, depth) shard_docs
  from sums where shard_bytes <= 1048576 or shard_docs = 1 group by doc_id, bytes)
select doc_id, bytes, case when depth = 0 then '' else lpad(bin(bits >> (60 - depth)), cast(depth as int), '0') end shard,
  cast(depth as int) depth, cast(shard_bytes as bigint) shard_bytes, shard_docs from fit
"""
