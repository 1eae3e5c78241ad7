"""Readers and writers (A1-A6). Only this module touches storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quoted_csv
from .schemas import RAW, SILVER, TABLES


#: Where a CSV line that doesn't fit the header is kept as it came.
CORRUPT = "_corrupt_line"


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "csv", quoted_breaks: bool = True) -> DataFrame:
    """A1: ingest one raw table unmodified.

    CSV columns are found by the header's names, in any order; a declared
    column that the header lacks is an error, further columns are ignored.
    All values stay text (no inference pass): the raw layer keeps the
    source's formatting and a malformed value never fails a load; silver
    parses with its multi-layout ``try_`` parsers. Quoted line breaks are
    part of a value, and files are split all the same (``quoted_csv``);
    sources that have none may be read without that by ``quoted_breaks=False``
    (one scan, one header for the path). A line with too many or too few
    values is kept in ``_corrupt_line`` and counted by the rejected-rows
    report. Typed formats (Parquet, ORC) are cast to the raw schema.
    """
    schema = RAW[table]
    if fmt == "csv" and quoted_breaks:
        return quoted_csv.read(spark, path, schema.fieldNames(), CORRUPT)
    if fmt == "csv":
        options = {"header": "true", "escape": '"'}
        names = spark.read.options(**options).csv(path).columns
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {names}")
        text = ", ".join(f"`{n}` STRING" for n in [*names, CORRUPT])
        rows = (spark.read.schema(text).options(**options, mode="PERMISSIVE", enforceSchema="false",
                                                columnNameOfCorruptRecord=CORRUPT).csv(path))
        return rows.select(*schema.fieldNames(), CORRUPT)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw_dir(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """A1 for all seven tables laid out as ``root/<table>.<fmt>``."""
    return {t: read_raw(spark, f"{root}/{t}.{fmt}", t, fmt) for t in TABLES}


#: In a table's folder: names its current version's folder, then the one before.
POINTER = "_current"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as Hadoop's."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """The pointer's lines: the current version, and the one before if there was one."""
    fs, pointer = _file_system(spark, f"{folder}/{POINTER}")
    if not fs.exists(pointer):
        return []
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _switch(spark: SparkSession, folder: str, versions: list[str]) -> None:
    """Replace the pointer: a new file is renamed over the old one, which file systems do in one step."""
    fs, new = _file_system(spark, f"{folder}/_next-{uuid.uuid4().hex}")
    out = fs.create(new)
    out.write(bytearray("\n".join(versions), "utf-8"))
    out.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), fs.getConf())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}"), how)


def listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files right in a folder, and of its folders: changes when the data does."""
    fs, at = _file_system(spark, folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(at)))


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder that holds a table's current rows."""
    versions = _versions(spark, f"{root}/{name}")
    if not versions:
        raise FileNotFoundError(f"no table {name} in {root}")
    return f"{root}/{name}/{versions[0]}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A2: scan of a silver/gold table written by ``write_table``."""
    return spark.read.parquet(table_path(spark, root, name))


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Silver rows of a finished run (rows failing a foreign key stay in
    the same files, flagged, as the quarantine)."""
    return {t: read_table(spark, root, f"silver/{t}").where("_fk_ok")
            .select(*SILVER[t].fieldNames()) for t in TABLES}


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """A3/A5: DROP + CREATE TABLE AS -> replace a Parquet table as a whole, in
    one step (months that disappeared from the data disappear from the table).

    The rows go to a new folder; when all are written, the table's pointer is
    switched to it. A job that is lost before leaves the old table as it was,
    readers see either the old rows or the new ones, and ``df`` may read the
    table that it replaces. The version before stays for readers that have
    begun; the one before that is deleted.

    Month-keyed gold tables are partitioned by month so dashboard reads
    prune partitions.
    """
    spark, folder, version = df.sparkSession, f"{root}/{name}", f"v-{uuid.uuid4().hex}"
    if partition_by:
        # One writer per month instead of every task writing into every
        # month folder (tasks x months small files); AQE's rebalance splits
        # an oversized month and coalesces small ones.
        df = df.hint("rebalance", *partition_by)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{folder}/{version}")
    before = _versions(spark, folder)
    _switch(spark, folder, [version, *before[:1]])
    for old in before[1:]:
        fs, path = _file_system(spark, f"{folder}/{old}")
        fs.delete(path, True)
    return f"{folder}/{version}"


def remove_unfinished(spark: SparkSession, root: str, name: str) -> int:
    """Delete what lost jobs left in a table's folder (while no job writes it); how many versions."""
    kept, removed = _versions(spark, f"{root}/{name}"), 0
    fs, folder = _file_system(spark, f"{root}/{name}")
    for status in fs.listStatus(folder):
        found = status.getPath().getName()
        if found not in kept and (found.startswith("v-") or found.startswith("_next-")):
            fs.delete(status.getPath(), True)
            removed += found.startswith("v-")
    return removed


def export_csv(df: DataFrame, path: str) -> str:
    """BI export of the risk monitor (header CSV, one folder of parts;
    quotes are doubled inside quoted values)."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return path


def read_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """An export's rows, with the columns and types of the table it was made from."""
    return spark.read.schema(like.schema).option("header", "true").option("escape", '"').csv(path)
