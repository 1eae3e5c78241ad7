"""Data-quality operators (C1, C2 and the sanity checks L1-L19).

Every check is a distributed aggregate returning a small frame of
counts (never collecting offending rows to the driver); row-returning
variants are provided where the source shows samples.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_key_check(df: DataFrame, table: str, pk: Sequence[str]) -> DataFrame:
    """Rows, keys occurring more than once, rows with a NULL key part."""
    null_any = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).withColumn("has_null", null_any)
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("has_null"), F.col("n"))), F.lit(0)).cast("bigint")
        .alias("null_key_rows"))


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """Child rows whose key finds no parent (LEFT JOIN ... IS NULL).
    As in the source, a NULL child key counts as an orphan here."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    bad = child.select(fk).join(keys, F.col(fk) == F.col("_pk"), "left_anti")
    return bad.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("bad_rows"))


def count_where(df: DataFrame, cond: Column, name: str) -> DataFrame:
    """Rows matching a violation predicate, as (check_name, bad_rows)."""
    return df.agg(F.lit(name).alias("check_name"), F.count_if(cond).alias("bad_rows"))


def count_each(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``count_where`` for several predicates of one table in one pass."""
    counts = df.agg(F.array(*[F.struct(F.lit(n).alias("check_name"), F.count_if(c).alias("bad_rows"))
                              for n, c in checks.items()]).alias("c"))
    return counts.select(F.inline("c"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F8: per-column NULL counters plus the total."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
                  F.count(F.lit(1)).alias("total"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
