"""Helpers the operators share: scratch tables, connected components, lambdas."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


class Scratch:
    """Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor re-reads files. The
    folder goes when the Python process ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table, or the whole folder."""
        sc = self.spark.sparkContext
        if sc._jsc is None:
            return
        try:
            path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        except Exception as e:  # the JVM may be gone when the process ends
            if name:
                raise
            del e


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, not once for each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def most_frequent(counts: DataFrame, value: str, n: str, size: int) -> list:
    """The ``size`` values of largest ``n``, ties by value, of a written table.

    They are sought among the values whose ``n`` reaches a power of two that
    enough reach, so a task sends its few of these and not its best ``size``."""
    powers = counts.groupBy(F.floor(F.log2(n)).alias("power")).agg(F.count("*").alias("values")).collect()  # 64 rows at most
    reached, least = 0, 0
    for r in sorted(powers, key=lambda r: -r.power):
        reached, least = reached + r["values"], r.power
        if reached >= size:
            break
    top = counts.where(F.col(n) >= 2 ** least).orderBy(F.desc(n), value).limit(size)
    return [r[0] for r in top.select(value).collect()]


def slices(values: list, budget: int, weight: Callable = len) -> Iterator[tuple[int, int]]:
    """Index ranges over ``values``, each of about ``budget`` total weight."""
    begin = total = 0
    for i, v in enumerate(values):
        total += weight(v)
        if total >= budget:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(values):
        yield begin, len(values)


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of undirected links (a long, b long).

    Returns (node, root), root the smallest node of the component; nodes
    without links don't appear. Alternates large-star and small-star steps:
    every step is a grouped minimum (with a map-side part, so a hub of any
    degree is cheap) and an equi-join, and the number of links never grows.
    Stops when a round changes nothing, seen from a count and a checksum."""
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state, rounds = None, 0
    while True:
        edges = scratch.save(edges, f"{name}-{rounds}")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if rounds > 1:
            scratch.drop(f"{name}-{rounds - 2}")
        if tuple(seen) == state or not seen[0]:
            break
        state = tuple(seen)
        # large star: larger neighbours move to the smallest of the neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = (both.where("v > u").join(low, "u").where("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: smaller neighbours and the node itself move to the smallest
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        edges = (wide.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        rounds += 1
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs connect, at most n - 1 of them."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out
