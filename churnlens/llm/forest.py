"""Operator 6: embedding near-duplicates by a forest of random-projection trees.

In every tree each node splits its vectors by their projection on a random
direction, where the split leaves the fewest pairs; those within a margin of
the cut, taken from the threshold, go to both sides. Nodes of at most
``LEAF`` vectors are leaves, and so are nodes that no split makes much
smaller: their vectors are all near, however many. Vectors are compared
within leaves by exact cosine (large leaves in pairs of parts, each pair a
group of its own), and links are united into components.

Labels grow trees of their own. Vectors of one direction collapse to one
first, so exact copies cost nothing. No pairs leave a leaf: a pair that shares several
leaves belongs to the first of them (each vector knows all its leaves), the
leaf sends a count of links for each vector and the links of a spanning
forest. Both are linear in the leaf, however dense it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, let

COSINE, TREES, LEAF, DEPTH = 0.93, 16, 512, 40
#: Width of the margin, in standard deviations of the projected difference of a pair at the threshold.
MARGIN = 0.75
#: A node is split if that leaves at most this part of its pairs.
WORTH = 0.9
#: Quantiles of a node's projections, of which one is the cut.
QUANTILES = [i / 50 + 0.01 for i in range(50)]
#: Vectors of a part of a large leaf (2 MB of 64 components).
PART = 4096
#: Vectors of a leaf compared at a time, against all of the leaf.
BLOCK = 512
_SEED = 6


def _directions(size: int, level: int) -> np.ndarray:
    """A random direction for each tree at a level, for vectors of ``size`` components."""
    return np.random.default_rng([_SEED, size, level]).standard_normal((size, TREES))


def usable(vector: str):
    """Neither null, empty nor zero, and all components finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _direction(vector: str):
    """Equal for vectors of one direction: all components over the largest size of one (and no negative zero)."""
    return let(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))),
               lambda top: F.transform(vector, lambda x: x.cast("double") / top + F.lit(0.0)))


def _projected(level: int):
    """A vector's projections in all its open nodes: vec, grp, tree, leaf, at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("nodes")
            counts = pc.list_value_length(nodes).to_numpy()
            flat = nodes.flatten()
            tree = flat.field("tree").to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), counts)
            vectors = batch.column("embedding").to_pandas()
            at = np.empty(len(flat))
            for size, rows in vectors.groupby(vectors.map(len)).indices.items():
                x = np.stack(vectors.to_numpy()[rows]).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                ways = np.zeros((batch.num_rows, TREES))
                ways[rows] = x @ _directions(size, level)
                mine = np.isin(owner, rows)
                at[mine] = ways[owner[mine], tree[mine]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec").take(pa.array(owner)), batch.column("grp").take(pa.array(owner)),
                 pa.array(tree, pa.int32()), flat.field("leaf"), pa.array(at)], names=["vec", "grp", "tree", "leaf", "at"])
    return run


def _cut(threshold: float):
    """Of the quantiles ``q``: (pairs left, as a part; low and high end of the margin) of the best cut."""
    half = MARGIN * max(0.0, 2 - 2 * threshold) ** 0.5 / 2

    def at(c):
        left = F.size(F.filter("q", lambda x: x <= c + half)) / len(QUANTILES)
        right = F.size(F.filter("q", lambda x: x >= c - half)) / len(QUANTILES)
        return F.struct((left * left + right * right).alias("pairs"), (c - half).alias("low"), (c + half).alias("high"))
    return F.array_min(F.transform("q", at))


def grow(vectors: DataFrame, scratch: Scratch, threshold: float = COSINE) -> DataFrame:
    """Leaves of all trees: vec, grp, tree, leaf (a path as text; '0' and '1' for
    sides). ``vectors``: vec, grp (compared only among equals), embedding.

    Level by level; a node's quantiles and size are one grouped aggregate with
    a map-side part. A group that fits a leaf, or is one leaf in some tree,
    needs that tree only. What is open after ``DEPTH`` levels is a leaf. Levels
    hold places in trees alone: a vector's open nodes are brought together and
    it is projected for all of them at once, so its components move once a
    level and not once a tree."""
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("n"))
    trees = F.sequence(F.lit(0), F.when(F.col("n") <= LEAF, 0).otherwise(TREES - 1))
    rows = (vectors.select("vec", "grp").join(sizes, "grp").withColumn("tree", F.explode(trees))
            .select("vec", "grp", "tree", F.lit("").alias("leaf")))
    done = None
    for level in range(DEPTH):
        rows = scratch.save(rows, f"level-{level}")
        nodes = rows.groupBy("grp", "tree", "leaf").agg(F.count("*").alias("n"))
        full = scratch.save(nodes.where(F.col("n") > LEAF), f"full-{level}")
        settled = rows.join(full, ["grp", "tree", "leaf"], "left_anti").select(*rows.columns)
        done = settled if done is None else done.union(settled)
        if full.isEmpty():
            break
        open_nodes = rows.join(full.drop("n"), ["grp", "tree", "leaf"]).groupBy("grp", "vec").agg(
            F.collect_list(F.struct("tree", "leaf")).alias("nodes"))
        open_rows = open_nodes.join(vectors, ["grp", "vec"]).select("vec", "grp", "nodes", "embedding").mapInArrow(
            _projected(level), "vec long, grp string, tree int, leaf string, at double")
        open_rows = scratch.save(open_rows, f"at-{level}")
        cuts = open_rows.groupBy("grp", "tree", "leaf").agg(F.percentile_approx("at", QUANTILES, 2000).alias("q"))
        cuts = scratch.save(cuts.select("grp", "tree", "leaf", _cut(threshold).alias("cut")), f"cuts-{level}")
        dense = cuts.where(F.col("cut.pairs") > WORTH).select("grp", "tree", "leaf")
        if level == 0:  # a whole group in one leaf: no other tree adds a pair
            dense = dense.groupBy("grp", "leaf").agg(F.min("tree").alias("tree")).select("grp", "tree", "leaf")
            open_rows = open_rows.join(dense.select("grp", F.col("tree").alias("only")), "grp", "left").where(
                "only is null or only = tree").drop("only")
        done = done.union(open_rows.join(dense, ["grp", "tree", "leaf"]).select(*done.columns))
        sides = F.array_compact(F.array(F.when(F.col("at") <= F.col("cut.high"), "0"),
                                        F.when(F.col("at") >= F.col("cut.low"), "1")))
        rows = (open_rows.join(cuts.where(F.col("cut.pairs") <= WORTH), ["grp", "tree", "leaf"])
                .withColumn("side", F.explode(sides))
                .select("vec", "grp", "tree", F.concat("leaf", "side").alias("leaf")))
    else:
        done = done.union(rows)
    leaves = scratch.save(done, "leaves")
    for used in range(level + 1):
        for name in ("level", "full", "at", "cuts"):
            scratch.drop(f"{name}-{used}")
    return leaves


def _leaf_id(tree, leaf):
    """A leaf as one number, by tree, then path: the path's bits (``DEPTH`` at most) behind a 1."""
    return F.shiftleft(tree.cast("long"), 48) + F.conv(F.concat(F.lit("1"), leaf), 2, 10).cast("long")


def _earlier(leaves: list[np.ndarray], mine: int) -> np.ndarray:
    """Which leaves before ``mine`` each vector is in, of those that several are in.

    ``leaves``: each vector's leaves (``_leaf_id``)."""
    flat, owner = np.concatenate(leaves), np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
    before = flat < mine
    _, column, held = np.unique(flat[before], return_inverse=True, return_counts=True)
    several = held > 1
    out = np.zeros((len(leaves), int(several.sum())), np.float32)
    used = several[column]
    out[owner[before][used], (np.cumsum(several) - 1)[column[used]]] = 1
    return out


def _unshared(held: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether a pair of ``rows`` and ``others`` shares none of the leaves ``held``."""
    return (held[rows] @ held[others].T) == 0


def _joined(near: np.ndarray, rows: np.ndarray, others: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links of ``near`` (rows against others) that connect components not yet
    connected; ``label`` names each vector's component and is kept up to date."""
    out = []
    for i, r in enumerate(rows):
        mates = others[near[i]]
        for u, first in zip(*np.unique(label[mates], return_index=True)):
            if u != label[r]:
                out.append((int(r), int(mates[first])))
                label[label == u] = label[r]
    return out


def _compare(threshold: float):
    """Compares a leaf's vectors, of a large leaf those of part ``a`` with those of part ``b``."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec", ignore_index=True)
        vec, copies, part = frame["vec"].to_numpy(), frame["copies"].to_numpy(), frame["part"].to_numpy()
        x = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        held, n = _earlier(frame["leaves"].to_list(), (int(key[1]) << 48) + int("1" + key[2], 2)), len(vec)
        left, others = np.flatnonzero(part == key[3]), np.flatnonzero(part == key[4])
        links, ends, label = np.zeros(n, np.int64), [], np.arange(n)
        for i in range(0, len(left), BLOCK):
            rows = left[i:i + BLOCK]
            near = _unshared(held, rows, others)
            if not near.any():
                continue
            near &= x[rows] @ x[others].T >= threshold
            if key[3] == key[4]:
                near[np.arange(len(rows)), np.arange(i, i + len(rows))] = False
            else:
                links[others] += copies[rows] @ near
            links[rows] += near @ copies[others]
            ends += _joined(near, rows, others, label)
        out = [(int(v), int(c), -1) for v, c in zip(vec, links) if c]
        out += [(int(vec[a]), 0, int(vec[b])) for a, b in ends]
        return pd.DataFrame(out, columns=["vec", "links", "other"]).astype("int64")
    return run


def _in_parts(members: DataFrame, scratch: Scratch) -> DataFrame:
    """``members`` with part, a and b: once for each pair of parts of their leaf that holds theirs."""
    sizes = scratch.save(members.groupBy("grp", "tree", "leaf").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int")
    rows = members.join(sizes, ["grp", "tree", "leaf"]).withColumn("part", part)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select(*members.columns, "part", F.least("part", "_other").alias("a"), F.greatest("part", "_other").alias("b"))


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding, label).

    vec_id, n_links (other vectors linked directly), component_id (smallest
    vec_id reachable, itself included), kept (vec_id = component_id). Linked:
    equal labels and a cosine of ``threshold`` or more, in double precision.
    Null labels, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing; nor do vectors of different
    lengths. Rows that share a vec_id count as one in components; a null
    vec_id has no links, a null component and is kept."""
    scratch = Scratch(spark, "forest")
    vectors = vectors.select("vec_id", "embedding", F.col("label").cast("string").alias("label"))
    fine = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = scratch.save(vectors.withColumn("grp", F.when(fine, F.concat_ws("/", F.size("embedding"), "label")))
                        .withColumn("key", F.when(fine, F.sha2(F.to_json(F.struct(_direction("embedding").alias("d"))), 256))), "rows")
    distinct = (rows.where("key is not null").groupBy("grp", "key")
                .agg(F.min("vec_id").cast("long").alias("vec"), F.count("*").alias("copies"),
                     F.first("embedding").alias("embedding")))
    distinct = scratch.save(distinct, "distinct")
    leaves = grow(distinct.select("vec", "grp", "embedding"), scratch, threshold)
    owned = leaves.groupBy("grp", "vec").agg(F.collect_list(_leaf_id(F.col("tree"), F.col("leaf"))).alias("leaves"))
    members = (leaves.join(owned, ["grp", "vec"])
               .join(distinct.select("grp", "vec", "copies", "embedding"), ["grp", "vec"]))
    found = scratch.save(_in_parts(members, scratch).groupBy("grp", "tree", "leaf", "a", "b").applyInPandas(
        _compare(threshold), "vec long, links long, other long"), "found")
    links = found.where("other >= 0 or links = 0").select(F.col("vec").alias("a"), F.col("other").alias("b"))
    roots = scratch.save(components(links, scratch, "roots"), "roots")
    counts = found.groupBy("vec").agg(F.sum("links").alias("links"))
    named = scratch.save(distinct.select("grp", "key", "vec", "copies").join(counts, "vec", "left")
                         .join(roots.withColumnRenamed("node", "vec"), "vec", "left")
                         .select("grp", "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                 F.coalesce("root", "vec").alias("root")), "named")
    out = rows.select("vec_id", "grp", "key").join(named, ["grp", "key"], "left")
    component = F.coalesce("root", F.col("vec_id").cast("long"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of ``embeddings`` within equal labels."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
with recursive fine as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
units as (select vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) s from fine),
links as (
  select a.vec_id a, b.vec_id b from units a join units b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_inner_product(a.e, b.e) / (a.s * b.s) >= 0.93),
reach(a, b) as (select vec_id, vec_id from units union select r.a, l.b from reach r join links l on l.a = r.b),
roots as (select a, min(b) root from reach group by a),
counts as (select a, count(*) n from links group by a)
select v.vec_id, cast(coalesce(c.n, 0) as bigint) n_links, coalesce(r.root, v.vec_id) component_id,
  v.vec_id = coalesce(r.root, v.vec_id) kept
from embeddings v left join counts c on c.a = v.vec_id left join roots r on r.a = v.vec_id
"""
