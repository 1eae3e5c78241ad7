"""Operator 2: near-duplicate groups by b-bit MinHash.

Per document a set of word shingles is hashed to 64 bits; ``HASHES`` minima
are taken, bands of ``ROWS`` minima give candidate keys, and the low
``BITS`` bits of all minima are packed into longs. Candidates pass a size
bound and the collision-corrected estimate from the packed bits, and are
then confirmed on the full sets.

Documents with equal sets collapse to one class first, so exact copies
never form pairs. Candidates within a band bucket are not all its pairs:
every member meets the bucket's hub (the document with most bucket mates).
Then only members that are still in different components are compared, block
against block within a task, and only links leave it (as many as connect the
block), so a dense group of any size sends no pairs. Any two documents that
share a bucket and reach the threshold end in one component.
At a similarity of 0.8 the bands miss a pair with probability 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, slices, spanning

BANDS, ROWS, HASHES, BITS = 42, 6, 256, 2
#: Below the threshold by this much the estimate rejects (over five standard deviations).
SLACK = 0.16
#: Members of an open bucket that are compared at a time, against as many others (what
#: bounds it are matrices of all pairs of twice as many), and shingles of these members.
BLOCK, BLOCK_SHINGLES = 700, 2_000_000
#: Rows of open buckets that a group of them has on average, and their shingles (8 bytes each).
TOGETHER, TOGETHER_SHINGLES = 2000, 4_000_000
#: Up to this many document ids (8 bytes each) are broadcast to pick texts; beyond it they are joined.
BROADCAST_IDS = 1_000_000
SLICE_BYTES = 1_000_000

_ODD = np.random.default_rng(20).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.default_rng(21).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2)


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles.

    A-Z is lower-cased, words are runs without ASCII white space; a text of
    1 to k-1 words has one shingle, a null or blank text none."""
    words = [t.lower().split() if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.empty(0, np.uint64)] * len(texts)
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=True)
    rolled = hashes.copy()
    for j in range(1, min(k, len(flat))):
        rolled[: len(flat) - j] = _mix(rolled[: len(flat) - j]) + hashes[j:] * np.uint64(2 * j + 1)
    rolled = _mix(rolled)
    out, at = [], 0
    for ws in words:
        n = len(ws)
        if n >= k:
            out.append(np.unique(rolled[at:at + n - k + 1]))
        elif n:
            h = np.uint64(n)
            with np.errstate(over="ignore"):
                for x in hashes[at:at + n]:
                    h = _mix(np.array([h]))[0] * np.uint64(31) + x
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        part = (shingles[i:i + 512, None] ^ _XOR[None, :]) * _ODD[None, :]
        np.minimum(low, part.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band and row: (documents, BANDS)."""
    key = np.broadcast_to(_mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(low), BANDS)).copy()
    part = low[:, :BANDS * ROWS].reshape(len(low), BANDS, ROWS)
    for r in range(ROWS):
        key = _mix(key * np.uint64(31) + part[:, :, r])
    return key


def pack(low: np.ndarray) -> np.ndarray:
    """BITS bits of each minimum, packed into longs (bits 40 on: a product's lowest are mixed least)."""
    per = 64 // BITS
    bits = ((low >> np.uint64(40)) & np.uint64(2**BITS - 1)).reshape(len(low), HASHES // per, per)
    return np.bitwise_or.reduce(bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(matrix.reshape(-1).view(np.int64)))


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """A batch's texts, a slice at a time (never all as Python values)."""
    column = batch.column("text").cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for i, j in slices(sizes, SLICE_BYTES, lambda n: n + 50):
        yield i, j, column.slice(i, j - i).to_pylist()


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _text_slices(batch):
                sets = shingle_sets(texts, k)
                low = np.array([minima(s) for s in sets])
                keys = [(int(_mix(s).sum()), int(_mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum())) for s in sets]
                digest = np.array(keys, np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                     _lists(band_keys(low)), _lists(pack(low))],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"])
    return run


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, band keys, packed bits."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _signatures(k), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>")


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _text_slices(batch):
                sets = shingle_sets(texts, k)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "shingles"])
    return run


def estimate(a: str, b: str):
    """Similarity from two packed signatures: equal fields less those equal by chance."""
    low_bits = F.lit(0x5555555555555555)
    differing = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(
            x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(low_bits))),
        F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    return ((1 - differing / F.lit(float(HASHES))) - chance) / (1 - chance)


def _close(percent: int):
    """Size bound and estimate, of rows with n, sketch, n2, sketch2."""
    return ((F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
            & (estimate("sketch", "sketch2") >= percent / 100 - SLACK))


def _set_table(ids: DataFrame, docs: DataFrame, k: int, scratch: Scratch, name: str) -> DataFrame:
    """The full sets (node, shingles) of the documents in ``ids`` (doc_id)."""
    need = scratch.save(ids, f"{name}-need")
    few = need.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(need) if few else need, "doc_id", "left_semi")
    sets = texts.mapInArrow(_sets(k), "node long, shingles array<long>")
    return scratch.save(sets, f"{name}-sets")


def _confirm(pairs: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    pairs = scratch.save(pairs, "pairs")
    ids = pairs.select("a").union(pairs.select("b")).toDF("doc_id").distinct()
    sets = _set_table(ids, docs, k, scratch, "star")
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s2"))
    first = sets.select(F.col("node").alias("a"), "shingles")
    shared = F.size(F.array_intersect("shingles", "s2"))
    links = (pairs.join(second, "b").join(first, "a")
             .withColumn("shared", shared)
             .where((F.col("shared") * 100) >= percent * (F.size("shingles") + F.size("s2") - F.col("shared")))
             .select("a", "b"))  # no grouping by hub here, so a hub's pairs may be split over tasks
    links = scratch.save(links, "links")
    scratch.drop("star-sets")
    return links


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairs' intersections: over shingles that several sets
    have, products of the incidence matrix, some columns at a time."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.r_[0, flat[1:] != flat[:-1]])
    several = np.bincount(column)[column] > 1
    column, owner = np.unique(column[several], return_inverse=True)[1], owner[several]
    exact = np.float32 if max(map(len, sets)) < 1 << 24 else np.float64
    total, width = np.zeros((len(sets), len(sets)), exact), 2048
    part = np.empty((len(sets), width), np.float32)
    for begin in range(0, int(column.max(initial=-1)) + 1, width):
        inside = slice(*np.searchsorted(column, [begin, begin + width]))
        part[:] = 0
        part[owner[inside], column[inside] - begin] = 1
        total += part @ part.T
    return total


def _links_across(percent: int, band: int, crossing: bool, columns: dict, rows: np.ndarray) -> list[tuple[int, int]]:
    """Links between the components of one bucket's members (``rows`` of the
    columns), within a block or ``crossing`` two: as many as connect them.

    A pair is tested in the first band that it shares, so in one bucket only;
    size bound and estimate come before the full sets."""
    root, block, size = columns["root"][rows], columns["block"][rows], columns["n"][rows]
    test = np.triu(root[:, None] != root[None, :], 1)
    if crossing:
        test &= block[:, None] != block[None, :]
    test &= 100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size)
    bands, packed = columns["bands"][rows], columns["sketch"][rows]
    least = (percent / 100 - SLACK) * (1 - 2.0**-BITS) + 2.0**-BITS
    for i in np.flatnonzero(test.any(axis=1)):
        test[i] &= ~(bands[:, :band] == bands[i, :band]).any(axis=1)
        x = packed[i] ^ packed
        differing = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
        test[i] &= 1 - differing / HASHES >= least
    used = np.flatnonzero(test.any(axis=0) | test.any(axis=1))
    if not len(used):
        return []
    whole = np.int32 if size.max() < 5_000_000 else np.int64  # of all pairs, so as small as they may be
    shared, own = shared_counts([columns["shingles"][rows[i]] for i in used]).astype(whole), size[used].astype(whole)
    # 100 * shared >= percent * (sizes - shared)
    a, b = np.nonzero(test[np.ix_(used, used)] & ((100 + percent) * shared >= percent * np.add.outer(own, own)))
    return [(rows[x], rows[y]) for x, y in spanning(used[a], used[b], len(rows))]


def _across(percent: int):
    """``_links_across`` for all buckets (key and pair of blocks) of a group."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["key", "i", "j", "node"])
        columns = {c: frame[c].to_numpy() for c in ("key", "i", "j", "node", "root", "block", "band", "n", "shingles")}
        columns["bands"] = np.stack(frame["bands"].to_numpy())
        columns["sketch"] = np.stack(frame["sketch"].to_numpy()).view(np.uint64)
        order = np.lexsort([columns[c] for c in ("node", "j", "i", "key")])
        same = np.ones(len(order), bool)
        for c in ("key", "i", "j"):
            same[1:] &= columns[c][order[1:]] == columns[c][order[:-1]]
        same[0] = False
        links: list[tuple[int, int]] = []
        for rows in np.split(order, np.flatnonzero(~same)[1:]):
            if len(rows) > 1:
                first = rows[0]
                links += _links_across(percent, int(columns["band"][first]),
                                       columns["i"][first] != columns["j"][first], columns, rows)
        node = columns["node"]
        return pd.DataFrame([(node[x], node[y]) for x, y in links], columns=["a", "b"]).astype("int64")
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over
    links, itself included), kept (doc_id = component_id). Linked: 100 times
    the shared shingles reach ``percent`` times the union. Null, empty and
    blank texts have no shingles and link with nothing. Rows that share a
    doc_id count as one document; rows with a null doc_id link with nothing,
    have a null component and are kept. An empty table gives no rows."""
    scratch = Scratch(spark, "minhash")
    sig = scratch.save(signatures(docs, k), "signatures")
    classes = (sig.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "d1", "d2")
               .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
               .withColumnRenamed("n_shingles", "n"))
    classes = scratch.save(classes, "classes")
    info = classes.select("node", "n", "sketch")
    info2 = info.toDF("node2", "n2", "sketch2")

    rows = classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.save(rows.join(sizes, "key"), "members")
    popularity = members.groupBy("node").agg(F.sum("size").alias("mates"))
    hubs = (members.join(popularity, "node").groupBy("key")
            .agg(F.max(F.struct("mates", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub")))
    star = (members.join(hubs, "key").where("node <> hub")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    star = scratch.save(star, "star")
    near = (star.join(info.withColumnRenamed("node", "a"), "a").join(info2.withColumnRenamed("node2", "b"), "b")
            .where(_close(percent)).select("a", "b"))
    links = _confirm(near, docs, k, percent, scratch)

    # buckets whose members are in several components: all pairs across these, in blocks
    roots = scratch.save(components(links, scratch, "roots"), "roots")
    labelled = members.join(roots, "node", "left").select("key", "band", "node", "n", F.coalesce("root", "node").alias("root"))
    open_keys = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"),
                                            F.sum("n").alias("all")).where("lo < hi")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.least(F.ceil(F.col("all") / BLOCK_SHINGLES), F.col("size"))).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    left = (labelled.join(open_keys.select("key", blocks.alias("blocks")), "key").withColumn("block", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "band", "block", "node", "root", F.col("n").alias("weight")))
    left = scratch.save(left, "open")
    sets = _set_table(left.select(F.col("node").alias("doc_id")).distinct(), docs, k, scratch, "open")
    size = left.agg(F.count("*").alias("rows"), F.coalesce(F.sum("weight"), F.lit(0)).alias("all")).first()
    groups = 1 + max(size.rows // TOGETHER, size["all"] // TOGETHER_SHINGLES)
    found = (left.drop("weight").join(classes, "node").join(sets, "node")
             .groupBy(F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)).alias("group"))
             .applyInPandas(_across(percent), "a long, b long"))
    links = links.union(scratch.save(found.distinct(), "found"))
    roots = components(links, scratch, "final")
    named = scratch.save(classes.select("n", "d1", "d2", "node").join(roots, "node", "left")
                         .select("n", "d1", "d2", F.coalesce("root", "node").alias("root")), "named")
    found = (sig.select("doc_id", "n_shingles", "d1", "d2")
             .join(named.withColumnRenamed("n", "n_shingles"), ["n_shingles", "d1", "d2"], "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents`` on two-word shingles at 0.8."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), k=2, percent=80)


ORACLE = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) >= 2
    then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    when len(w) = 1 then [w[1]] else [] end) s
  from words),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
classes as (select doc_id, n, min(doc_id) over (partition by sig) rep from (
  select doc_id, count(*) n, md5(string_agg(s, chr(31) order by s)) sig from shingles group by doc_id)),
reps as (select doc_id, n from classes where doc_id = rep),
shared as (
  select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b using (s)
  where a.doc_id < b.doc_id and a.doc_id in (select doc_id from reps) and b.doc_id in (select doc_id from reps)
  group by 1, 2),
links as (
  select a, b from shared join reps x on x.doc_id = a join reps y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (select doc_id, doc_id from reps
  union select r.a, e.b from reach r join both_ways e on e.a = r.b),
roots as (select a, min(b) root from reach group by a)
select d.doc_id, cast(coalesce(c.n, 0) as bigint) n_shingles, coalesce(r.root, d.doc_id) component_id,
  d.doc_id = coalesce(r.root, d.doc_id) kept
from documents d left join classes c on c.doc_id = d.doc_id left join roots r on r.a = c.rep
"""
