"""Ranking metrics for a scored table (M9-M15), exact and distributed.

Everything is derived from one summary with a row per *distinct* score:
positives, negatives and running counts. Running sums never use an
unpartitioned window over data: distinct scores are range-partitioned
(as many ranges as shuffle partitions, equal in rows), running sums are
computed inside each range, and the offsets come from a table with one
row per range. Thresholds and hits are conditional sums over the summary
in one pass, not joins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Fixed values of the evaluation protocol.
TOP_K_FRACTIONS = (0.02, 0.05, 0.10, 0.20)
PRECISION_CURVE_POINTS = tuple(float(x) for x in np.linspace(0.01, 0.50, 20))
HIST_BINS = 50
EPS = 1e-9


def _nz(c: F.Column) -> F.Column:
    """Denominator guard: ANSI mode raises on x / 0; an undefined metric
    (e.g. no positives in the split) is NULL instead."""
    return F.nullif(c, F.lit(0))


def score_summary(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score s: pos, neg, n and the inclusive running counts
    pos_le, neg_le, n_le (rows with score <= s), plus totals total_pos,
    total_neg. NULL and NaN scores are left out."""
    spark = scored.sparkSession
    ensure_checkpoint_dir(spark)
    s = F.col("s")
    g = (scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"))
         .where(s.isNotNull() & ~F.isnan(s))
         .groupBy("s").agg(F.sum("y").cast("bigint").alias("pos"),
                           F.count(F.lit(1)).alias("n")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written once: the range number must stay what it was when the rows were dealt.
    g = (g.withColumn("neg", F.col("n") - F.col("pos")).repartitionByRange(ranges, "s")
         .withColumn("b", F.spark_partition_id()).checkpoint(eager=True))
    tot = g.groupBy("b").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"),
                             F.sum("n").alias("bt"))
    # one row per range: a global window here is over that small table
    w_all = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("b",
                      F.coalesce(F.sum("bp").over(w_all), F.lit(0)).alias("op"),
                      F.coalesce(F.sum("bn").over(w_all), F.lit(0)).alias("on"),
                      F.coalesce(F.sum("bt").over(w_all), F.lit(0)).alias("ot"))
    totals = tot.agg(F.sum("bp").alias("tp_all"), F.sum("bn").alias("tn_all"))
    w_in = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    out = (g.withColumn("ip", F.sum("pos").over(w_in))
           .withColumn("in_", F.sum("neg").over(w_in))
           .withColumn("it", F.sum("n").over(w_in))
           .join(F.broadcast(offs), "b")
           .crossJoin(F.broadcast(totals)))
    return out.select(
        "s", "pos", "neg", "n",
        (F.col("op") + F.col("ip")).cast("bigint").alias("pos_le"),
        (F.col("on") + F.col("in_")).cast("bigint").alias("neg_le"),
        (F.col("ot") + F.col("it")).cast("bigint").alias("n_le"),
        F.col("tp_all").cast("bigint").alias("total_pos"),
        F.col("tn_all").cast("bigint").alias("total_neg"))


def _ge(summary: DataFrame) -> DataFrame:
    return (summary.withColumn("pos_ge", F.col("total_pos") - F.col("pos_le") + F.col("pos"))
            .withColumn("neg_ge", F.col("total_neg") - F.col("neg_le") + F.col("neg"))
            .withColumn("neg_lt", F.col("neg_le") - F.col("neg")))


def auc_ap(summary: DataFrame) -> DataFrame:
    """M9 ROC-AUC (exact, ties count one half) and M10 average precision
    (step sum over distinct thresholds, not the trapezoid)."""
    s = _ge(summary)
    num = (F.col("pos").cast("decimal(38,0)")
           * (F.col("neg_lt") * 2 + F.col("neg")).cast("decimal(38,0)"))
    prec = F.col("pos_ge").cast("double") / (F.col("pos_ge") + F.col("neg_ge")).cast("double")
    agg = s.agg(F.sum(num).alias("num"),
                F.sum(F.col("pos").cast("double") * prec).alias("ap_num"),
                F.max("total_pos").alias("total_pos"), F.max("total_neg").alias("total_neg"))
    pairs = F.col("total_pos").cast("double") * F.col("total_neg").cast("double") * 2.0
    return agg.select(
        F.round(F.col("num").cast("double") / _nz(pairs), 6).alias("roc_auc"),
        F.round(F.col("ap_num") / _nz(F.col("total_pos").cast("double")), 6)
        .alias("average_precision"),
        F.col("total_pos").alias("positives"), F.col("total_neg").alias("negatives"))


def roc_curve(summary: DataFrame) -> DataFrame:
    """One point per distinct threshold (all points kept)."""
    s = _ge(summary)
    return s.select(F.col("s").alias("threshold"),
                    F.round(F.col("neg_ge") / _nz(F.col("total_neg")), 6).alias("fpr"),
                    F.round(F.col("pos_ge") / _nz(F.col("total_pos")), 6).alias("tpr"))


def _thresholds(summary: DataFrame, quantiles: Sequence[float]) -> list[float] | None:
    """np.quantile(scores, q) with linear interpolation, reproduced term by
    term (virtual index n*q + (1 - q) - 1, lerp from the nearer side) so each
    equals numpy's bit for bit; None without scores. One aggregate finds the
    scores at all wanted ranks: rank r (from 0) is at n_le - n <= r < n_le."""
    n = summary.agg(F.max("n_le")).first()[0]
    if not n:
        return None
    at = [n * q + (1.0 - q) - 1.0 for q in quantiles]
    ranks = sorted({r for h in at for r in (int(np.floor(h)), min(int(np.floor(h)) + 1, n - 1))})
    lo, hi = F.col("n_le") - F.col("n"), F.col("n_le")
    row = summary.agg(*[F.max(F.when((lo <= r) & (hi > r), F.col("s"))) for r in ranks]).first()
    value = dict(zip(ranks, row))
    out = []
    for h in at:
        a, b, t = value[int(np.floor(h))], value[min(int(np.floor(h)) + 1, n - 1)], h - np.floor(h)
        out.append(float(b - (b - a) * (1.0 - t) if t >= 0.5 else a + (b - a) * t))
    return out


def exact_quantiles(df: DataFrame, col: str, quantiles: Sequence[float]) -> list[float] | None:
    """numpy-exact linear quantiles of one column (NULLs and NaNs ignored),
    from the distinct-value summary, written once."""
    vals = df.select(F.col(col).cast("double").alias("s"), F.lit(0).alias("y"))
    return _thresholds(score_summary(vals, "s", "y").checkpoint(eager=True), quantiles)


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """One of ``exact_quantiles``."""
    found = exact_quantiles(df, col, [q])
    return None if found is None else found[0]


def top_k_report(summary: DataFrame, fractions: Sequence[float] = TOP_K_FRACTIONS) -> DataFrame:
    """M12 + M13: flag scores >= the (1-k) quantile; precision, recall,
    flagged count and lift over the base rate (1e-9 guards as in source)."""
    spark = summary.sparkSession
    cuts = _thresholds(summary, [1.0 - k for k in fractions])
    pairs = list(zip(map(float, fractions), cuts)) if cuts else []
    hits = [F.struct(F.lit(k).alias("k"), F.lit(t).alias("threshold"),
                     F.sum(F.when(F.col("s") >= t, F.col("pos")).otherwise(0)).alias("tp"),
                     F.sum(F.when(F.col("s") >= t, F.col("neg")).otherwise(0)).alias("fp")) for k, t in pairs]
    if not hits:
        return spark.createDataFrame([], "top_fraction double, threshold double, flagged bigint, tp bigint, fp bigint, "
                                         "fn bigint, precision double, recall double, baseline_rate double, lift double")
    one = summary.agg(F.array(*hits).alias("hits"), F.max("total_pos").alias("P0"), F.max("total_neg").alias("N0"))
    r = one.select("P0", "N0", F.inline("hits"))
    tp, fp = F.col("tp").cast("bigint"), F.col("fp").cast("bigint")
    base = F.col("P0").cast("double") / _nz((F.col("P0") + F.col("N0")).cast("double"))
    prec = tp / (tp + fp + F.lit(EPS))
    return r.select(
        F.col("k").alias("top_fraction"), F.col("threshold"),
        (tp + fp).alias("flagged"), tp.alias("tp"), fp.alias("fp"),
        (F.col("P0") - tp).alias("fn"),
        F.round(prec, 6).alias("precision"),
        F.round(tp / (F.col("P0") + F.lit(EPS)), 6).alias("recall"),
        F.round(base, 6).alias("baseline_rate"),
        F.round(prec / _nz(base), 6).alias("lift"))


def precision_curve(summary: DataFrame) -> DataFrame:
    """Precision against contact size for 20 points 1 %..50 %."""
    return top_k_report(summary, PRECISION_CURVE_POINTS).select(
        "top_fraction", "threshold", "flagged", "precision")


def score_histogram(scored: DataFrame, score: str = "score", label: str = "label",
                    bins: int = HIST_BINS) -> DataFrame:
    """Per class, ``bins`` equal-width bins over the class's own
    [min, max] (the max falls in the last bin; a zero-width range is
    widened by 0.5 each side); empty bins are returned with count 0."""
    x = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"))
    rng = (x.groupBy("y").agg(F.min("s").alias("mn0"), F.max("s").alias("mx0"))
           .withColumn("mn", F.when(F.col("mn0") == F.col("mx0"), F.col("mn0") - 0.5)
                       .otherwise(F.col("mn0")))
           .withColumn("mx", F.when(F.col("mn0") == F.col("mx0"), F.col("mx0") + 0.5)
                       .otherwise(F.col("mx0"))))
    b = F.least(F.floor((F.col("s") - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins),
                F.lit(bins - 1)).cast("int")
    counts = (x.join(F.broadcast(rng.select("y", "mn", "mx")), "y")
              .groupBy("y", b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = rng.crossJoin(x.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")))
    width = (F.col("mx") - F.col("mn")) / bins
    return (grid.join(counts, ["y", "bin"], "left")
            .select(F.col("y").alias("label"), "bin",
                    F.round(F.col("mn") + width * F.col("bin"), 6).alias("bin_lo"),
                    F.round(F.col("mn") + width * (F.col("bin") + 1), 6).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
