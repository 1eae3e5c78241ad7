"""Dashboard data sets over gold.company_risk_monitor.

All are per month_start (the monitor is written partitioned by month, so
a dashboard filtered to one month prunes to one partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import (ENGAGEMENT_EDGES, MRR_BAND_EDGES, RISK_BAND_EDGES, TENURE_EDGES,
                                 bucket)

RISK_HIST_BINS = 10
OUTREACH_TOP_K = 20


#: What money is summed as.
EXACT = "decimal(38,10)"


def _money(c: str) -> F.Column:
    """Exact sum: each value as decimal(38,10), summed without rounding
    drift, so the total does not depend on the order tasks finish in."""
    return F.sum(F.col(c).cast(EXACT)).cast("double")


def _exposure(df: DataFrame, keys: list) -> DataFrame:
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("companies"),
                 F.round(_money("mrr"), 6).alias("total_mrr"),
                 F.round(_money("revenue_at_risk"), 6).alias("revenue_at_risk")))


def executive_overview(monitor: DataFrame) -> DataFrame:
    """N1 + N3: total MRR, revenue at risk and % of MRR exposed per month."""
    g = monitor.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("companies"), _money("mrr").alias("m"),
        _money("revenue_at_risk").alias("r"))
    return g.select("month_start", "companies", F.round("m", 6).alias("total_mrr"),
                    F.round("r", 6).alias("revenue_at_risk"),
                    F.round(F.col("r") * 100.0 / F.nullif(F.col("m"), F.lit(0.0)), 6)
                    .alias("pct_mrr_exposed"))


def risk_distribution(monitor: DataFrame, bins: int = RISK_HIST_BINS) -> DataFrame:
    """Companies and MRR per probability bin of width 1/bins."""
    b = F.least(F.floor(F.col("churn_probability") * bins), F.lit(bins - 1)).cast("int")
    return _exposure(monitor.withColumn("risk_bin", b), ["month_start", "risk_bin"])


def risk_vs_engagement(monitor: DataFrame) -> DataFrame:
    """Scatter points (every row, no sampling)."""
    return monitor.select("company_id", "month_start", "logins_30d", "churn_probability", "mrr")


def tercile_edges(df: DataFrame, col: str = "logins_30d",
                  labels=("low", "medium", "high")) -> tuple:
    """Q23 alternative to fixed edges: tiers cut at the exact 1/3 and 2/3
    quantiles of ``col`` (numpy linear), from the distributed summary."""
    from .evaluate import exact_quantiles
    q1, q2 = exact_quantiles(df, col, [1 / 3, 2 / 3])
    return ((float("-inf"), labels[0]), (q1, labels[1]), (q2, labels[2]))


def by_usage_tier(monitor: DataFrame, edges=ENGAGEMENT_EDGES) -> DataFrame:
    """Exposure by engagement tier of 30-day logins (fixed edges by
    default; ``tercile_edges(monitor)`` for data-driven tiers)."""
    return _exposure(monitor.withColumn("usage_tier", bucket("logins_30d", edges)),
                     ["month_start", "usage_tier"])


def by_tenure(monitor: DataFrame, edges=TENURE_EDGES) -> DataFrame:
    """Exposure by tenure bucket (months since signup)."""
    return _exposure(monitor.withColumn("tenure_bucket", bucket("months_since_signup", edges)),
                     ["month_start", "tenure_bucket"])


def by_plan(monitor: DataFrame) -> DataFrame:
    """Plan-level exposure."""
    return _exposure(monitor, ["month_start", "plan_type"])


SEGMENTS = ("industry", "company_size_bucket", "acquisition_channel", "country")


def by_segment(monitor: DataFrame, companies: DataFrame) -> DataFrame:
    """Exposure by customer segment, long format (segment, value).
    Company attributes are attached once, from a hash table in each partition.
    Rows are summed by month and all attributes first, and only those sums
    are expanded to one row per segment dimension (stack) and summed again:
    exact decimals, so the totals are the same in either order."""
    attributes = companies.select("company_id", *SEGMENTS).hint("shuffle_hash")
    parts = monitor.join(attributes, "company_id", "left").groupBy("month_start", *SEGMENTS).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast(EXACT)).cast(EXACT).alias(c) for c in ("mrr", "revenue_at_risk")])
    stack = "stack({n}, {pairs}) as (segment, segment_value)".format(
        n=len(SEGMENTS), pairs=", ".join(f"'{s}', cast({s} as string)" for s in SEGMENTS))
    x = parts.select("month_start", "n", "mrr", "revenue_at_risk", F.expr(stack))
    return x.groupBy("month_start", "segment", "segment_value").agg(
        F.sum("n").alias("companies"), F.round(_money("mrr"), 6).alias("total_mrr"),
        F.round(_money("revenue_at_risk"), 6).alias("revenue_at_risk"))


def outreach_ranking(monitor: DataFrame, k: int = OUTREACH_TOP_K) -> DataFrame:
    """Per month, the k companies with the most revenue at risk (top-k
    is the feature; ties by company id). rank <= k plans as a
    WindowGroupLimit that keeps only k rows per month per task."""
    w = Window.partitionBy("month_start").orderBy(F.col("revenue_at_risk").desc(),
                                                  F.col("company_id").asc())
    return (monitor.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("month_start", "rank", "company_id", "plan_type", "mrr", "churn_probability",
                    "revenue_at_risk"))


def portfolio_grid(monitor: DataFrame, mrr_edges=MRR_BAND_EDGES,
                   risk_edges=RISK_BAND_EDGES) -> DataFrame:
    """MRR band x risk band."""
    x = (monitor.withColumn("mrr_band", bucket(F.col("mrr").cast("double"), mrr_edges))
         .withColumn("risk_band", bucket("churn_probability", risk_edges)))
    return _exposure(x, ["month_start", "mrr_band", "risk_band"])
