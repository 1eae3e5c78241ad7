"""Parameterised bucketing (edges are parameters; defaults are ours)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default edges (inclusive lower bounds) -> label. Our choice; the source
# names the buckets but gives no boundaries.
COMPANY_SIZE_EDGES = ((1, "1-10"), (11, "11-50"), (51, "51-200"), (201, "201-1000"), (1001, "1000+"))
TENURE_EDGES = ((0, "0-5"), (6, "6-11"), (12, "12-17"), (18, "18-30"), (31, "31+"))
ENGAGEMENT_EDGES = ((0, "low"), (10, "medium"), (30, "high"))
MRR_BAND_EDGES = ((0, "mrr_0-99"), (100, "mrr_100-499"), (500, "mrr_500+"))
RISK_BAND_EDGES = ((0.0, "risk_low"), (0.3, "risk_medium"), (0.6, "risk_high"))


def bucket(c, edges: Sequence[tuple], below: str | None = None) -> Column:
    """Label of the last edge whose lower bound is <= value; ``below`` for
    values under the first edge; NULL stays NULL."""
    x = F.col(c) if isinstance(c, str) else c
    expr = F.lit(below)
    for lo, label in edges:
        expr = F.when(x >= F.lit(lo), F.lit(label)).otherwise(expr)
    return F.when(x.isNotNull(), expr)


def bucket_sql(c: str, edges: Sequence[tuple], below: str | None = None) -> str:
    """The same rule as an ANSI CASE expression (used by the SQL oracle)."""
    parts = [f"WHEN {c} >= {lo!r} THEN '{label}'" for lo, label in reversed(edges)]
    tail = f"'{below}'" if below is not None else "NULL"
    return f"CASE WHEN {c} IS NULL THEN NULL {' '.join(parts)} ELSE {tail} END"
