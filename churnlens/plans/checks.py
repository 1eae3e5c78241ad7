"""Named sanity checks over the built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q
from ..sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from .silver import typed_key_check

GOLD_KEYS = {
    "company_daily_activity": ["company_id", "activity_date"],
    "company_monthly_metrics": ["company_id", "month_start"],
    "company_mrr": ["company_id", "month_start"],
    "company_churn_label": ["company_id"],
    "funnel_company": ["company_id"],
    "company_ltv": ["company_id"],
    "company_features_for_model": ["company_id", "as_of_date"],
}


def primary_keys(silver: dict[str, DataFrame], gold: dict[str, DataFrame],
                 flagged: dict[str, DataFrame]) -> DataFrame:
    """C1 over the typed rows before cleaning drops any (counted while the
    flagged tables were written), and over the 7 silver and 7 keyed gold tables."""
    frames = [typed_key_check(flagged[t], t) for t in PRIMARY_KEYS]
    frames += [q.primary_key_check(silver[t], f"silver.{t}", pk) for t, pk in PRIMARY_KEYS.items()]
    frames += [q.primary_key_check(gold[t], f"gold.{t}", pk) for t, pk in GOLD_KEYS.items()
               if t in gold]
    return q.union_all(frames)


def foreign_keys(tables: dict[str, DataFrame], layer: str = "") -> DataFrame:
    """Orphan counts for the six relationships, of silver tables
    or (named by ``layer``) of typed rows before cleaning drops any."""
    return q.union_all([
        q.orphan_count(tables[c], fk, tables[p], pk, f"orphan_{layer}{c}.{fk}")
        for c, fk, p, pk in FOREIGN_KEYS])


def sanity_checks(companies: DataFrame, label: DataFrame, mrr: DataFrame, daily: DataFrame,
                  monthly: DataFrame, features: DataFrame) -> DataFrame:
    """L7-L15, L18 as (check_name, bad_rows); every count should be 0."""
    churned = F.col("churn_flag") == F.lit(True)
    leak = (features.where(F.col("churn_in_next_30d") == 1)
            .join(label.select("company_id", "churn_date"), "company_id")
            .where(F.col("churn_date") <= F.col("as_of_date")))
    return q.union_all([
        q.count_each(companies, {
            "null_company_id": F.col("company_id").isNull(),
            "null_company_name": F.col("company_name").isNull()}),
        q.count_each(label, {
            "null_churn_flag": F.col("churn_flag").isNull(),
            "churned_without_date": churned & F.col("churn_date").isNull(),
            "not_churned_with_date": (F.col("churn_flag") == F.lit(False)) & F.col("churn_date").isNotNull(),
            "churned_without_reason": churned & (F.col("churn_reason").isNull() | (F.col("churn_reason") == ""))}),
        q.count_each(mrr, {
            "negative_mrr": F.col("mrr") < 0,
            "negative_active_user_count": F.col("active_user_count") < 0,
            "negative_price_per_user": F.col("price_per_user") < 0}),
        q.count_each(daily, {
            "negative_daily_activity": (F.col("active_users") < 0) | (F.col("total_events") < 0)}),
        q.count_each(monthly, {
            "monthly_null_month": F.col("month_start").isNull(),
            "monthly_events_without_users": (F.col("active_users_monthly") == 0) & (F.col("total_events") > 0)}),
        leak.agg(F.lit("label_leakage").alias("check_name"), F.count(F.lit(1)).alias("bad_rows")),
    ])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """L14/L15 row counts per table."""
    return q.union_all([t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows"))
                        for n, t in tables.items()])


def latest_daily_activity(daily: DataFrame, k: int = 10) -> DataFrame:
    """L14 spot check: the k latest company-days (top-k; ties broken by id)."""
    return daily.orderBy(F.col("activity_date").desc(), F.col("company_id").asc()).limit(k)


def mrr_summary(mrr: DataFrame) -> DataFrame:
    """First and last month and total MRR."""
    return mrr.agg(F.min("month_start").alias("min_month"), F.max("month_start").alias("max_month"),
                   F.sum("mrr").alias("total_mrr"))


def churn_reason_distribution(label: DataFrame) -> DataFrame:
    """L17."""
    return label.groupBy("churn_reason").agg(F.count(F.lit(1)).alias("companies"))


def tenure_range(features: DataFrame) -> DataFrame:
    """L19a."""
    return features.agg(F.min("months_since_signup").alias("min_m"),
                        F.max("months_since_signup").alias("max_m"))


def tenure_histogram(features: DataFrame) -> DataFrame:
    """Snapshot count per tenure month (full histogram)."""
    return features.groupBy("months_since_signup").agg(F.count(F.lit(1)).alias("snapshots"))


def sample_violations(df: DataFrame, cond, order: list[str], n: int = 50) -> DataFrame:
    """H2: up to ``n`` offending rows for inspection (the LIMIT is the
    feature: a sample for a person to read), in a stable key order;
    planned as a per-task top-n then a merge (TakeOrderedAndProject)."""
    return df.where(cond).orderBy(*order).limit(n)
