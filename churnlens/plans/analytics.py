"""Analytics-layer tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_start, whole_month_diff
from ..operators.temporal import existence_flag

ACTIVATION_DAYS = 7
PAID_DAYS = 30


def _mean(total, n) -> F.Column:
    """Money divided by a count, as an exact decimal with at least ten places."""
    return total.cast("decimal(28,2)") / n.cast("decimal(10,0)")


def _ratio(num, den, digits: int) -> F.Column:
    """Exact integer/decimal sum divided as DOUBLE, then rounded (HALF_UP)."""
    return F.round(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"), digits)


def funnel_company(companies: DataFrame, daily_activity: DataFrame,
                   subscriptions: DataFrame) -> DataFrame:
    """K9: activated = any event within [signup, signup + 7 days];
    paid = a subscription starting within [signup, signup + 30 days].

    Both EXISTS tests run on pre-reduced inputs: the daily activity table
    (one row per company-day) and subscription start dates, joined to the
    company signup on company_id; the result is reduced to distinct
    company ids before it meets the company table again."""
    sig = companies.select("company_id", F.col("signup_date").cast("date").alias("signup_date"),
                           "acquisition_channel")
    keys = sig.select("company_id", "signup_date")
    active = (daily_activity.select("company_id", "activity_date").join(keys, "company_id")
              .where(F.col("activity_date").between(
                  F.col("signup_date"), F.date_add("signup_date", ACTIVATION_DAYS))))
    paid = (subscriptions.select("company_id", "start_date").join(keys, "company_id")
            .where(F.col("start_date").between(
                F.col("signup_date"), F.date_add("signup_date", PAID_DAYS))))
    out = existence_flag(existence_flag(sig, active, ["company_id"], "activated_7d"),
                         paid, ["company_id"], "paid_30d")
    return out.select("company_id", "signup_date", "acquisition_channel", "activated_7d",
                      "paid_30d", F.col("activated_7d").cast("int").alias("activation_stage"),
                      F.col("paid_30d").cast("int").alias("paid_stage"))


def funnel_by_channel(funnel: DataFrame) -> DataFrame:
    """Signups, activated, paid and their rates per acquisition channel."""
    return (funnel.groupBy("acquisition_channel")
            .agg(F.count(F.lit(1)).alias("signups"),
                 F.sum(F.col("activated_7d").cast("int")).cast("bigint").alias("activated"),
                 F.sum(F.col("paid_30d").cast("int")).cast("bigint").alias("paid"))
            .withColumn("activation_rate", _ratio(F.col("activated"), F.col("signups"), 4))
            .withColumn("paid_rate", _ratio(F.col("paid"), F.col("signups"), 4)))


def retention_cohorts(companies: DataFrame, monthly_metrics: DataFrame) -> DataFrame:
    """Per signup cohort and cohort age (calendar months), companies in
    the cell, how many had an active user that month, and the rate."""
    coh = companies.select("company_id", month_start("signup_date").alias("cohort_month"))
    j = (monthly_metrics.select("company_id", "month_start", "active_users_monthly")
         .join(coh, "company_id")
         .where(F.col("month_start") >= F.col("cohort_month")))
    return (j.groupBy("cohort_month",
                      whole_month_diff("month_start", "cohort_month").alias("cohort_age_months"))
            .agg(F.count(F.lit(1)).alias("companies_in_cell"),
                 F.sum((F.col("active_users_monthly") > 0).cast("int")).cast("bigint")
                 .alias("retained_companies"))
            .withColumn("retention_rate",
                        _ratio(F.col("retained_companies"), F.col("companies_in_cell"), 4)))


def mrr_trend_breakdown(company_mrr: DataFrame, companies: DataFrame) -> DataFrame:
    """MRR per month x acquisition channel x plan (a company has one row a month)."""
    j = company_mrr.join(companies.select("company_id", "acquisition_channel"), "company_id")
    return (j.groupBy("month_start", "acquisition_channel", "plan_name")
            .agg(F.sum("mrr").alias("total_mrr"),
                 F.count(F.lit(1)).alias("companies"),
                 _mean(F.sum("mrr"), F.count("mrr")).alias("avg_mrr_per_company")))


def company_ltv(company_mrr: DataFrame, churn_label: DataFrame, as_of: _dt.date) -> DataFrame:
    """Average MRR over all spine months x months from the first month
    to the churn month (or the as-of month). Lifetime can be <= 0 when the
    churn date precedes the first month; it is kept, not clamped."""
    b = (company_mrr.groupBy("company_id")
         .agg(F.min("month_start").alias("first_month"),
              F.sum("mrr").alias("_sum"), F.count("mrr").alias("_n")))
    end = F.when(F.col("churn_flag") & F.col("churn_date").isNotNull(),
                 month_start("churn_date")).otherwise(month_start(lit_date(as_of)))
    j = b.join(churn_label.select("company_id", "churn_flag", "churn_date"), "company_id")
    life = (whole_month_diff(end, "first_month") + 1).cast("int")
    return j.select("company_id", "first_month", end.alias("end_month"),
                    life.alias("lifetime_months"),
                    _mean(F.col("_sum"), F.col("_n")).alias("avg_mrr_lifetime"),
                    _mean(F.col("_sum") * life, F.col("_n")).alias("ltv_est"))


def revenue_at_risk_skeleton(company_mrr: DataFrame) -> DataFrame:
    """MRR with empty probability / risk columns, to be filled later."""
    return company_mrr.select("company_id", "month_start", "mrr",
                              F.lit(None).cast("decimal(18,6)").alias("churn_probability"),
                              F.lit(None).cast("decimal(38,6)").alias("revenue_at_risk"))
