"""Revenue at risk (K17, K13, K14, K18) from any prediction table with
columns (company_id, as_of_date, churn_probability)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators.temporal import attach_months


KEYS = ["company_id", "month_start"]


def revenue_at_risk(predictions: DataFrame, company_mrr: DataFrame) -> DataFrame:
    """Gold.revenue_at_risk = prediction x the MRR of its month."""
    p = predictions.withColumn("month_start", month_start("as_of_date"))
    return (attach_months(p, company_mrr.select("company_id", "month_start", "mrr"), KEYS)
            .select("company_id", "as_of_date", "churn_probability", "mrr",
                    (F.col("mrr").cast("double") * F.col("churn_probability"))
                    .alias("revenue_at_risk")))


def latest_prediction_per_month(rar: DataFrame) -> DataFrame:
    """G1: ROW_NUMBER() OVER (PARTITION BY company, month ORDER BY as_of_date
    DESC) = 1 (probability breaks ties). Catalyst plans rank-1 filters as a
    WindowGroupLimit with a partial step before the shuffle, so a hot
    company-month is cut to one row per task before it moves."""
    w = Window.partitionBy("company_id", "month_start").orderBy(
        F.col("as_of_date").desc(), F.col("churn_probability").desc())
    return (rar.withColumn("month_start", month_start("as_of_date"))
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") == 1).drop("rn"))


def company_revenue_at_risk(company_mrr: DataFrame, rar: DataFrame) -> DataFrame:
    """Every company-month of MRR with the month's latest probability
    (0 when the month has no prediction) and mrr x probability."""
    rm = latest_prediction_per_month(rar).select("company_id", "month_start", "churn_probability")
    p = F.coalesce(F.col("churn_probability"), F.lit(0.0))
    return (company_mrr.select("company_id", "month_start", "mrr")
            .transform(attach_months, rm, KEYS)
            .select("company_id", "month_start", "mrr", p.alias("churn_probability"),
                    (p * F.col("mrr").cast("double")).alias("revenue_at_risk")))


def companies_per_month(crar: DataFrame) -> DataFrame:
    """Companies per month in the risk table (its rows are unique by
    company and month, so counting rows is enough)."""
    return crar.groupBy("month_start").agg(F.count(F.lit(1)).alias("companies"))


def company_risk_monitor(crar: DataFrame, features: DataFrame) -> DataFrame:
    """The dashboard data set, one row per company-month."""
    f = features.select("company_id", month_start("as_of_date").alias("month_start"),
                        "plan_type", "months_since_signup", "logins_30d", "failed_payments_60d")
    return (attach_months(crar, f, KEYS)
            .select("company_id", "month_start", "plan_type", "months_since_signup",
                    "logins_30d", "failed_payments_60d", "mrr", "churn_probability",
                    "revenue_at_risk"))


def monitor_by_month(monitor: DataFrame) -> DataFrame:
    """What must hold of the monitor each month: its rows and MRR, rows with
    a prediction (probability above 0; 0 stands for none), and counts
    of rows with a probability outside [0, 1] or a risk that isn't mrr x p."""
    p, product = F.col("churn_probability"), F.col("mrr").cast("double") * F.col("churn_probability")
    return monitor.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("mrr").cast("double"), 2).alias("total_mrr"),
        F.count_if(p > 0).alias("predicted_rows"), F.count_if((p < 0) | (p > 1)).alias("outside_0_1"),
        F.count_if(F.abs(F.col("revenue_at_risk") - product) > 1e-9 * F.greatest(F.abs(product), F.lit(1.0))).alias("wrong_products"))
