"""Monthly model features per company.

The source joins every company-month snapshot to the company's *whole*
history and filters inside the aggregates (cost: snapshots x facts per
company). Here each fact is copied only to the 1-3 month-end snapshots
whose window contains it, aggregated on (company, snapshot), and joined
1:1 to the snapshot spine: linear in the facts, no per-company cross
product, partial aggregation before every shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between, month_end, whole_month_diff
from ..operators.temporal import (attach_months, latest_plan_per_month, month_spine, plan_maps, plan_numbers,
                                  spine_with_months, spread_to_month_ends, with_plans)
from .gold import FAILED_PAYMENT_STATUSES, NEXT_DAY, with_next_day

# Windows are BETWEEN snapshot - N days AND snapshot (inclusive).
ACTIVITY_WINDOW_DAYS = 30
FRICTION_WINDOW_DAYS = 60
LABEL_HORIZON_DAYS = 30

KEYS = ["company_id", "as_of_date"]


def snapshot_spine(companies: DataFrame, as_of: _dt.date) -> DataFrame:
    """Month-end snapshot per company month (signup month .. as-of month)."""
    return month_spine(companies, as_of).select("company_id", month_end("month_start")
                                                .alias("as_of_date"))


def events_window(user_day: DataFrame, days: int = ACTIVITY_WINDOW_DAYS) -> DataFrame:
    """Active users, logins, invites, uploads in the window. An active
    user is a user-day of the window whose user's next one is after it."""
    s = spread_to_month_ends(with_next_day(user_day), "activity_date", days)
    last = F.col(NEXT_DAY).isNull() | (F.col(NEXT_DAY) > F.col("as_of_date"))
    return (s.groupBy(*KEYS)
            .agg(F.count_if(F.col("user_id").isNotNull() & last).alias("active_users_30d"),
                 F.sum("n_login").alias("logins_30d"),
                 F.sum("n_invite").alias("invites_30d"),
                 F.sum("n_file").alias("uploads_30d")))


def support_window(tickets: DataFrame, days: int = FRICTION_WINDOW_DAYS) -> DataFrame:
    """Tickets opened in the window (pre-counted per company-day)."""
    per_day = (tickets.groupBy("company_id", F.col("created_at").cast("date").alias("d"))
               .agg(F.count(F.lit(1)).alias("n")))
    return (spread_to_month_ends(per_day, "d", days).groupBy(*KEYS)
            .agg(F.sum("n").alias("tickets_60d")))


def payment_window(payments: DataFrame, days: int = FRICTION_WINDOW_DAYS) -> DataFrame:
    """Failed or declined payments in the window."""
    per_day = (payments.where(F.col("payment_status").isin(*FAILED_PAYMENT_STATUSES))
               .groupBy("company_id", F.col("payment_date").cast("date").alias("d"))
               .agg(F.count(F.lit(1)).alias("n")))
    return (spread_to_month_ends(per_day, "d", days).groupBy(*KEYS)
            .agg(F.sum("n").alias("failed_payments_60d")))


def days_to_first_invite(companies: DataFrame, user_day: DataFrame) -> DataFrame:
    """K16d: days from signup to the first invite ever (all time, as in the
    source; it looks past the snapshot, so the model excludes it)."""
    fi = (user_day.where(F.col("n_invite") > 0).groupBy("company_id")
          .agg(F.min("activity_date").alias("first_invite_date")))
    return (companies.select("company_id", "signup_date").join(fi, "company_id", "left")
            .select("company_id",
                    days_between("first_invite_date", F.col("signup_date").cast("date"))
                    .cast("int").alias("days_to_first_invite")))


def plan_asof(subscriptions: DataFrame, plans: DataFrame, as_of: _dt.date) -> DataFrame:
    """K16e / E8 point-in-time: plan name of the latest-starting
    subscription (any status) active on the snapshot day."""
    top = latest_plan_per_month(subscriptions, plans, as_of, point_in_time=True)
    return (top.join(F.broadcast(plans.select("plan_id", "plan_name")), "plan_id", "left")
            .select(*KEYS, F.col("plan_name").alias("plan_type")))


def month_windows(user_day: DataFrame, tickets: DataFrame, payments: DataFrame) -> DataFrame:
    """K16a-c side by side, one row a company and snapshot with any of them (NULL where a piece has no row)."""
    pieces = [events_window(user_day), support_window(tickets), payment_window(payments)]
    counts = [c for p in pieces for c in p.columns if c not in KEYS]
    rows = [p.select(*KEYS, *[F.col(c) if c in p.columns else F.lit(None).cast("bigint").alias(c) for c in counts])
            for p in pieces]
    return reduce(DataFrame.unionAll, rows).groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in counts])


def feature_companies(companies: DataFrame, user_day: DataFrame, subscriptions: DataFrame, plans: DataFrame,
                      churn_label: DataFrame, as_of: _dt.date) -> DataFrame:
    """Companies with signup, first invite, label and the plans of their snapshots (K16e / E8 point-in-time)."""
    comp = (companies.select("company_id", "signup_date")
            .join(days_to_first_invite(companies, user_day), "company_id", "left")
            .join(churn_label.select("company_id", "churn_flag", "churn_date"), "company_id",
                  "left"))
    return with_plans(comp, plan_maps(subscriptions, plans, as_of, point_in_time=True))


def company_features(companies: DataFrame, user_day: DataFrame, tickets: DataFrame,
                     payments: DataFrame, subscriptions: DataFrame, plans: DataFrame,
                     churn_label: DataFrame, as_of: _dt.date,
                     drop_post_churn: bool = False, windows: Sequence[DataFrame] | None = None,
                     picked: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Gold.company_features_for_model. Company-level attributes
    (signup, first invite, label) and each company's plans are attached
    before the spine is exploded, the windows where it is (``spine_with_months``,
    also for ``parts``). ``windows`` (K16a-c, or all as one, ``month_windows``)
    and ``picked`` (``feature_companies``) are reused when already built.
    Snapshots after a company's churn date stay in as negatives, as in the
    source; ``drop_post_churn`` removes them."""
    if windows is None:
        windows = [events_window(user_day), support_window(tickets), payment_window(payments)]
    if picked is None:
        picked = feature_companies(companies, user_day, subscriptions, plans, churn_label, as_of)
    out = spine_with_months(picked, as_of, windows, "as_of_date", parts=parts,
                            keep=[c for c in picked.columns if c not in ("company_id", "_plans")])
    if drop_post_churn:
        out = out.where(F.col("churn_date").isNull() | (F.col("as_of_date") < F.col("churn_date")))
    names = plan_numbers(plans).join(plans.select("plan_id", F.col("plan_name").alias("plan_type")), "plan_id")
    out = out.join(F.broadcast(names), "_plan", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    d = F.col("as_of_date")
    label = (F.col("churn_date").isNotNull() & (F.col("churn_date") > d)
             & (F.col("churn_date") <= F.date_add(d, LABEL_HORIZON_DAYS)))
    return out.select(
        "company_id", "as_of_date",
        z("active_users_30d"), z("logins_30d"), z("invites_30d"), z("uploads_30d"),
        z("tickets_60d"), z("failed_payments_60d"),
        "days_to_first_invite",
        F.coalesce("plan_type", F.lit("unknown")).alias("plan_type"),
        whole_month_diff(d, "signup_date").alias("months_since_signup"),
        F.col("churn_flag").alias("churn_flag_static"),
        F.when(label, 1).otherwise(0).cast("int").alias("churn_in_next_30d"))


def on_spine(spine: DataFrame, piece: DataFrame, zero_fill: list[str]) -> DataFrame:
    """A K16 piece aligned to the snapshot spine (one row per snapshot,
    counts zero-filled), the shape each piece has in the feature table."""
    out = attach_months(spine, piece, KEYS)
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in zero_fill
                        else F.col(c) for c in out.columns])
