"""Gold activity, MRR and churn-label tables (K1-K8)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import AS_OF_FALLBACK, lit_date, month_start
from ..operators.temporal import latest_plan_per_month, plan_maps, plan_numbers, spine_with_months, with_plans

# Fixed values the logic depends on.
EVENT_TYPES = {"login": "login", "page_created": "page_created",
               "file_uploaded": "file_uploaded", "invite_sent": "invite_sent"}
FAILED_PAYMENT_STATUSES = ("failed", "declined")
MRR_SUBSCRIPTION_STATUSES = ("active", "cancelled")
ACTIVE_STATUS = "active"
CANCELLED_STATUS = "cancelled"
INACTIVITY_DAYS = 30


def as_of_frame(events: DataFrame, payments: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """K1 as a one-row DataFrame: GREATEST of the latest event day, payment
    day and subscription end (or start), each defaulting to 2000-01-01 when
    its source is empty. Three global max aggregates, each with a partial
    step per task; the cross join only pairs three one-row results."""
    fb = lit_date(AS_OF_FALLBACK)
    a = events.agg(F.max(F.col("event_timestamp").cast("date")).alias("a"))
    b = payments.agg(F.max(F.col("payment_date").cast("date")).alias("b"))
    c = subscriptions.agg(F.max(F.coalesce("end_date", "start_date")).alias("c"))
    return (a.crossJoin(b).crossJoin(c)
            .select(F.greatest(F.coalesce("a", fb), F.coalesce("b", fb), F.coalesce("c", fb))
                    .alias("as_of_date")))


def as_of_date(events: DataFrame, payments: DataFrame, subscriptions: DataFrame) -> _dt.date:
    """K1 computed once per run as a scalar and then used as a literal by
    every builder, so Catalyst can constant-fold it and push date
    predicates down instead of re-evaluating it in every table."""
    return as_of_frame(events, payments, subscriptions).first()["as_of_date"]


#: The user's next active day (NULL on the last): says by itself whether a user-day is the
#: user's last one in a month or window, so distinct users are counted as rows.
NEXT_DAY = "next_date"


def with_next_day(user_day: DataFrame) -> DataFrame:
    """User-days with ``NEXT_DAY`` (as they are if they have it)."""
    if NEXT_DAY in user_day.columns:
        return user_day
    w = Window.partitionBy("user_id", "company_id").orderBy("activity_date")
    return user_day.withColumn(NEXT_DAY, F.lead("activity_date").over(w))


def user_day_activity(events: DataFrame, users: DataFrame) -> DataFrame:
    """Shared grain for every activity metric: one row per (company, user,
    day) with per-type event counts.

    Events are aggregated to (user, day), partially on the map side, before
    they meet the users: one shuffle by (user, day), one of the smaller
    result by user. Events without a parsable time have no day and are left
    out (the rejected-rows report counts them).
    """
    et = F.col("event_type")
    per = (events.where("event_timestamp is not null")
           .select("user_id", F.col("event_timestamp").cast("date").alias("activity_date"),
                         "event_type")
           .groupBy("user_id", "activity_date")
           .agg(F.count(F.lit(1)).alias("n_events"),
                F.count_if(et == EVENT_TYPES["login"]).alias("n_login"),
                F.count_if(et == EVENT_TYPES["page_created"]).alias("n_page"),
                F.count_if(et == EVENT_TYPES["file_uploaded"]).alias("n_file"),
                F.count_if(et == EVENT_TYPES["invite_sent"]).alias("n_invite")))
    return with_next_day(per.join(users.select("user_id", "company_id"), "user_id").select(
        "company_id", "user_id", "activity_date", "n_events", "n_login", "n_page", "n_file",
        "n_invite"))


def company_daily_activity(user_day: DataFrame) -> DataFrame:
    """K2: gold.company_daily_activity. (user, day) rows are unique, so the
    distinct-user count per company-day is a plain row count."""
    return (user_day.groupBy("company_id", "activity_date")
            .agg(F.count(F.lit(1)).alias("active_users"),
                 F.sum("n_login").alias("login_count"),
                 F.sum("n_page").alias("pages_created"),
                 F.sum("n_file").alias("files_uploaded"),
                 F.sum("n_invite").alias("invites_sent"),
                 F.sum("n_events").alias("total_events")))


def monthly_activity(daily: DataFrame) -> DataFrame:
    """K3: month sums of the daily table plus active days and peak DAU."""
    return (daily.groupBy("company_id", month_start("activity_date").alias("month_start"))
            .agg(F.sum("total_events").alias("total_events"),
                 F.sum("login_count").alias("total_logins"),
                 F.sum("invites_sent").alias("total_invites"),
                 F.sum("files_uploaded").alias("total_files"),
                 F.sum("pages_created").alias("total_pages_created"),
                 F.count_if(F.col("active_users") > 0).alias("active_days"),
                 F.max("active_users").alias("peak_daily_active_users")))


def monthly_active_users(user_day: DataFrame, name: str = "monthly_active_users") -> DataFrame:
    """K4: distinct users with any event in the month (from events, never
    from the daily table): the user-days that are the user's last of the month."""
    last = ~month_start(NEXT_DAY).eqNullSafe(month_start("activity_date"))
    return (with_next_day(user_day).groupBy("company_id", month_start("activity_date").alias("month_start"))
            .agg(F.count_if(F.col("user_id").isNotNull() & last).alias(name)))


def monthly_tickets(tickets: DataFrame) -> DataFrame:
    """Tickets opened per company-month."""
    return (tickets.groupBy("company_id", month_start("created_at").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("tickets_count")))


def monthly_failed_payments(payments: DataFrame) -> DataFrame:
    """Failed or declined payments per company-month (0 when the month
    has only good payments)."""
    return (payments.groupBy("company_id", month_start("payment_date").alias("month_start"))
            .agg(F.count_if(F.col("payment_status").isin(*FAILED_PAYMENT_STATUSES))
                 .alias("failed_payments")))


def company_monthly_metrics(companies: DataFrame, user_day: DataFrame, tickets: DataFrame,
                            payments: DataFrame, as_of: _dt.date,
                            daily: DataFrame | None = None,
                            mau: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """K6: spine with the pre-aggregated monthly facts attached, zero-filled.
    Every fact is aggregated to (company, month) and dealt by company, before
    the company's months are made. ``daily`` and ``mau`` (K2, K4) are reused
    when already built; ``parts`` as in ``spine_with_months``."""
    daily = daily if daily is not None else company_daily_activity(user_day)
    mau = mau if mau is not None else monthly_active_users(user_day)
    act = monthly_activity(daily).drop("active_days", "peak_daily_active_users")
    out = spine_with_months(companies, as_of, [act, mau, monthly_tickets(tickets), monthly_failed_payments(payments)],
                            parts=parts)
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "company_id", "month_start",
        F.coalesce("monthly_active_users", F.lit(0)).cast("bigint").alias("active_users_monthly"),
        z("total_events"), z("total_logins"), z("total_invites"), z("total_files"),
        z("total_pages_created"), z("tickets_count"), z("failed_payments"))


def mrr_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """The subscriptions that count for MRR."""
    return subscriptions.where(F.col("status").isin(*MRR_SUBSCRIPTION_STATUSES))


def mrr_plan_per_month(subscriptions: DataFrame, plans: DataFrame, as_of: _dt.date) -> DataFrame:
    """E8 (interval overlap): per (company, month) the plan of the latest-
    starting active/cancelled subscription overlapping the month; ties on
    start date go to the higher subscription_id. The plan comes from the
    plans table, so a dangling plan_id yields no plan (-> 'unknown')."""
    top = latest_plan_per_month(mrr_subscriptions(subscriptions), plans, as_of)
    sp = plans.select(F.col("plan_id").alias("sp_plan_id"), "plan_name", "price_per_user",
                      "billing_cycle")
    return (top.join(sp, F.col("plan_id") == F.col("sp_plan_id"), "left")
            .select("company_id", "month_start", F.col("sp_plan_id").alias("plan_id"),
                    "plan_name", "price_per_user", "billing_cycle"))


def mrr_companies(companies: DataFrame, subscriptions: DataFrame, plans: DataFrame, as_of: _dt.date) -> DataFrame:
    """Companies with the plans of their months, by E8 (interval overlap)."""
    return with_plans(companies.select("company_id", "signup_date"), plan_maps(mrr_subscriptions(subscriptions), plans, as_of))


def company_mrr(companies: DataFrame, user_day: DataFrame, subscriptions: DataFrame,
                plans: DataFrame, as_of: _dt.date, mau: DataFrame | None = None,
                picked: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """K7: gold.company_mrr = monthly active users x price per user of the
    month's plan (billing cycle is not normalised, as in the source).
    ``mau`` (K4) and ``picked`` (``mrr_companies``) are reused when already
    built; ``parts`` as in ``spine_with_months``."""
    mau = (monthly_active_users(user_day) if mau is None else mau).withColumnRenamed(
        "monthly_active_users", "active_user_count")
    picked = mrr_companies(companies, subscriptions, plans, as_of) if picked is None else picked
    spine = spine_with_months(picked, as_of, [mau], parts=parts)
    plan = plan_numbers(plans).join(plans.select("plan_id", "plan_name", "price_per_user"), "plan_id")
    users = F.coalesce(F.col("active_user_count"), F.lit(0)).cast("bigint")
    price = F.coalesce(F.col("price_per_user"), F.lit(0).cast("decimal(18,2)"))
    return (spine.join(F.broadcast(plan), "_plan", "left")
            .select("company_id", "month_start",
                    F.coalesce("plan_id", F.lit("unknown")).alias("plan_id"),
                    F.coalesce("plan_name", F.lit("unknown")).alias("plan_name"),
                    price.alias("price_per_user"),
                    users.alias("active_user_count"),
                    (users * price).alias("mrr")))


def company_churn_label(companies: DataFrame, user_day: DataFrame, subscriptions: DataFrame,
                        as_of: _dt.date) -> DataFrame:
    """K8: gold.company_churn_label. Any cancelled subscription churns the
    company at its earliest cancel date; otherwise 30+ days without events
    and no active subscription on the as-of date churns it at last
    activity + 30; a company with no events is 'active'."""
    d = lit_date(as_of)
    last = user_day.groupBy("company_id").agg(F.max("activity_date").alias("last_activity_date"))
    cancelled = (subscriptions.where(F.col("status") == CANCELLED_STATUS)
                 .groupBy("company_id")
                 .agg(F.min(F.coalesce("end_date", "start_date")).alias("cancelled_date")))
    active = (subscriptions
              .where((F.col("status") == ACTIVE_STATUS) & (F.col("start_date") <= d)
                     & (F.col("end_date").isNull() | (F.col("end_date") >= d)))
              .select("company_id").distinct()
              .withColumn("has_active_subscription_asof", F.lit(True)))
    base = (companies.select("company_id")
            .join(last, "company_id", "left")
            .join(cancelled, "company_id", "left")
            .join(active, "company_id", "left")
            .withColumn("has_active_subscription_asof",
                        F.coalesce("has_active_subscription_asof", F.lit(False))))
    is_cancel = F.col("cancelled_date").isNotNull()
    inactive = (F.col("last_activity_date").isNotNull()
                & (F.col("last_activity_date") <= F.date_sub(d, INACTIVITY_DAYS))
                & (F.col("has_active_subscription_asof") == F.lit(False)))
    return base.select(
        "company_id",
        F.when(is_cancel, True).when(inactive, True).otherwise(False).alias("churn_flag"),
        F.when(is_cancel, F.col("cancelled_date"))
        .when(inactive, F.date_add("last_activity_date", INACTIVITY_DAYS)).alias("churn_date"),
        F.when(is_cancel, "cancelled").when(inactive, "inactive_30d").otherwise("active")
        .alias("churn_reason"),
        "last_activity_date",
        d.alias("as_of_date"))
