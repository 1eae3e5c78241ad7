"""Temporal operators Spark has no single primitive for.

* month spine (generate_series per company)           -> explode(sequence)
* "latest row whose interval covers the month" (LATERAL ... ORDER BY ... LIMIT 1)
                                                        -> explode each interval
  into the months it covers, then row_number() = 1 per (key, month)
* "facts within N days before a snapshot" (join all history + FILTER)
                                                        -> copy each fact to the
  1-3 month-end snapshots whose window contains it, then a grouped aggregate

All three are linear in their input: no per-key cross product, no
unpartitioned window, and every grouped step has a map-side partial step
(partial aggregate or partial WindowGroupLimit), so a key holding a third
of the rows is combined before the shuffle instead of landing on one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_end, month_sequence, month_start


def month_spine(companies: DataFrame, as_of: _dt.date, key: str = "company_id",
                start_col: str = "signup_date", with_end: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """One row per (key, month_start) from the signup month to the as-of
    month, both inclusive. Signup after as-of or NULL signup -> no rows.
    ``keep`` carries company-level columns along (no later join needed)."""
    stop = month_start(lit_date(as_of))
    df = companies.select(
        key, *keep, F.explode(month_sequence(month_start(start_col), stop)).alias("month_start"))
    if with_end:
        df = df.withColumn("month_end", month_end("month_start"))
    return df


def attach_months(spine: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``facts`` (at most one row a company and month) left-joined to a company-month
    table. The facts of a partition go into a hash table: the spine, by far the
    longer side, is neither sorted nor spilled, and no table of months is
    broadcast because its compressed file looks small."""
    return spine.join(facts.hint("shuffle_hash"), list(keys), "left")


def by_key(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Rows dealt by ``key`` to ``parts`` tasks (the session's number if None). Tables
    dealt alike are joined by key, or by key and month, where they are."""
    return df.repartition(parts, key) if parts else df.repartition(key)


def spine_with_months(companies: DataFrame, as_of: _dt.date, facts: Sequence[DataFrame], month: str = "month_start",
                      keep: Sequence[str] = (), key: str = "company_id",
                      parts: int | None = None) -> DataFrame:
    """The month spine (``month_spine``) with the columns of ``facts`` (at most one row a
    company and month) attached by left joins on company and month, ``month`` being
    month_start or as_of_date (its month-end).

    Companies and facts are dealt by company to ``parts`` tasks before any month is made,
    so the months, by far the longer table, are made where their facts are and never
    shuffled, nor are they in later joins with other tables dealt alike. Companies
    ``with_plans`` get the number of the month's plan as ``_plan``."""
    comp, maps = by_key(companies, key, parts), [c for c in companies.columns if c == "_plans"]
    spine = month_spine(comp, as_of, key, keep=[*keep, *maps])
    found = [F.try_element_at(m, F.col("month_start")).alias("_plan") for m in maps]
    spine = spine.select(key, *keep, "month_start", month_end("month_start").alias("as_of_date"), *found)
    for f in facts:
        spine = attach_months(spine, by_key(f, key, parts), [key, month])
    values = [c for f in facts for c in f.columns if c not in (key, month)]
    return spine.select(key, *keep, "month_start", "as_of_date", *values, *["_plan" for _ in maps])


def months_covered(df: DataFrame, start: str, end: str, as_of: _dt.date,
                   point_in_time: bool = False, out: str = "month_start") -> DataFrame:
    """Explode each interval row into the months it matches, capped at the
    as-of month.

    overlap (default): month m matches when start <= last_day(m) and
        (end IS NULL or end >= m)  <=>  trunc(start) <= m <= trunc(end).
    point_in_time: the month-end e = last_day(m) matches when start <= e and
        (end IS NULL or end >= e); the last such month is trunc(end) when end
        is itself a month-end, otherwise the month before it.
    """
    return df.withColumn(out, F.explode(month_sequence(*covered_range(start, end, as_of, point_in_time))))


def covered_range(start: str, end: str, as_of: _dt.date, point_in_time: bool = False) -> tuple[Column, Column]:
    """First and last month that an interval matches (``months_covered``)."""
    cap = month_start(lit_date(as_of))
    if point_in_time:
        e = F.col(end).cast("date")
        last_end = F.when(e == F.last_day(e), month_start(e)).otherwise(
            F.add_months(month_start(e), -1))
    else:
        last_end = month_start(end)
    return month_start(start), F.when(F.col(end).isNull(), cap).otherwise(F.least(last_end, cap))


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     values: Sequence[str]) -> DataFrame:
    """Per group, the values of the row with the greatest ``order``
    tuple (first column most significant; later columns, then the values
    themselves, break ties, so the pick is deterministic).
    ``row_number() = 1`` plans as a WindowGroupLimit whose partial step
    keeps one row per group and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in list(order) + list(values)])
    return (df.select(*keys, *order, *values).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).select(*keys, *values))


#: Above any number of subscriptions that start on one company's day.
_DAY = 1 << 41


def plan_numbers(plans: DataFrame) -> DataFrame:
    """Each plan_id's number in the plans table, one row a plan."""
    return plans.select("plan_id", F.dense_rank().over(Window.orderBy("plan_id")).alias("_plan")).distinct()


def plan_maps(subscriptions: DataFrame, plans: DataFrame, as_of: _dt.date, point_in_time: bool = False) -> DataFrame:
    """H4/E8 for subscriptions, one row a company: ``_plans`` maps each month_start that a
    subscription matches (``months_covered``) to the plan number (``plan_numbers``) of the
    latest-starting one (ties go to the higher subscription_id, then plan_id), NULL if unknown.

    As ``latest_per_group`` over the exploded months, but the order is settled
    before they are made: a subscription gets one number that orders it among its
    company's (start day, then its place among those of that day). Of those with the
    same first and last month only the latest is kept, combined in tasks first, so a
    company's list is bounded by the calendar; its months are then picked inside its
    row. Months are neither shuffled nor grouped."""
    same_day = Window.partitionBy("company_id", "start_date").orderBy(
        F.col("subscription_id").desc_nulls_last(), F.col("plan_id").desc_nulls_last())
    day = F.datediff("start_date", F.lit("1970-01-01").cast("date")).cast("long")
    first, last = covered_range("start_date", "end_date", as_of, point_in_time)
    spans = (subscriptions.where("start_date is not null")
             .select("company_id", "plan_id", first.alias("_first"), last.alias("_last"),
                     (day * _DAY - F.row_number().over(same_day)).alias("_order"))
             .where("_first <= _last")
             .join(F.broadcast(plan_numbers(plans)), "plan_id", "left")
             .groupBy("company_id", "_first", "_last")
             .agg(F.max_by("_plan", "_order").alias("_plan"), F.max("_order").alias("_order")))
    lists = (spans.repartition("company_id").groupBy("company_id")
             .agg(F.sort_array(F.collect_list(F.struct("_order", "_first", "_last", "_plan")), asc=False).alias("_spans")))
    # the pick changes only where a span begins or has ended
    bounds = F.array_sort(F.array_distinct(F.concat(
        F.transform("_spans", lambda s: s["_first"]), F.transform("_spans", lambda s: F.add_months(s["_last"], 1)))))
    lists = lists.select("company_id", "_spans", bounds.alias("_bounds"))
    picked = F.transform("_bounds", lambda b, i: F.struct(
        b.alias("from"), F.add_months(F.get("_bounds", i + 1), -1).alias("to"),
        F.get(F.filter("_spans", lambda s: (s["_first"] <= b) & (s["_last"] >= b)), F.lit(0)).alias("s")))
    covered = F.filter(picked, lambda p: p["s"].isNotNull())
    months = F.flatten(F.transform(covered, lambda p: F.transform(
        month_sequence(p["from"], p["to"]), lambda m: F.struct(m, p["s"]["_plan"]))))
    return lists.select("company_id", F.map_from_entries(months).alias("_plans"))


def with_plans(companies: DataFrame, plans: DataFrame, key: str = "company_id") -> DataFrame:
    """Companies with their ``plan_maps``."""
    return companies.join(plans.hint("shuffle_hash"), key, "left")


def latest_plan_per_month(subscriptions: DataFrame, plans: DataFrame, as_of: _dt.date,
                          point_in_time: bool = False) -> DataFrame:
    """``plan_maps`` as rows: per (company_id, month_start), or with ``point_in_time``
    (company_id, as_of_date) at month-ends, the month's plan_id, NULL if that plan is unknown."""
    months = plan_maps(subscriptions, plans, as_of, point_in_time).select(
        "company_id", F.explode("_plans").alias("month_start", "_plan"))
    month = month_end("month_start").alias("as_of_date") if point_in_time else F.col("month_start")
    return (months.select("company_id", month, "_plan")
            .join(F.broadcast(plan_numbers(plans)), "_plan", "left").drop("_plan"))


def spread_to_month_ends(df: DataFrame, date_col: str, window_days: int,
                         out: str = "as_of_date") -> DataFrame:
    """Copy each fact dated d to every month-end e with
    e - window_days <= d <= e (both ends inclusive, i.e. a window of
    window_days + 1 days). Month-ends satisfying this lie in the months
    trunc(d) .. trunc(d + window_days); 1-2 copies for 30 days, 2-3 for 60."""
    d = F.col(date_col).cast("date")
    months = month_sequence(month_start(d), month_start(F.date_add(d, window_days)))
    return (df.withColumn("_m", F.explode(months))
            .withColumn(out, F.last_day("_m"))
            .where(F.col(out) <= F.date_add(d, window_days))
            .drop("_m"))


def existence_flag(left: DataFrame, right_keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """EXISTS(...) as a boolean column. ``right_keys`` is reduced to
    distinct keys first, so the left join never multiplies left rows."""
    flags = right_keys.select(*on).distinct().withColumn(name, F.lit(True))
    return (left.join(flags, list(on), "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))
