"""DuckDB SQL oracle for every registered query.

Each query is ``WITH <the CTEs it needs> <select>`` over the driver's
pre-registered test tables. Gold is written from the definitions on month
numbers: facts are stacked and summed on a company's months, subscriptions
are ranked once over the months they cover, windows are range joins.
Final selects cast counts to BIGINT, money to DOUBLE, dates to DATE.
"""

from __future__ import annotations

import re

from .functions.buckets import COMPANY_SIZE_EDGES, bucket_sql

# --- adapter: driver test tables -> raw SaaS tables (FIXTURES.md) ----------
ADAPTER = {
    "customer_rows": """
select c_custkey as k, c_name, c_mktsegment, n_name, n_regionkey, c_acctbal,
       (select cast(min(o_orderdate) as date) from orders where o_custkey = c_custkey) as first_day
from customer join nation on n_nationkey = c_nationkey""",
    "raw_companies": """
select case copy when 2 then ' ' else 'c' || k end as company_id, c_name as company_name, first_day as signup_date,
       c_mktsegment as acquisition_channel, 'industry_' || n_regionkey as industry,
       cast(1 + k * 7 % 1500 as int) as company_size, n_name as country,
       case when c_acctbal < 0 then '' else 'active' end as status
from customer_rows, (values (0), (1), (2)) t(copy)
where copy = 0 or (copy = 1 and k % 41 = 0) or (copy = 2 and k % 43 = 0)""",
    "raw_users": """
select 'u' || o_custkey || '-' || o_orderkey % 4 as user_id,
       case when o_custkey % 47 = 0 and o_orderkey % 4 = 3 then 'c-unknown' else 'c' || o_custkey end as company_id,
       if(o_orderkey % 4 = 0, 'admin', 'member') as role,
       case o_custkey % 3 when 0 then strftime(min(o_orderdate), '%Y-%m-%d') when 1 then strftime(min(o_orderdate), '%Y/%m/%d')
            else strftime(min(o_orderdate), '%d.%m.%Y') end as join_date,
       if(o_custkey % 53 = 0, 'never', strftime(max(o_orderdate), '%m/%d/%Y')) as last_active_date,
       case when max(o_orderdate) >= timestamp '2001-01-01' then if(o_custkey % 2 = 0, 't', 'Yes') else if(o_custkey % 2 = 0, 'f', '0') end as is_active
from orders group by o_custkey, o_orderkey % 4""",
    "raw_events": """
select 'e' || l_orderkey || '-' || l_linenumber as event_id,
       case when l_orderkey % 89 = 0 then 'u-unknown' else 'u' || o_custkey || '-' || l_orderkey % 4 end as user_id,
       case l_linenumber % 7 when 1 then 'page_created' when 2 then 'file_uploaded' when 3 then 'invite_sent' else 'login' end as event_type,
       case when l_orderkey % 61 = 0 and l_linenumber = 1 then 'not a time' else case l_linenumber % 5
         when 0 then strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') when 1 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
         when 2 then strftime(l_shipdate, '%Y/%m/%d %H:%M:%S') when 3 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
         else strftime(l_shipdate, '%Y-%m-%d %H:%M') end end as event_timestamp
from lineitem join orders on o_orderkey = l_orderkey, (values (0), (1)) t(copy)
where copy = 0 or l_orderkey % 73 = 0""",
    "raw_subscription_plans": """
select 'p' || level as plan_id, case level when 1 then 'Basic' when 2 then 'Pro' else 'Enterprise' end as plan_name,
       cast(level * min(cast(p_retailprice as decimal(18,2))) as decimal(18,2)) as price_per_user, if(level = 3, 'annual', 'monthly') as billing_cycle
from (select 1 + p_partkey % 3 as level, p_retailprice from part) group by level""",
    "raw_subscriptions": """
select 's' || o_orderkey as subscription_id, 'c' || o_custkey as company_id,
       if(o_orderkey % 71 = 0, 'p9', 'p' || 1 + o_orderkey % 3) as plan_id,
       if(o_orderkey % 2 = 0, strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y%m%d')) as start_date,
       if(o_orderstatus = 'O' and o_orderkey % 2 = 0, '', strftime(cast(o_orderdate as date) + cast(30 * (1 + o_orderkey % 12) as int), '%Y-%m-%d')) as end_date,
       case when o_orderstatus = 'F' and o_orderkey % 3 = 0 then 'cancelled'
            when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'active' else 'expired' end as status
from orders""",
    "raw_payments": """
select if(o_orderkey % 67 = 0, '', 'pay' || o_orderkey) as payment_id, 'c' || o_custkey as company_id,
       case when o_orderkey % 53 = 0 then '' when o_orderkey % 59 = 0 then 'n/a'
            else cast(cast(o_totalprice as decimal(18,2)) as varchar) end as amount,
       cast(o_orderdate as date) as payment_date,
       case when o_orderkey % 7 = 0 then 'failed' when o_orderkey % 11 = 0 then 'declined' else 'paid' end as payment_status
from orders""",
    "raw_support_tickets": """
select 't' || l_orderkey || '-' || l_linenumber as ticket_id, 'c' || o_custkey as company_id, l_shipdate as created_at,
       cast(l_quantity as decimal(18,2)) as resolution_time_hours,
       case l_partkey % 7 when 0 then '' when 6 then 'n/a' else cast(l_partkey % 7 as varchar) end as satisfaction_score
from lineitem join orders on o_orderkey = l_orderkey where l_returnflag = 'R'""",
}


def _nz(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _date(c: str) -> str:
    fmts = ["%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d.%m.%Y", "%Y%m%d"]
    parts = ", ".join(f"try_strptime({_nz(c)}, '{f}')" for f in fmts)
    return f"cast(coalesce({parts}) as date)"


def _time(c: str) -> str:
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M"]
    return f"try_strptime({_nz(c)}, {fmts!r})"


def _bool(c: str) -> str:
    v = f"lower({_nz(c)})"
    return (f"case when {v} in ('t','true','y','yes','1') then true "
            f"when {v} in ('f','false','n','no','0') then false end")


def _dedupe(src: str, key: str, cols: list[str]) -> str:
    order = ", ".join(f"{c} asc nulls first" for c in cols if c != key)
    return (f"select {', '.join(cols)} from (select *, row_number() over "
            f"(partition by {key} order by {order}) as rn__ from ({src}) d where {key} is not null) "
            f"x where rn__ = 1")


_SIZE_BUCKET = bucket_sql("company_size", COMPANY_SIZE_EDGES)

_SILVER_COLS = {
    "companies": ["company_id", "company_name", "signup_date", "acquisition_channel", "industry",
                  "company_size", "country", "status", "company_size_bucket"],
    "users": ["user_id", "company_id", "role", "join_date", "last_active_date", "is_active"],
    "events": ["event_id", "user_id", "event_type", "event_timestamp"],
    "subscription_plans": ["plan_id", "plan_name", "price_per_user", "billing_cycle"],
    "subscriptions": ["subscription_id", "company_id", "plan_id", "start_date", "end_date", "status"],
    "payments": ["payment_id", "company_id", "amount", "payment_date", "payment_status"],
    "support_tickets": ["ticket_id", "company_id", "created_at", "resolution_time_hours",
                        "satisfaction_score"],
}

_TYPED = {
    "companies": f"""select {_nz('company_id')} company_id, {_nz('company_name')} company_name,
  signup_date, {_nz('acquisition_channel')} acquisition_channel, {_nz('industry')} industry,
  company_size, {_nz('country')} country, {_nz('status')} status, {_SIZE_BUCKET} company_size_bucket
  from raw_companies""",
    "users": f"""select {_nz('user_id')} user_id, {_nz('company_id')} company_id, {_nz('role')} "role",
  {_date('join_date')} join_date, {_date('last_active_date')} last_active_date,
  {_bool('is_active')} is_active from raw_users""",
    "events": f"""select {_nz('event_id')} event_id, {_nz('user_id')} user_id,
  {_nz('event_type')} event_type, {_time('event_timestamp')} event_timestamp from raw_events""",
    "subscription_plans": f"""select {_nz('plan_id')} plan_id, {_nz('plan_name')} plan_name,
  price_per_user, {_nz('billing_cycle')} billing_cycle from raw_subscription_plans""",
    "subscriptions": f"""select {_nz('subscription_id')} subscription_id, {_nz('company_id')} company_id,
  {_nz('plan_id')} plan_id, {_date('start_date')} start_date, {_date('end_date')} end_date,
  {_nz('status')} status from raw_subscriptions""",
    "payments": f"""select {_nz('payment_id')} payment_id, {_nz('company_id')} company_id,
  try_cast({_nz('amount')} as decimal(18,2)) amount, payment_date, {_nz('payment_status')} payment_status from raw_payments""",
    "support_tickets": f"""select {_nz('ticket_id')} ticket_id, {_nz('company_id')} company_id,
  cast(created_at as timestamp) created_at, resolution_time_hours,
  case when try_cast({_nz('satisfaction_score')} as int) between 1 and 5
       then try_cast({_nz('satisfaction_score')} as int) end satisfaction_score
  from raw_support_tickets""",
}

_PK = {"companies": "company_id", "users": "user_id", "events": "event_id",
       "subscription_plans": "plan_id", "subscriptions": "subscription_id",
       "payments": "payment_id", "support_tickets": "ticket_id"}


def _fk(fk: str, parent: str, pk: str) -> str:
    return f"({fk} is null or {fk} in (select {pk} from {parent}))"


SILVER = {
    "silver_companies": _dedupe(_TYPED["companies"], "company_id", _SILVER_COLS["companies"]),
    "silver_subscription_plans": _dedupe(_TYPED["subscription_plans"], "plan_id",
                                         _SILVER_COLS["subscription_plans"]),
    "silver_users": f"select * from ({_dedupe(_TYPED['users'], 'user_id', _SILVER_COLS['users'])}) u "
                    f"where {_fk('company_id', 'silver_companies', 'company_id')}",
    "silver_events": f"select * from ({_dedupe(_TYPED['events'], 'event_id', _SILVER_COLS['events'])}) e "
                     f"where {_fk('user_id', 'silver_users', 'user_id')}",
    "silver_payments": f"select * from ({_dedupe(_TYPED['payments'], 'payment_id', _SILVER_COLS['payments'])}) p "
                       f"where {_fk('company_id', 'silver_companies', 'company_id')}",
    "silver_subscriptions": f"select * from ({_dedupe(_TYPED['subscriptions'], 'subscription_id', _SILVER_COLS['subscriptions'])}) s "
                            f"where {_fk('company_id', 'silver_companies', 'company_id')} "
                            f"and {_fk('plan_id', 'silver_subscription_plans', 'plan_id')}",
    "silver_support_tickets": f"select * from ({_dedupe(_TYPED['support_tickets'], 'ticket_id', _SILVER_COLS['support_tickets'])}) t "
                              f"where {_fk('company_id', 'silver_companies', 'company_id')}",
}

# --- gold: one table of month-numbered facts, one of covered months ---------
GOLD: dict[str, str] = {}


def month_no(c: str) -> str:
    """Months since year 0, so that month arithmetic is subtraction."""
    return f"(year({c}) * 12 + month({c}) - 1)"


def first_day(m: str) -> str:
    return f"make_date(cast({m} // 12 as int), cast({m} % 12 + 1 as int), 1)"


GOLD["as_of_t"] = """
select max(d) as as_of_date from (
  select date '2000-01-01' as d union all select cast(event_timestamp as date) from silver_events
  union all select payment_date from silver_payments
  union all select coalesce(end_date, start_date) from silver_subscriptions)"""

# every activity metric derives from user-days
GOLD["user_days"] = """
select company_id, user_id, cast(event_timestamp as date) as day, count(*) as events,
  count_if(event_type = 'login') as logins, count_if(event_type = 'page_created') as pages,
  count_if(event_type = 'file_uploaded') as files, count_if(event_type = 'invite_sent') as invites
from silver_users join silver_events using (user_id) where event_timestamp is not null group by all"""

GOLD["months"] = f"""
select company_id, unnest(range({month_no('signup_date')}, {month_no('as_of_date')} + 1)) as m
from silver_companies, as_of_t where signup_date is not null"""

GOLD["snapshots"] = f"""
select company_id, m, {first_day('m')} as month_start, last_day({first_day('m')}) as as_of_date from months"""

GOLD["gold_company_daily_activity"] = """
select company_id, day as activity_date, count(*) as active_users, sum(logins) as login_count, sum(pages) as pages_created,
  sum(files) as files_uploaded, sum(invites) as invites_sent, sum(events) as total_events
from user_days group by company_id, day"""

GOLD["mau_t"] = f"""
select company_id, {first_day(month_no('day'))} as month_start, count(distinct user_id) as monthly_active_users
from user_days group by all"""

# facts of all kinds stacked; months outside a company's spine fall away
_METRICS = ["active_users_monthly", "total_events", "total_logins", "total_invites", "total_files",
            "total_pages_created", "tickets_count", "failed_payments"]


def _fact(month: str, values: dict[str, str], source: str) -> str:
    cells = ", ".join(f"{values.get(c, '0')} as {c}" for c in _METRICS)
    return f"select company_id, {month} as m, {cells} from {source} group by all"


GOLD["month_facts"] = " union all ".join([
    _fact(month_no("day"), {"active_users_monthly": "count(distinct user_id)", "total_events": "sum(events)",
                            "total_logins": "sum(logins)", "total_invites": "sum(invites)",
                            "total_files": "sum(files)", "total_pages_created": "sum(pages)"}, "user_days"),
    _fact(month_no("created_at"), {"tickets_count": "count(*)"}, "silver_support_tickets"),
    _fact(month_no("payment_date"), {"failed_payments": "count_if(payment_status in ('failed', 'declined'))"}, "silver_payments")])

GOLD["gold_company_monthly_metrics"] = f"""
select company_id, month_start, {', '.join(f'cast(coalesce(sum({c}), 0) as bigint) as {c}' for c in _METRICS)}
from snapshots left join month_facts using (company_id, m) group by company_id, month_start"""

# subscription months, newest first: billing takes the overlapping, snapshots the one open at month end
GOLD["covered"] = """
select company_id, m, month_start, as_of_date, plan_id, status, end_date is null or end_date >= as_of_date as open_at_end,
  row_number() over (partition by company_id, m order by start_date desc, subscription_id desc) as newest
from snapshots join silver_subscriptions using (company_id)
where start_date <= as_of_date and coalesce(end_date, as_of_date) >= month_start"""

GOLD["billed"] = """
select company_id, m, arg_min(coalesce(plan_id, ''), newest) as plan_id from covered
where status in ('active', 'cancelled') group by company_id, m"""

GOLD["gold_company_mrr"] = """
select company_id, month_start, coalesce(p.plan_id, 'unknown') as plan_id, coalesce(plan_name, 'unknown') as plan_name,
  coalesce(price_per_user, 0) as price_per_user, active_users_monthly as active_user_count,
  active_users_monthly * coalesce(price_per_user, 0) as mrr
from snapshots join gold_company_monthly_metrics using (company_id, month_start)
left join billed using (company_id, m) left join silver_subscription_plans p on p.plan_id = billed.plan_id"""

GOLD["subscription_state"] = """
select company_id, min(coalesce(end_date, start_date)) filter (where status = 'cancelled') as cancelled_on,
  coalesce(bool_or(status = 'active' and start_date <= as_of_date and coalesce(end_date, as_of_date) >= as_of_date), false) as running
from silver_subscriptions, as_of_t group by company_id"""

GOLD["churn_kind"] = """
select company_id, as_of_date, cancelled_on, last_day_seen,
  case when cancelled_on is not null then 'cancelled'
       when as_of_date - last_day_seen >= 30 and not coalesce(running, false) then 'inactive_30d' else 'active' end as kind
from silver_companies cross join as_of_t left join subscription_state using (company_id)
left join (select company_id, max(day) as last_day_seen from user_days group by company_id) using (company_id)"""

GOLD["gold_company_churn_label"] = """
select company_id, kind <> 'active' as churn_flag,
  case kind when 'cancelled' then cancelled_on when 'inactive_30d' then last_day_seen + 30 end as churn_date,
  kind as churn_reason, last_day_seen as last_activity_date, as_of_date from churn_kind"""


def with_ctes(select: str) -> str:
    """The query with the CTEs that it refers to, directly or through others."""
    bodies = {**ADAPTER, **SILVER, **GOLD}
    needed: set[str] = set()
    todo = [select]
    while todo:
        for name in set(re.findall(r"\w+", todo.pop())) & bodies.keys() - needed:
            needed.add(name)
            todo.append(bodies[name])
    if select.lstrip().lower().startswith("with"):
        select = f"select * from ({select}) q__"
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({bodies[n]})" for n in bodies if n in needed) + "\n" + select


GOLD["gold_funnel_company"] = """
select company_id, signup_date, acquisition_channel, coalesce(first_use - signup_date <= 7, false) as activated_7d,
  coalesce(first_plan - signup_date <= 30, false) as paid_30d, cast(activated_7d as int) as activation_stage,
  cast(paid_30d as int) as paid_stage
from silver_companies
left join (select company_id, min(day) as first_use from user_days join silver_companies using (company_id)
           where day >= signup_date group by company_id) using (company_id)
left join (select company_id, min(start_date) as first_plan from silver_subscriptions join silver_companies using (company_id)
           where start_date >= signup_date group by company_id) using (company_id)"""

GOLD["gold_retention_company_cohorts"] = f"""
select cohort_month, age as cohort_age_months, count(*) as companies_in_cell, count_if(active_users_monthly > 0) as retained_companies,
  round(count_if(active_users_monthly > 0) / count(*), 4) as retention_rate
from (select cast(date_trunc('month', signup_date) as date) as cohort_month, active_users_monthly,
        cast({month_no('month_start')} - {month_no('signup_date')} as int) as age
      from silver_companies join gold_company_monthly_metrics using (company_id)) group by cohort_month, age"""

GOLD["gold_mrr_trend_breakdown"] = """
select month_start, acquisition_channel, plan_name, cast(sum(mrr) as double) as total_mrr, count(*) as companies,
  round(avg(cast(mrr as double)), 6) as avg_mrr_per_company
from silver_companies join gold_company_mrr using (company_id) group by all"""

GOLD["gold_company_ltv"] = f"""
select company_id, first_month, end_month, lifetime_months, round(mean, 6) as avg_mrr_lifetime, round(mean * lifetime_months, 6) as ltv_est
from (select company_id, min(month_start) as first_month, cast(sum(mrr) as double) / count(*) as mean,
        cast(date_trunc('month', coalesce(any_value(churn_date), any_value(l.as_of_date))) as date) as end_month,
        cast({month_no('end_month')} - {month_no('first_month')} + 1 as int) as lifetime_months
      from gold_company_mrr join gold_company_churn_label l using (company_id) group by company_id)"""

# windows that end at a snapshot: range joins of user-days, tickets and payments
GOLD["usage_30d"] = """
select company_id, as_of_date, count(distinct user_id) as active_users_30d, cast(sum(logins) as bigint) as logins_30d,
  cast(sum(invites) as bigint) as invites_30d, cast(sum(files) as bigint) as uploads_30d
from snapshots join user_days using (company_id) where day <= as_of_date and as_of_date - day <= 30 group by all"""

GOLD["tickets_t"] = """
select company_id, as_of_date, count(*) as tickets_60d from snapshots join silver_support_tickets using (company_id)
where cast(created_at as date) <= as_of_date and as_of_date - cast(created_at as date) <= 60 group by all"""

GOLD["failures_t"] = """
select company_id, as_of_date, count(*) as failed_payments_60d from snapshots join silver_payments using (company_id)
where payment_status in ('failed', 'declined') and payment_date <= as_of_date and as_of_date - payment_date <= 60 group by all"""

GOLD["invited"] = """
select company_id, signup_date, cast(min(day) filter (where invites > 0) - signup_date as int) as days_to_first_invite
from silver_companies left join user_days using (company_id) group by company_id, signup_date"""

GOLD["plan_at_end"] = """
select company_id, as_of_date, coalesce(plan_name, 'unknown') as plan_type from snapshots
left join (select company_id, m, arg_min(coalesce(plan_id, ''), newest) as plan_id from covered where open_at_end group by company_id, m)
  using (company_id, m) left join silver_subscription_plans using (plan_id)"""

_COUNTS = ["active_users_30d", "logins_30d", "invites_30d", "uploads_30d", "tickets_60d", "failed_payments_60d"]

GOLD["gold_company_features_for_model"] = f"""
select company_id, as_of_date, {', '.join(f'coalesce({c}, 0) as {c}' for c in _COUNTS)}, days_to_first_invite, plan_type,
  cast(m - {month_no('signup_date')} as int) as months_since_signup, churn_flag as churn_flag_static,
  cast(coalesce(churn_date - as_of_date between 1 and 30, false) as int) as churn_in_next_30d
from snapshots join invited using (company_id) join plan_at_end using (company_id, as_of_date)
join (select company_id, churn_flag, churn_date from gold_company_churn_label) using (company_id)
left join usage_30d using (company_id, as_of_date) left join tickets_t using (company_id, as_of_date)
left join failures_t using (company_id, as_of_date)"""

# --- model inputs / evaluation / risk ---------------------------------------
FIXTURE_CUTOFF_SQL = "date '2000-01-01'"

GOLD["heuristic_t"] = f"""
select company_id, as_of_date, churn_in_next_30d as label,
  cast(failed_payments_60d + tickets_60d + 1 as double)
    / cast(failed_payments_60d + tickets_60d + logins_30d + active_users_30d + months_since_signup + 2
           as double) as churn_probability
from gold_company_features_for_model where as_of_date >= {FIXTURE_CUTOFF_SQL}"""

# a discriminant of independent columns, its scores from the coefficient table
NUMERIC = ["active_users_30d", "logins_30d", "invites_30d", "uploads_30d", "tickets_60d", "failed_payments_60d", "months_since_signup"]

GOLD["train_t"] = f"select * from gold_company_features_for_model where as_of_date < {FIXTURE_CUTOFF_SQL}"

GOLD["train_values"] = "\nunion all\n".join(
    [f"select '{c}' as feature, cast({c} as double) as x, churn_in_next_30d as y from train_t" for c in NUMERIC]
    + ["select 'plan_type_' || level, cast(plan_type = level as int), churn_in_next_30d "
       "from train_t, (select distinct plan_type as level from train_t)"])

GOLD["coefficients_t"] = """
with moments as (
  select feature, avg(x) filter (y = 1) as m1, avg(x) filter (y <> 1) as m0, count_if(y = 1) as n1, count_if(y <> 1) as n0,
    var_pop(x) filter (y = 1) * n1 + var_pop(x) filter (y <> 1) * n0 as spread from train_values group by feature),
slopes as (select feature, case when spread > 0 then (m1 - m0) * (n1 + n0) / spread else 0 end as coef, (m1 + m0) / 2 as middle from moments)
select feature, coef from slopes union all select '(intercept)', -sum(coef * middle) from slopes"""

GOLD["scored_t"] = f"""
select company_id, as_of_date, churn_in_next_30d as label, 1 / (1 + exp(-({" + ".join(
    f"{c} * (select coef from coefficients_t where feature = '{c}')" for c in NUMERIC)}
  + coalesce(level.coef, 0) + (select coef from coefficients_t where feature = '(intercept)')))) as churn_probability
from gold_company_features_for_model left join coefficients_t level on level.feature = 'plan_type_' || plan_type
where as_of_date >= {FIXTURE_CUTOFF_SQL}"""

GOLD["score_summary"] = """
select s, pos, neg, n,
  sum(pos) over (order by s rows between unbounded preceding and current row) as pos_le,
  sum(neg) over (order by s rows between unbounded preceding and current row) as neg_le,
  sum(n) over (order by s rows between unbounded preceding and current row) as n_le,
  sum(pos) over () as total_pos, sum(neg) over () as total_neg
from (select churn_probability as s, sum(label) as pos, count(*) - sum(label) as neg, count(*) as n
      from heuristic_t where churn_probability is not null group by 1) g"""

GOLD["score_ge"] = """
select *, total_pos - pos_le + pos as pos_ge, total_neg - neg_le + neg as neg_ge, neg_le - neg as neg_lt
from score_summary"""

GOLD["revenue_at_risk_t"] = """
select p.company_id, p.as_of_date, p.churn_probability, m.mrr,
  cast(m.mrr as double) * p.churn_probability as revenue_at_risk
from heuristic_t p left join gold_company_mrr m
  on m.company_id = p.company_id and m.month_start = cast(date_trunc('month', p.as_of_date) as date)"""

GOLD["company_revenue_at_risk_t"] = """
select m.company_id, m.month_start, m.mrr, coalesce(p, 0) as churn_probability, coalesce(p, 0) * cast(m.mrr as double) as revenue_at_risk
from gold_company_mrr m left join (
  select distinct on (company_id, month_start) company_id, cast(date_trunc('month', as_of_date) as date) as month_start, churn_probability as p
  from revenue_at_risk_t order by as_of_date desc, churn_probability desc) using (company_id, month_start)"""

GOLD["company_risk_monitor_t"] = """
select r.company_id, r.month_start, f.plan_type, f.months_since_signup, f.logins_30d,
  f.failed_payments_60d, r.mrr, r.churn_probability, r.revenue_at_risk
from company_revenue_at_risk_t r
left join gold_company_features_for_model f
  on f.company_id = r.company_id and cast(date_trunc('month', f.as_of_date) as date) = r.month_start"""


def thresholds_sql(fractions) -> str:
    vals = ", ".join(f"(cast('{float(k)!r}' as double), cast('{float(1.0 - k)!r}' as double))"
                     for k in fractions)
    return f"""
ks as (select * from (values {vals}) t(k, q)),
h as (select k, q, cnt, cnt * q + (cast(1.0 as double) - q) - cast(1.0 as double) as h
      from ks cross join (select max(n_le) as cnt from score_summary) c),
h2 as (select k, h, floor(h) as r_lo, h - floor(h) as t, least(floor(h) + 1, cnt - 1) as r_hi from h),
thr as (select h2.k, case when t >= 0.5 then b.s - (b.s - a.s) * (cast(1.0 as double) - t)
                          else a.s + (b.s - a.s) * t end as threshold
        from h2 join score_summary a on h2.r_lo >= a.n_le - a.n and h2.r_lo < a.n_le
                join score_summary b on h2.r_hi >= b.n_le - b.n and h2.r_hi < b.n_le),
hit as (select k, threshold, sum(pos) as tp, sum(neg) as fp from thr
        join score_summary on s >= threshold group by 1, 2),
tot as (select max(total_pos) as P0, max(total_neg) as N0 from score_summary)"""


def topk_sql(fractions, cols: str) -> str:
    return f"""select {cols} from (with {thresholds_sql(fractions)},
rep as (select thr.k as top_fraction, thr.threshold,
  cast(coalesce(tp, 0) + coalesce(fp, 0) as bigint) as flagged,
  cast(coalesce(tp, 0) as bigint) as tp, cast(coalesce(fp, 0) as bigint) as fp,
  cast(P0 - coalesce(tp, 0) as bigint) as fn,
  round(coalesce(tp, 0) / (coalesce(tp, 0) + coalesce(fp, 0) + cast(1e-9 as double)), 6) as precision,
  round(coalesce(tp, 0) / (P0 + cast(1e-9 as double)), 6) as recall,
  round(cast(P0 as double) / cast(P0 + N0 as double), 6) as baseline_rate,
  round((coalesce(tp, 0) / (coalesce(tp, 0) + coalesce(fp, 0) + cast(1e-9 as double)))
        / (cast(P0 as double) / cast(P0 + N0 as double)), 6) as lift
  from thr cross join tot left join hit on hit.k = thr.k and hit.threshold = thr.threshold)
select * from rep) q"""

# --- single pieces (K3-K5, K16) and the B7 quarantine -------------------------
GOLD["gold_monthly_activity"] = f"""
select company_id, {first_day(month_no('activity_date'))} as month_start,
  cast(sum(total_events) as bigint) as total_events, cast(sum(login_count) as bigint) as total_logins,
  cast(sum(invites_sent) as bigint) as total_invites, cast(sum(files_uploaded) as bigint) as total_files,
  cast(sum(pages_created) as bigint) as total_pages_created, count(*) as active_days,
  max(active_users) as peak_daily_active_users
from gold_company_daily_activity group by all"""

for _t, _pk in [("companies", "company_id"), ("users", "user_id"), ("events", "event_id"),
                ("subscription_plans", "plan_id"), ("subscriptions", "subscription_id"),
                ("payments", "payment_id"), ("support_tickets", "ticket_id")]:
    SILVER[f"prefk_{_t}"] = _dedupe(_TYPED[_t], _pk, _SILVER_COLS[_t])
