"""Registry of named queries: Spark builder + DuckDB oracle SELECT.

Every query runs over the whole test tables (through the fixture adapter
and the silver/gold layers); nothing is sampled or capped except where a
LIMIT is the feature itself (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from . import oracle
from .functions import buckets as _bk
from .operators import quality as _q
from .plans import analytics as _an
from .plans import checks as _ck
from .plans import dashboards as _db
from .plans import evaluate as _ev
from .plans import features as _fe
from .plans import gold as _gd
from .plans import model as _md
from .plans import risk as _rk
from .plans import scoring as _sc
from .plans import silver as _sv
from .plans.warehouse import Warehouse
from .sources.schemas import FOREIGN_KEYS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def oracle_types(df: DataFrame) -> DataFrame:
    """Exact decimals become DOUBLE at the comparison boundary only."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _six_places(df: DataFrame, *cols: str) -> DataFrame:
    """Exact decimals rounded as the oracle rounds, for the comparison only."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols})


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return oracle_types(fn(Warehouse.for_testdata(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = oracle.with_ctes(sql)
        return fn
    return deco


def _silver_sql(t: str, cols: list[str], money: tuple = ()) -> str:
    sel = ", ".join(f"cast({c} as double) as {c}" if c in money else c for c in cols)
    return f"select {sel} from silver_{t}"


# -- silver ------------------------------------------------------------------
for _t, _money in [("companies", ()), ("users", ()), ("events", ()),
                   ("subscription_plans", ("price_per_user",)), ("subscriptions", ()),
                   ("payments", ("amount",)), ("support_tickets", ("resolution_time_hours",))]:
    register(f"silver_{_t}", _silver_sql(_t, oracle._SILVER_COLS[_t], _money))(
        lambda wh, _t=_t: wh.s(_t))

# -- gold core ---------------------------------------------------------------
register("gold_as_of_date", "select as_of_date from as_of_t")(
    lambda wh: _gd.as_of_frame(wh.s("events"), wh.s("payments"), wh.s("subscriptions")))

register("gold_company_daily_activity", """
select company_id, activity_date, cast(active_users as bigint) active_users,
  cast(login_count as bigint) login_count, cast(pages_created as bigint) pages_created,
  cast(files_uploaded as bigint) files_uploaded, cast(invites_sent as bigint) invites_sent,
  cast(total_events as bigint) total_events from gold_company_daily_activity""")(
    lambda wh: wh.daily_activity())

register("gold_company_monthly_metrics", "select * from gold_company_monthly_metrics")(
    lambda wh: wh.monthly_metrics())

register("gold_company_mrr", """
select company_id, month_start, plan_id, plan_name, cast(price_per_user as double) price_per_user,
  active_user_count, cast(mrr as double) mrr from gold_company_mrr""")(
    lambda wh: wh.company_mrr())

register("gold_company_churn_label", "select * from gold_company_churn_label")(
    lambda wh: wh.churn_label())

# -- analytics layer ---------------------------------------------------------

register("gold_funnel_company", "select * from gold_funnel_company")(lambda wh: wh.funnel())

register("funnel_by_channel", """
select acquisition_channel, count(*) as signups,
  cast(sum(cast(activated_7d as int)) as bigint) as activated,
  cast(sum(cast(paid_30d as int)) as bigint) as paid,
  round(cast(sum(cast(activated_7d as int)) as double) / count(*), 4) as activation_rate,
  round(cast(sum(cast(paid_30d as int)) as double) / count(*), 4) as paid_rate
from gold_funnel_company group by 1""")(lambda wh: _an.funnel_by_channel(wh.funnel()))

register("gold_retention_company_cohorts", "select * from gold_retention_company_cohorts")(
    lambda wh: wh.retention())

register("gold_mrr_trend_breakdown", "select * from gold_mrr_trend_breakdown")(
    lambda wh: _six_places(wh.mrr_trend(), "avg_mrr_per_company"))

register("gold_company_ltv", "select * from gold_company_ltv")(
    lambda wh: _six_places(wh.ltv(), "avg_mrr_lifetime", "ltv_est"))

register("gold_company_revenue_at_risk_skeleton", """
select company_id, month_start, cast(mrr as double) as mrr,
  cast(null as double) as churn_probability, cast(null as double) as revenue_at_risk
from gold_company_mrr""")(lambda wh: _an.revenue_at_risk_skeleton(wh.company_mrr()))

# -- features ----------------------------------------------------------------
register("gold_company_features_for_model", "select * from gold_company_features_for_model")(
    lambda wh: wh.features())

# -- data-quality checks -----------------------------------------------------


def _gold_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {"company_daily_activity": wh.daily_activity(),
            "company_monthly_metrics": wh.monthly_metrics(), "company_mrr": wh.company_mrr(),
            "company_churn_label": wh.churn_label(), "funnel_company": wh.funnel(),
            "company_ltv": wh.ltv(), "company_features_for_model": wh.features()}


def _pk_sql(table: str, src: str, pk: list[str]) -> str:
    k = ", ".join(pk)
    nulls = " or ".join(f"{c} is null" for c in pk)
    return (f"select '{table}' as table_name, cast(coalesce(sum(n), 0) as bigint) as rows, "
            f"count(*) filter (where n > 1) as duplicate_keys, "
            f"cast(coalesce(sum(case when has_null = 1 then n end), 0) as bigint) as null_key_rows "
            f"from (select {k}, count(*) n, max(case when {nulls} then 1 else 0 end) has_null "
            f"from {src} group by {k}) g")


def _pk_all_sql() -> str:
    from .sources.schemas import PRIMARY_KEYS
    parts = [_pk_sql(f"typed.{t}", f"({oracle._TYPED[t]}) y", pk) for t, pk in PRIMARY_KEYS.items()]
    parts += [_pk_sql(f"silver.{t}", f"silver_{t}", pk) for t, pk in PRIMARY_KEYS.items()]
    parts += [_pk_sql(f"gold.{t}", f"gold_{t}", pk) for t, pk in _ck.GOLD_KEYS.items()]
    return "\nunion all\n".join(parts)


register("dq_primary_keys", _pk_all_sql())(
    lambda wh: _ck.primary_keys(wh.silver(), _gold_tables(wh), wh.silver_flagged()))


def _fk_sql() -> str:
    from .sources.schemas import FOREIGN_KEYS
    return "\nunion all\n".join(
        f"select 'orphan_{c}.{fk}' as check_name, count(*) as bad_rows from silver_{c} x "
        f"left join silver_{p} y on y.{pk} = x.{fk} where y.{pk} is null"
        for c, fk, p, pk in FOREIGN_KEYS)


register("dq_foreign_keys", _fk_sql())(lambda wh: _ck.foreign_keys(wh.silver()))

register("dq_sanity_checks", """
select 'null_company_id' as check_name, count(*) filter (where company_id is null) as bad_rows from silver_companies
union all select 'null_company_name', count(*) filter (where company_name is null) from silver_companies
union all select 'null_churn_flag', count(*) filter (where churn_flag is null) from gold_company_churn_label
union all select 'negative_mrr', count(*) filter (where mrr < 0) from gold_company_mrr
union all select 'negative_active_user_count', count(*) filter (where active_user_count < 0) from gold_company_mrr
union all select 'negative_price_per_user', count(*) filter (where price_per_user < 0) from gold_company_mrr
union all select 'churned_without_date', count(*) filter (where churn_flag = true and churn_date is null) from gold_company_churn_label
union all select 'not_churned_with_date', count(*) filter (where churn_flag = false and churn_date is not null) from gold_company_churn_label
union all select 'churned_without_reason', count(*) filter (where churn_flag = true and (churn_reason is null or churn_reason = '')) from gold_company_churn_label
union all select 'negative_daily_activity', count(*) filter (where active_users < 0 or total_events < 0) from gold_company_daily_activity
union all select 'monthly_null_month', count(*) filter (where month_start is null) from gold_company_monthly_metrics
union all select 'monthly_events_without_users', count(*) filter (where active_users_monthly = 0 and total_events > 0) from gold_company_monthly_metrics
union all select 'label_leakage', count_if(churn_in_next_30d > 0 and f.as_of_date - churn_date >= 0)
  from gold_company_churn_label l join gold_company_features_for_model f using (company_id)""")(
    lambda wh: _ck.sanity_checks(wh.s("companies"), wh.churn_label(), wh.company_mrr(),
                                 wh.daily_activity(), wh.monthly_metrics(), wh.features()))

register("dq_row_counts", """
select 'company_daily_activity' as table_name, count(*) as rows from gold_company_daily_activity
union all select 'company_monthly_metrics', count(*) from gold_company_monthly_metrics
union all select 'company_mrr', count(*) from gold_company_mrr
union all select 'company_features_for_model', count(*) from gold_company_features_for_model""")(
    lambda wh: _ck.row_counts({"company_daily_activity": wh.daily_activity(),
                               "company_monthly_metrics": wh.monthly_metrics(),
                               "company_mrr": wh.company_mrr(),
                               "company_features_for_model": wh.features()}))

register("dq_latest_daily_activity", """
select company_id, activity_date, cast(active_users as bigint) active_users,
  cast(login_count as bigint) login_count, cast(pages_created as bigint) pages_created,
  cast(files_uploaded as bigint) files_uploaded, cast(invites_sent as bigint) invites_sent,
  cast(total_events as bigint) total_events
from gold_company_daily_activity order by activity_date desc, company_id asc limit 10""")(
    lambda wh: _ck.latest_daily_activity(wh.daily_activity()))

register("dq_mrr_summary", """
select min(month_start) as min_month, max(month_start) as max_month,
  cast(sum(mrr) as double) as total_mrr from gold_company_mrr""")(
    lambda wh: _ck.mrr_summary(wh.company_mrr()))

register("dq_churn_reason_distribution", """
select churn_reason, count(*) as companies from gold_company_churn_label group by 1""")(
    lambda wh: _ck.churn_reason_distribution(wh.churn_label()))

register("dq_tenure_range", """
select min(months_since_signup) as min_m, max(months_since_signup) as max_m
from gold_company_features_for_model""")(lambda wh: _ck.tenure_range(wh.features()))

register("dq_tenure_histogram", """
select months_since_signup, count(*) as snapshots from gold_company_features_for_model
group by 1""")(lambda wh: _ck.tenure_histogram(wh.features()))

# -- model: split, evaluation, predictions -----------------------------------

register("model_split_counts", f"""
select case when as_of_date < {oracle.FIXTURE_CUTOFF_SQL} then 'train' else 'test' end as split,
  count(*) as rows, cast(sum(churn_in_next_30d) as bigint) as churners
from gold_company_features_for_model where as_of_date is not null group by 1""")(
    lambda wh: _md.split_counts(_md.model_input(wh.features()), wh.cutoff))


def _summary(wh: Warehouse, source: str = "heuristic") -> DataFrame:
    """Distinct-score summary, written once: every metric reads it several
    times (rank lookups, hits, totals)."""
    scored = wh.heuristic() if source == "heuristic" else wh.scored_test()
    return wh.table(f"gold/_score_summary_{source}", lambda: _ev.score_summary(
        scored, "churn_probability", "label"))


register("eval_roc_auc_average_precision", """
select round(cast(sum(cast(pos as hugeint) * (2 * neg_lt + neg)) as double)
             / (cast(max(total_pos) as double) * cast(max(total_neg) as double) * 2.0), 6) as roc_auc,
  round(sum(cast(pos as double) * (cast(pos_ge as double) / cast(pos_ge + neg_ge as double)))
        / cast(max(total_pos) as double), 6) as average_precision,
  cast(max(total_pos) as bigint) as positives, cast(max(total_neg) as bigint) as negatives
from score_ge""")(lambda wh: _ev.auc_ap(_summary(wh)))

register("eval_roc_curve", """
select s as threshold, round(cast(neg_ge as double) / cast(total_neg as double), 6) as fpr,
  round(cast(pos_ge as double) / cast(total_pos as double), 6) as tpr from score_ge""")(
    lambda wh: _ev.roc_curve(_summary(wh)))

register("eval_top_k", oracle.topk_sql(
    _ev.TOP_K_FRACTIONS, "top_fraction, threshold, flagged, tp, fp, fn, precision, recall, "
    "baseline_rate, lift"))(lambda wh: _ev.top_k_report(_summary(wh)))

register("eval_precision_curve", oracle.topk_sql(
    _ev.PRECISION_CURVE_POINTS, "top_fraction, threshold, flagged, precision"))(
    lambda wh: _ev.precision_curve(_summary(wh)))

register("eval_score_histogram", """
with x as (select churn_probability as s, cast(label as int) as y from heuristic_t),
rng0 as (select y, min(s) as mn0, max(s) as mx0 from x group by 1),
rng as (select y, case when mn0 = mx0 then mn0 - 0.5 else mn0 end as mn,
               case when mn0 = mx0 then mx0 + 0.5 else mx0 end as mx from rng0),
c as (select x.y, cast(least(floor((x.s - rng.mn) / (rng.mx - rng.mn) * 50), 49) as int) as bin,
             count(*) as cnt from x join rng on rng.y = x.y group by 1, 2),
grid as (select rng.*, cast(b.bin as int) as bin from rng cross join range(50) b(bin))
select grid.y as label, grid.bin,
  round(mn + (mx - mn) / 50 * grid.bin, 6) as bin_lo,
  round(mn + (mx - mn) / 50 * (grid.bin + 1), 6) as bin_hi,
  cast(coalesce(c.cnt, 0) as bigint) as count
from grid left join c on c.y = grid.y and c.bin = grid.bin""")(
    lambda wh: _ev.score_histogram(wh.heuristic(), "churn_probability", "label"))

register("heuristic_scores", """
select company_id, as_of_date, label, churn_probability from heuristic_t""")(
    lambda wh: wh.heuristic())

# MLlib fit: iterative optimisation, no SQL equivalent -> rows-only checks.
register("gold_company_churn_predictions")(lambda wh: wh.predictions())
register("model_coefficients")(lambda wh: _md.coefficients(wh.model()[0]))
register("model_top_coefficients")(lambda wh: _md.coefficients(wh.model()[0], 10))
register("model_evaluation")(lambda wh: _ev.auc_ap(_summary(wh, "model")))
register("model_top_k")(lambda wh: _ev.top_k_report(_summary(wh, "model")))
register("gold_company_risk_monitor")(lambda wh: wh.risk_monitor("model"))

# -- revenue at risk (heuristic scores: exact SQL check of the same builders) -
register("gold_revenue_at_risk", """
select company_id, as_of_date, churn_probability, cast(mrr as double) as mrr, revenue_at_risk
from revenue_at_risk_t""")(lambda wh: wh.revenue_at_risk("heuristic"))

register("gold_company_revenue_at_risk", """
select company_id, month_start, cast(mrr as double) as mrr, churn_probability, revenue_at_risk
from company_revenue_at_risk_t""")(lambda wh: wh.company_revenue_at_risk("heuristic"))

register("risk_companies_per_month", """
select month_start, count(distinct company_id) as companies from company_revenue_at_risk_t
group by 1""")(lambda wh: _rk.companies_per_month(wh.company_revenue_at_risk("heuristic")))

register("gold_company_risk_monitor_heuristic", """
select company_id, month_start, plan_type, months_since_signup, logins_30d, failed_payments_60d,
  cast(mrr as double) as mrr, churn_probability, revenue_at_risk from company_risk_monitor_t""")(
    lambda wh: wh.risk_monitor("heuristic"))


# -- files in and out: written as CSV and read back ---------------------------
register("ingest_events_csv", """
select event_id, user_id, case when event_id like '%-4' then event_type || chr(10) || '"' || event_id || '", again'
  else event_type end as event_type, event_timestamp from raw_events""")(lambda wh: wh.ingested_events())

register("export_company_risk_monitor", """
select company_id, month_start, plan_type, months_since_signup, logins_30d, failed_payments_60d,
  cast(mrr as double) as mrr, churn_probability, revenue_at_risk from company_risk_monitor_t""")(
    lambda wh: wh.exported_monitor("heuristic"))


# -- dashboards over the monitor ---------------------------------------------
def _mon(wh: Warehouse) -> DataFrame:
    return wh.risk_monitor("heuristic")


_M = "cast(sum(cast({c} as decimal(38,10))) as double)"


def _exp_sql(keys: str, src: str) -> str:
    return (f"select {keys}, count(*) as companies, round({_M.format(c='mrr')}, 6) as total_mrr, "
            f"round({_M.format(c='revenue_at_risk')}, 6) as revenue_at_risk from ({src}) x "
            f"group by {keys}")


register("dash_executive_overview", f"""
select month_start, count(*) as companies, round({_M.format(c='mrr')}, 6) as total_mrr,
  round({_M.format(c='revenue_at_risk')}, 6) as revenue_at_risk,
  round({_M.format(c='revenue_at_risk')} * 100.0 / nullif({_M.format(c='mrr')}, 0.0), 6)
    as pct_mrr_exposed
from company_risk_monitor_t group by 1""")(lambda wh: _db.executive_overview(_mon(wh)))

register("dash_risk_distribution", _exp_sql(
    "month_start, risk_bin",
    "select *, cast(least(floor(churn_probability * 10), 9) as int) as risk_bin "
    "from company_risk_monitor_t"))(lambda wh: _db.risk_distribution(_mon(wh)))

register("dash_risk_vs_engagement", """
select company_id, month_start, logins_30d, churn_probability, cast(mrr as double) as mrr
from company_risk_monitor_t""")(lambda wh: _db.risk_vs_engagement(_mon(wh)))

register("dash_by_usage_tier", _exp_sql(
    "month_start, usage_tier",
    f"select *, {_bk.bucket_sql('logins_30d', _bk.ENGAGEMENT_EDGES)} as usage_tier "
    f"from company_risk_monitor_t"))(lambda wh: _db.by_usage_tier(_mon(wh)))

register("dash_by_tenure", _exp_sql(
    "month_start, tenure_bucket",
    f"select *, {_bk.bucket_sql('months_since_signup', _bk.TENURE_EDGES)} as tenure_bucket "
    f"from company_risk_monitor_t"))(lambda wh: _db.by_tenure(_mon(wh)))

register("dash_by_plan", _exp_sql("month_start, plan_type", "select * from company_risk_monitor_t"))(
    lambda wh: _db.by_plan(_mon(wh)))

register("dash_by_segment", _exp_sql("month_start, segment, segment_value", " union all ".join(
    f"select m.month_start, m.mrr, m.revenue_at_risk, '{s}' as segment, "
    f"cast(c.{s} as varchar) as segment_value from company_risk_monitor_t m "
    f"left join silver_companies c on c.company_id = m.company_id" for s in _db.SEGMENTS)))(
    lambda wh: _db.by_segment(_mon(wh), wh.s("companies")))

register("dash_outreach_ranking", f"""
select month_start, rank, company_id, plan_type, cast(mrr as double) as mrr, churn_probability,
  revenue_at_risk from (
  select *, cast(row_number() over (partition by month_start
              order by revenue_at_risk desc, company_id asc) as int) as rank
  from company_risk_monitor_t) r where rank <= {_db.OUTREACH_TOP_K}""")(
    lambda wh: _db.outreach_ranking(_mon(wh)))

register("dash_portfolio_grid", _exp_sql(
    "month_start, mrr_band, risk_band",
    f"select *, {_bk.bucket_sql('cast(mrr as double)', _bk.MRR_BAND_EDGES)} as mrr_band, "
    f"{_bk.bucket_sql('churn_probability', _bk.RISK_BAND_EDGES)} as risk_band "
    f"from company_risk_monitor_t"))(lambda wh: _db.portfolio_grid(_mon(wh)))

# -- single pieces: K3-K5, K16, B7 quarantine --------------------------------

register("gold_monthly_activity", "select * from gold_monthly_activity")(
    lambda wh: _gd.monthly_activity(wh.daily_activity()))

register("gold_monthly_active_users", "select * from mau_t")(lambda wh: wh.mau())

register("gold_monthly_tickets", """
select company_id, cast(date_trunc('month', created_at) as date) as month_start,
  count(*) as tickets_count from silver_support_tickets group by 1, 2""")(
    lambda wh: _gd.monthly_tickets(wh.s("support_tickets")))

register("gold_monthly_failed_payments", """
select company_id, cast(date_trunc('month', payment_date) as date) as month_start,
  count(*) filter (where payment_status in ('failed','declined')) as failed_payments
from silver_payments group by 1, 2""")(lambda wh: _gd.monthly_failed_payments(wh.s("payments")))


def _spine(wh: Warehouse) -> DataFrame:
    return _fe.snapshot_spine(wh.s("companies"), wh.as_of())


def _on_snapshots(source: str, cols: list[str]) -> str:
    return (f"select company_id, as_of_date, {', '.join(f'coalesce({x}, 0) as {x}' for x in cols)} "
            f"from snapshots left join {source} using (company_id, as_of_date)")


_USAGE = ["active_users_30d", "logins_30d", "invites_30d", "uploads_30d"]

register("feature_events_window", _on_snapshots("usage_30d", _USAGE))(
    lambda wh: _fe.on_spine(_spine(wh), _fe.events_window(wh.user_day()), _USAGE))

register("feature_support_window", _on_snapshots("tickets_t", ["tickets_60d"]))(
    lambda wh: _fe.on_spine(_spine(wh), _fe.support_window(wh.s("support_tickets")), ["tickets_60d"]))

register("feature_payment_window", _on_snapshots("failures_t", ["failed_payments_60d"]))(
    lambda wh: _fe.on_spine(_spine(wh), _fe.payment_window(wh.s("payments")), ["failed_payments_60d"]))

register("feature_days_to_first_invite", "select company_id, days_to_first_invite from invited")(
    lambda wh: _fe.days_to_first_invite(wh.s("companies"), wh.user_day()))

register("feature_plan_asof", "select * from plan_at_end")(
    lambda wh: _spine(wh).join(_fe.plan_asof(wh.s("subscriptions"), wh.s("subscription_plans"),
                                             wh.as_of()), _fe.KEYS, "left")
    .select(*_fe.KEYS, F.coalesce("plan_type", F.lit("unknown")).alias("plan_type")))


def _quarantine(wh: Warehouse) -> DataFrame:
    """Rows each FK check dropped, per relationship."""
    return _sv.quarantine_counts(wh.silver_flagged())


register("dq_orphans_quarantined", "\nunion all\n".join(
    f"select '{c}.{fk}' as relationship, count(*) as quarantined_rows from prefk_{c} x "
    f"where x.{fk} is not null and x.{fk} not in (select {pk} from silver_{p})"
    for c, rels in _sv.FK_PARENTS.items() for fk, p, pk in rels))(_quarantine)


register("dq_foreign_keys_typed", "\nunion all\n".join(
    f"select 'orphan_typed.{c}.{fk}' as check_name, count(*) as bad_rows from ({oracle._TYPED[c]}) x "
    f"where {fk} is null or {fk} not in (select {pk} from ({oracle._TYPED[p]}) where {pk} is not null)"
    for c, fk, p, pk in FOREIGN_KEYS))(lambda wh: _ck.foreign_keys(_sv.typed_tables(wh.raw()), "typed."))


def _rejected_sql() -> str:
    parts = []
    for t in _sv.BUILD_ORDER:
        key = oracle._PK[t]
        kept = f"(select count(*) from prefk_{t})"
        reasons = {"null_key": f"count_if(nullif(trim({key}), '') is null)",
                   "duplicate": f"count_if(nullif(trim({key}), '') is not null) - {kept}"}
        for c in _sv.PARSED.get(t, []):
            reasons[f"unparsed_{c}"] = (f"count_if(nullif(trim({c}), '') is not null) - "
                                        f"(select count({c}) from ({oracle._TYPED[t]}))")
        for fk, parent, pk in _sv.FK_PARENTS.get(t, []):
            reasons[f"orphan_{fk}"] = (f"any_value((select count(*) from prefk_{t} where {fk} is not null "
                                       f"and {fk} not in (select {pk} from silver_{parent})))")
        parts += [f"select '{t}' as table_name, '{k}' as reason, cast({v} as bigint) as rows from raw_{t}"
                  for k, v in reasons.items()]
    return "\nunion all\n".join(parts)


register("dq_rejected_rows", _rejected_sql())(
    lambda wh: _sv.rejected_rows(wh.silver_flagged()))


# -- H2: violator samples (L9-L12 row forms) ---------------------------------
register("dq_negative_mrr_rows", """
select company_id, month_start, plan_id, plan_name, cast(price_per_user as double) price_per_user,
  active_user_count, cast(mrr as double) mrr from gold_company_mrr
where mrr < 0 or active_user_count < 0 or price_per_user < 0
order by company_id, month_start limit 50""")(
    lambda wh: _ck.sample_violations(
        wh.company_mrr(), (F.col("mrr") < 0) | (F.col("active_user_count") < 0)
        | (F.col("price_per_user") < 0), ["company_id", "month_start"]))

register("dq_churned_without_date_rows", """
select * from gold_company_churn_label where churn_flag = true and churn_date is null
order by company_id limit 50""")(
    lambda wh: _ck.sample_violations(
        wh.churn_label(), (F.col("churn_flag") == F.lit(True)) & F.col("churn_date").isNull(),
        ["company_id"]))

register("dq_label_leakage_rows", """
select company_id, f.as_of_date, churn_date from gold_company_churn_label l join gold_company_features_for_model f using (company_id)
where churn_in_next_30d > 0 and f.as_of_date - churn_date >= 0 order by 1, 2 limit 50""")(
    lambda wh: _ck.sample_violations(
        wh.features().where(F.col("churn_in_next_30d") == 1).select("company_id", "as_of_date")
        .join(wh.churn_label().select("company_id", "churn_date"), "company_id"),
        F.col("churn_date") <= F.col("as_of_date"), ["company_id", "as_of_date"]))

register("dq_negative_daily_rows", """
select company_id, activity_date, active_users, total_events from gold_company_daily_activity
where least(active_users, total_events) < 0 order by 1, 2 limit 50""")(
    lambda wh: _ck.sample_violations(
        wh.daily_activity().select("company_id", "activity_date", "active_users", "total_events"),
        (F.col("active_users") < 0) | (F.col("total_events") < 0), ["company_id", "activity_date"]))

register("dq_null_month_rows", """
select * from gold_company_monthly_metrics where month_start is null order by company_id limit 50""")(
    lambda wh: _ck.sample_violations(wh.monthly_metrics(), F.col("month_start").isNull(), ["company_id"]))

register("dq_events_without_users_rows", """
select * from gold_company_monthly_metrics where active_users_monthly = 0 and total_events > 0
order by company_id, month_start limit 50""")(
    lambda wh: _ck.sample_violations(
        wh.monthly_metrics(), (F.col("active_users_monthly") == 0) & (F.col("total_events") > 0),
        ["company_id", "month_start"]))

# -- the model's path, as far as SQL can tell what must hold -------------------
_TRAIN = f"gold_company_features_for_model where as_of_date < {oracle.FIXTURE_CUTOFF_SQL}"

register("model_imputer_statistics", f"""
select median(days_to_first_invite) as median_days_to_first_invite,
  (select plan_type from {_TRAIN} group by plan_type order by count(*) desc, plan_type limit 1) as most_frequent_plan
from {_TRAIN}""")(lambda wh: _md.imputer_statistics(wh.features(), wh.cutoff))

register("model_training_summary", f"""
select count(*) as rows, cast(sum(churn_in_next_30d) as bigint) as positives,
  round(count(*) / (2.0 * sum(churn_in_next_30d)), 6) as weight_positive,
  round(count(*) / (2.0 * (count(*) - sum(churn_in_next_30d))), 6) as weight_negative
from {_TRAIN}""")(lambda wh: _md.training_summary(wh.features(), wh.cutoff))

register("model_monitor_by_month", f"""
select month_start, count(*) as rows, round(cast(sum(mrr) as double), 2) as total_mrr,
  count_if(last_day(month_start) >= {oracle.FIXTURE_CUTOFF_SQL}) as predicted_rows,
  cast(0 as bigint) as outside_0_1, cast(0 as bigint) as wrong_products
from gold_company_mrr group by month_start""")(
    lambda wh: _rk.monitor_by_month(wh.risk_monitor("model")))

register("model_input", f"""
select company_id, as_of_date, {", ".join(oracle.NUMERIC)}, days_to_first_invite, plan_type, churn_in_next_30d
from gold_company_features_for_model where as_of_date is not null""")(lambda wh: _md.model_input(wh.features()))

register("model_discriminant_coefficients", "select feature, round(coef, 6) as coef from coefficients_t")(
    lambda wh: wh.coefficients().withColumn("coef", F.round("coef", 6)))

register("model_discriminant_top_coefficients", """
select feature, round(coef, 6) as coef from coefficients_t where feature <> '(intercept)'
order by coefficients_t.coef desc, feature limit 10""")(
    lambda wh: _sc.largest(wh.coefficients()).withColumn("coef", F.round("coef", 6)))

register("model_discriminant_predictions", """
select company_id, as_of_date, label, round(churn_probability, 6) as churn_probability from scored_t""")(
    lambda wh: wh.scored().withColumn("churn_probability", F.round("churn_probability", 6)))

register("model_fit_residuals", f"""
select unnest({oracle.NUMERIC + ["(intercept)"]!r}) as feature, true as within_tolerance
union all select distinct 'plan_type_' || plan_type, true from {_TRAIN}""")(
    lambda wh: wh.fit_residuals().select("feature", "within_tolerance"))

# -- L7 / L8 in their counter form (F8) ---------------------------------------

register("dq_company_critical_nulls", """
select count(*) filter (where company_id is null) as null_company_id,
  count(*) filter (where company_name is null) as null_company_name, count(*) as total
from silver_companies""")(lambda wh: _q.null_counts(wh.s("companies"), ["company_id", "company_name"]))

register("dq_churn_flag_completeness", """
select count(*) filter (where churn_flag is null) as null_churn_flag, count(*) as total
from gold_company_churn_label""")(lambda wh: _q.null_counts(wh.churn_label(), ["churn_flag"]))
