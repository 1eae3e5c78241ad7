"""Hand-made edge cases (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from churnlens.operators.temporal import month_spine, spread_to_month_ends
from churnlens.plans import analytics, features, gold, risk
from helpers import D, PLANS, frame, ts

AS_OF = D(2024, 6, 15)


def _companies(spark, rows):
    return frame(spark, "companies", rows)


def test_spine_signup_after_as_of_and_null_signup(spark):
    c = _companies(spark, [{"company_id": "a", "signup_date": D(2024, 7, 1)},
                           {"company_id": "b", "signup_date": None},
                           {"company_id": "c", "signup_date": D(2024, 4, 30)}])
    rows = month_spine(c, AS_OF).orderBy("company_id", "month_start").collect()
    assert [(r.company_id, r.month_start) for r in rows] == [
        ("c", D(2024, 4, 1)), ("c", D(2024, 5, 1)), ("c", D(2024, 6, 1))]


def test_as_of_falls_back_per_source(spark):
    ev = frame(spark, "events", [])
    pay = frame(spark, "payments", [])
    subs = frame(spark, "subscriptions", [])
    assert gold.as_of_date(ev, pay, subs) == D(2000, 1, 1)
    pay = frame(spark, "payments", [{"payment_id": "x", "payment_date": D(2023, 3, 3)}])
    subs = frame(spark, "subscriptions", [{"subscription_id": "s", "start_date": D(2022, 1, 1),
                                           "end_date": D(2025, 1, 1)}])
    assert gold.as_of_date(ev, pay, subs) == D(2025, 1, 1)


def _user_day(spark, events, users):
    return gold.user_day_activity(frame(spark, "events", events), frame(spark, "users", users))


def test_window_30_and_60_day_bounds(spark):
    # month end 2024-05-31: 30 days before = 2024-05-01 (counted), 2024-04-30 not.
    users = [{"user_id": "u1", "company_id": "a"}, {"user_id": "u2", "company_id": "a"}]
    events = [{"event_id": "e1", "user_id": "u1", "event_type": "login",
               "event_timestamp": ts(2024, 5, 1)},
              {"event_id": "e2", "user_id": "u2", "event_type": "login",
               "event_timestamp": ts(2024, 4, 30)}]
    ud = _user_day(spark, events, users)
    ew = {(r.as_of_date, r.logins_30d, r.active_users_30d)
          for r in features.events_window(ud).collect()}
    assert (D(2024, 5, 31), 1, 1) in ew
    assert (D(2024, 4, 30), 1, 1) in ew  # e2 is on its own month end
    tk = frame(spark, "support_tickets", [
        {"ticket_id": "t1", "company_id": "a", "created_at": ts(2024, 4, 1)},   # 60 days before 5/31
        {"ticket_id": "t2", "company_id": "a", "created_at": ts(2024, 3, 31)}])  # 61 days
    sw = {r.as_of_date: r.tickets_60d for r in features.support_window(tk).collect()}
    assert sw[D(2024, 5, 31)] == 1


def test_leap_year_month_end(spark):
    df = spark.createDataFrame([(D(2024, 1, 30),), (D(2024, 1, 31),)], "d date")
    out = sorted((r.d, r.as_of_date) for r in spread_to_month_ends(df, "d", 30).collect())
    # 2024-01-30 + 30 = 2024-02-29 -> both Jan 31 and Feb 29 snapshots
    assert (D(2024, 1, 30), D(2024, 2, 29)) in out
    assert (D(2024, 1, 31), D(2024, 2, 29)) in out
    assert (D(2024, 1, 30), D(2024, 1, 31)) in out


def test_mrr_tie_break_dangling_plan_and_expired(spark):
    comp = _companies(spark, [{"company_id": "a", "signup_date": D(2024, 5, 1)},
                              {"company_id": "b", "signup_date": D(2024, 6, 1)},
                              {"company_id": "c", "signup_date": D(2024, 6, 1)}])
    subs = frame(spark, "subscriptions", [
        {"subscription_id": "s1", "company_id": "a", "plan_id": "p1", "start_date": D(2024, 5, 1),
         "status": "active"},
        {"subscription_id": "s2", "company_id": "a", "plan_id": "p2", "start_date": D(2024, 5, 1),
         "status": "active"},
        {"subscription_id": "s3", "company_id": "b", "plan_id": "p9", "start_date": D(2024, 6, 1),
         "status": "active"},
        {"subscription_id": "s4", "company_id": "c", "plan_id": "p1", "start_date": D(2024, 6, 1),
         "status": "expired"}])
    plans = frame(spark, "subscription_plans", PLANS)
    users = [{"user_id": "u1", "company_id": "a"}, {"user_id": "u2", "company_id": "b"}]
    events = [{"event_id": "e1", "user_id": "u1", "event_type": "login",
               "event_timestamp": ts(2024, 6, 2)},
              {"event_id": "e2", "user_id": "u2", "event_type": "login",
               "event_timestamp": ts(2024, 6, 2)}]
    ud = _user_day(spark, events, users)
    m = {(r.company_id, r.month_start): r
         for r in gold.company_mrr(comp, ud, subs, plans, AS_OF).collect()}
    assert m[("a", D(2024, 6, 1))].plan_id == "p2"            # higher subscription_id wins
    assert m[("a", D(2024, 6, 1))].mrr == Decimal("25.00")
    assert m[("a", D(2024, 5, 1))].mrr == 0                   # no active users in May
    assert m[("b", D(2024, 6, 1))].plan_name == "unknown"     # dangling plan id
    assert m[("b", D(2024, 6, 1))].mrr == 0
    assert m[("c", D(2024, 6, 1))].plan_id == "unknown"       # expired is not in the MRR list
    pa = {(r.company_id, r.as_of_date): r.plan_type
          for r in features.plan_asof(subs, plans, AS_OF).collect()}
    assert pa[("c", D(2024, 6, 30))] == "Basic"               # point in time: any status


def test_subscription_ending_inside_month(spark):
    subs = frame(spark, "subscriptions", [
        {"subscription_id": "s1", "company_id": "a", "plan_id": "p1", "start_date": D(2024, 3, 10),
         "end_date": D(2024, 5, 20), "status": "cancelled"}])
    plans = frame(spark, "subscription_plans", PLANS)
    mrr_months = {r.month_start for r in gold.mrr_plan_per_month(subs, plans, AS_OF).collect()}
    assert mrr_months == {D(2024, 3, 1), D(2024, 4, 1), D(2024, 5, 1)}
    pit = {r.as_of_date for r in features.plan_asof(subs, plans, AS_OF).collect()}
    assert pit == {D(2024, 3, 31), D(2024, 4, 30)}            # not May 31


def _label(spark, comp_rows, subs_rows, events, users, as_of=AS_OF):
    comp = _companies(spark, comp_rows)
    subs = frame(spark, "subscriptions", subs_rows)
    ud = _user_day(spark, events, users)
    return {r.company_id: r for r in gold.company_churn_label(comp, ud, subs, as_of).collect()}


def test_churn_label_rules(spark):
    comps = [{"company_id": k, "signup_date": D(2024, 1, 1)} for k in "abcde"]
    subs = [
        # a: cancelled then re-subscribed -> earliest cancel date
        {"subscription_id": "s1", "company_id": "a", "start_date": D(2024, 1, 1),
         "end_date": D(2024, 2, 1), "status": "cancelled"},
        {"subscription_id": "s2", "company_id": "a", "start_date": D(2024, 3, 1),
         "end_date": D(2024, 4, 1), "status": "cancelled"},
        {"subscription_id": "s3", "company_id": "a", "start_date": D(2024, 5, 1),
         "status": "active"},
        # b: cancelled with NULL end -> start date
        {"subscription_id": "s4", "company_id": "b", "start_date": D(2024, 2, 2),
         "status": "cancelled"},
        # d: active subscription on the as-of date
        {"subscription_id": "s5", "company_id": "d", "start_date": D(2024, 1, 1),
         "status": "active"}]
    users = [{"user_id": "uc", "company_id": "c"}, {"user_id": "ud", "company_id": "d"}]
    last = AS_OF - dt.timedelta(days=30)
    events = [{"event_id": "e1", "user_id": "uc", "event_type": "login",
               "event_timestamp": dt.datetime.combine(last, dt.time(9))},
              {"event_id": "e2", "user_id": "ud", "event_type": "login",
               "event_timestamp": dt.datetime.combine(last, dt.time(9))}]
    lab = _label(spark, comps, subs, events, users)
    assert lab["a"].churn_date == D(2024, 2, 1) and lab["a"].churn_reason == "cancelled"
    assert lab["b"].churn_date == D(2024, 2, 2)
    assert lab["c"].churn_reason == "inactive_30d" and lab["c"].churn_date == AS_OF
    assert lab["d"].churn_reason == "active" and lab["d"].churn_flag is False
    assert lab["e"].churn_reason == "active" and lab["e"].last_activity_date is None


def test_label_horizon(spark):
    comp = _companies(spark, [{"company_id": k, "signup_date": D(2024, 4, 1)} for k in "xyz"])
    lab = spark.createDataFrame(
        [("x", True, D(2024, 5, 31) + dt.timedelta(days=30)),
         ("y", True, D(2024, 5, 31) + dt.timedelta(days=31)),
         ("z", True, D(2024, 5, 31))], "company_id string, churn_flag boolean, churn_date date")
    empty = lambda t: frame(spark, t, [])
    ud = _user_day(spark, [], [])
    f = features.company_features(comp, ud, empty("support_tickets"), empty("payments"),
                                  empty("subscriptions"), frame(spark, "subscription_plans", PLANS),
                                  lab, AS_OF)
    got = {r.company_id: r.churn_in_next_30d for r in
           f.where(F.col("as_of_date") == F.lit(D(2024, 5, 31))).collect()}
    assert got == {"x": 1, "y": 0, "z": 0}


def test_funnel_bounds(spark):
    comp = _companies(spark, [{"company_id": k, "signup_date": D(2024, 1, 1),
                               "acquisition_channel": "ads"} for k in "abc"])
    daily = spark.createDataFrame([("a", D(2024, 1, 8)), ("b", D(2024, 1, 9))],
                                  "company_id string, activity_date date")
    subs = frame(spark, "subscriptions", [
        {"subscription_id": "s1", "company_id": "a", "start_date": D(2024, 1, 31)},
        {"subscription_id": "s2", "company_id": "b", "start_date": D(2024, 2, 1)}])
    f = {r.company_id: r for r in analytics.funnel_company(comp, daily, subs).collect()}
    assert f["a"].activated_7d and not f["b"].activated_7d and not f["c"].activated_7d
    assert f["a"].paid_30d and not f["b"].paid_30d
    assert f["a"].activation_stage == 1 and f["c"].paid_stage == 0


def test_ltv_keeps_negative_lifetime(spark):
    mrr = spark.createDataFrame([("a", D(2024, 3, 1), Decimal("10.00"))],
                                "company_id string, month_start date, mrr decimal(38,2)")
    lab = spark.createDataFrame([("a", True, D(2024, 1, 15))],
                                "company_id string, churn_flag boolean, churn_date date")
    r = analytics.company_ltv(mrr, lab, AS_OF).first()
    assert r.lifetime_months == -1 and r.ltv_est == -10.0


def test_revenue_at_risk_missing_and_duplicate_predictions(spark):
    mrr = spark.createDataFrame([("a", D(2024, 5, 1), Decimal("100.00")),
                                 ("a", D(2024, 6, 1), Decimal("100.00"))],
                                "company_id string, month_start date, mrr decimal(38,2)")
    preds = spark.createDataFrame([("a", D(2024, 6, 10), 0.2), ("a", D(2024, 6, 30), 0.5)],
                                  "company_id string, as_of_date date, churn_probability double")
    rar = risk.revenue_at_risk(preds, mrr)
    out = {r.month_start: r for r in risk.company_revenue_at_risk(mrr, rar).collect()}
    assert out[D(2024, 5, 1)].churn_probability == 0.0 and out[D(2024, 5, 1)].revenue_at_risk == 0
    assert out[D(2024, 6, 1)].churn_probability == 0.5                # latest snapshot wins
    assert abs(out[D(2024, 6, 1)].revenue_at_risk - 50.0) < 1e-9


def test_post_churn_filter_is_optional(spark):
    comp = _companies(spark, [{"company_id": "x", "signup_date": D(2024, 1, 1)}])
    lab = spark.createDataFrame([("x", True, D(2024, 3, 15))],
                                "company_id string, churn_flag boolean, churn_date date")
    empty = lambda t: frame(spark, t, [])
    args = (comp, _user_day(spark, [], []), empty("support_tickets"), empty("payments"),
            empty("subscriptions"), frame(spark, "subscription_plans", PLANS), lab, AS_OF)
    assert features.company_features(*args).count() == 6          # Jan..Jun kept
    kept = features.company_features(*args, drop_post_churn=True)
    assert sorted(r.as_of_date for r in kept.collect()) == [D(2024, 1, 31), D(2024, 2, 29)]
