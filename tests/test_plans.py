"""Plan-shape guards for the properties the design relies on at scale."""

import re

import pytest

from churnlens.plans import features, gold, risk
from churnlens.plans.warehouse import Warehouse
from conftest import SMOKE_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    w = Warehouse.for_testdata(spark, SMOKE_DIR)
    w.churn_label()
    return w


def test_events_are_reduced_before_the_first_shuffle(wh):
    p = plan(gold.user_day_activity(wh.s("events"), wh.s("users")))
    lines = p.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line)
    partial = next(i for i, line in enumerate(lines) if "partial_count" in line)
    assert partial > ex  # printed below = runs before the exchange (map side)


def test_gold_builders_have_no_nested_loop_or_cartesian(wh):
    a = wh.as_of()
    frames = [
        gold.company_mrr(wh.s("companies"), wh.user_day(), wh.s("subscriptions"),
                         wh.s("subscription_plans"), a),
        gold.company_monthly_metrics(wh.s("companies"), wh.user_day(), wh.s("support_tickets"),
                                     wh.s("payments"), a),
        gold.company_churn_label(wh.s("companies"), wh.user_day(), wh.s("subscriptions"), a),
        features.company_features(wh.s("companies"), wh.user_day(), wh.s("support_tickets"),
                                  wh.s("payments"), wh.s("subscriptions"),
                                  wh.s("subscription_plans"), wh.churn_label(), a),
    ]
    for f in frames:
        p = plan(f)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_latest_prediction_uses_partial_group_limit(wh):
    p = plan(risk.latest_prediction_per_month(wh.revenue_at_risk("heuristic")))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scans_read_only_needed_columns(wh):
    p = plan(features.events_window(wh.user_day()))
    scan = [line for line in p.splitlines() if "FileScan" in line][0]
    assert "n_page" not in scan and "n_events" not in scan and "n_login" in scan


def test_dedupe_combines_before_the_shuffle(spark):
    from churnlens.operators.clean import dedupe_by_key
    df = spark.range(100).selectExpr("cast(id % 7 as string) as k", "id as v")
    lines = plan(dedupe_by_key(df, ["k"])).splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
    assert any("WindowGroupLimit" in line for line in lines[ex + 1:])  # map-side top-1


def test_one_silver_table_builds_its_parents_only(spark):
    w = Warehouse.for_testdata(spark, SMOKE_DIR, partition_months=False)
    assert w.s("companies").count() > 0
    assert {k for k in w._memo if k.startswith("silver")} == {"silver/companies"}
    w.s("payments")
    assert {k for k in w._memo if k.startswith("silver")} == {"silver/companies", "silver/payments"}


def test_segments_are_summed_before_they_are_expanded(wh):
    from churnlens.plans import dashboards
    p = plan(dashboards.by_segment(wh.risk_monitor("heuristic"), wh.s("companies")))
    expand = next(i for i, line in enumerate(p.splitlines()) if "Generate" in line or "Expand" in line)
    assert sum("HashAggregate" in line for line in p.splitlines()[expand:]) >= 2  # printed below = runs before


def test_month_tables_neither_sort_nor_broadcast_months(wh):
    """Company-month facts meet the spine in hash joins, whatever their files' sizes; plans are picked without a sort of months."""
    a = wh.as_of()
    monthly = gold.company_monthly_metrics(wh.s("companies"), wh.user_day(), wh.s("support_tickets"), wh.s("payments"), a)
    feats = features.company_features(wh.s("companies"), wh.user_day(), wh.s("support_tickets"), wh.s("payments"),
                                      wh.s("subscriptions"), wh.s("subscription_plans"), wh.churn_label(), a)
    rar = risk.revenue_at_risk(wh.heuristic().select("company_id", "as_of_date", "churn_probability"), wh.company_mrr())
    monitor = risk.company_risk_monitor(wh.company_revenue_at_risk("heuristic"), wh.features())
    for frame, joins in ((monthly, 4), (feats, 4), (rar, 1), (monitor, 1)):
        p = plan(frame)
        assert p.count("ShuffledHashJoin [company_id") >= joins
        assert "SortMergeJoin" not in p
    assert "SortAggregate" not in plan(features.plan_asof(wh.s("subscriptions"), wh.s("subscription_plans"), a))


def test_spine_months_are_not_shuffled(wh):
    """F3 (dq_primary_keys): no table of company-months moves its spine or groups the months of plans."""
    a = wh.as_of()
    subs, plans, comp = wh.s("subscriptions"), wh.s("subscription_plans"), wh.s("companies")
    frames = [gold.company_mrr(comp, wh.user_day(), subs, plans, a, mau=wh.mau()),
              gold.company_monthly_metrics(comp, wh.user_day(), wh.s("support_tickets"), wh.s("payments"), a),
              features.company_features(comp, wh.user_day(), wh.s("support_tickets"), wh.s("payments"), subs, plans,
                                        wh.churn_label(), a)]
    for f in frames:
        lines = plan(f).splitlines()
        spine = max(i for i, line in enumerate(lines) if "Generate explode" in line and "month_start" in line)
        assert not any("Exchange hashpartitioning" in line for line in lines[:spine])  # printed above = runs after


def test_months_look_up_their_own_facts(spark):
    """A company without facts, facts of no company or month, a month before signup: as left joins on both keys."""
    import datetime as dt
    from churnlens.operators.temporal import month_spine, spine_with_months
    d = dt.date
    comp = spark.createDataFrame([("a", d(2020, 1, 9)), ("b", d(2020, 2, 1)), ("b", d(2020, 3, 1)), (None, d(2020, 3, 3)),
                                  ("c", None)], "company_id string, signup_date date")
    one = spark.createDataFrame([("a", d(2020, 2, 1), 5, None), ("a", d(2019, 12, 1), 6, 1), ("b", d(2020, 3, 1), 7, 2),
                                 (None, d(2020, 3, 1), 8, 3), ("a", None, 9, 4)],
                                "company_id string, month_start date, x int, y int")
    two = spark.createDataFrame([("b", d(2020, 2, 1), 1)], "company_id string, month_start date, z int")
    keys = ["company_id", "month_start"]
    want = month_spine(comp, d(2020, 4, 4)).join(one, keys, "left").join(two, keys, "left")
    got = spine_with_months(comp, d(2020, 4, 4), [one, two]).drop("as_of_date")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 11


def test_monitor_is_made_where_its_months_are(spark):
    """the first query of a monitor writes no company-months and moves none; the next one writes them."""
    import datetime as dt
    from churnlens.sources import fixtures
    w = Warehouse(spark, lambda: fixtures.raw_tables(spark, SMOKE_DIR), cutoff=dt.date(2000, 1, 1))
    first = w.next_query().risk_monitor("heuristic")
    p = plan(first)
    moved = re.findall(r"Exchange hashpartitioning\(company_id#\d+, (?:month_start|as_of_date)", p)
    assert len(moved) <= 1  # written predictions, by month
    months = {"gold/company_mrr", "gold/company_features_for_model", "gold/company_risk_monitor_heuristic"}
    assert p.count("ShuffledHashJoin") >= 4 and not months & set(w._memo)
    again = w.next_query().risk_monitor("heuristic")
    assert "gold/company_risk_monitor_heuristic" in w._memo and first.schema == again.schema
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))


def test_parts_of_months_are_bounded(spark, monkeypatch):
    """Tasks hold a bounded number of company-months, whatever the session's number of partitions."""
    from churnlens.plans import warehouse
    from churnlens.sources import fixtures
    w = Warehouse(spark, lambda: fixtures.raw_tables(spark, SMOKE_DIR))
    monkeypatch.setattr(warehouse, "MONTHS_A_PART", 500)
    n = w.company_mrr().count()
    assert w.month_parts() >= n // 500 and f", {w.month_parts()}), REPARTITION_BY_NUM" in plan(w.company_mrr())


def test_active_users_are_counted_without_distinct(spark):
    """distinct users of months and windows, by each user-day's next day."""
    import datetime as dt
    import random
    from pyspark.sql import functions as F
    from churnlens.operators.temporal import spread_to_month_ends
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice(["u1", "u2", "u3", None]), dt.date(2024, 1, 1) + dt.timedelta(r.randrange(150)), 1, 0, 0, 0)
            for _ in range(300)]
    ud = spark.createDataFrame(rows, "company_id string, user_id string, activity_date date, n_login int, n_invite int, n_file int, n_page int")
    want = ud.groupBy("company_id", F.trunc("activity_date", "MM").alias("month_start")).agg(F.count_distinct("user_id").alias("n"))
    got = gold.monthly_active_users(ud, "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    want = spread_to_month_ends(ud, "activity_date", 30).groupBy("company_id", "as_of_date").agg(F.count_distinct("user_id").alias("n"))
    got = features.events_window(ud).select("company_id", "as_of_date", F.col("active_users_30d").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_cleaning_is_compiled(spark, wh):
    """the JVM leaves methods above 8,000 bytes of code to its interpreter."""
    from churnlens.plans import silver
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for t in ("users", "events", "subscriptions", "payments", "support_tickets"):
            df = silver.clean.collapse_by_key(silver.counted(t, wh.raw()[t]), silver.PRIMARY_KEYS[t], [], silver.COPIES, silver.PK_OK)
            stages = df._jdf.queryExecution().debug().codegenToSeq()
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000, t
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
