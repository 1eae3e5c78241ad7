"""Invariants of the built tables at sf0.001."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnlens.functions.dates import month_start
from churnlens.operators.temporal import month_spine
from churnlens.plans import checks, features, gold, silver
from churnlens.plans.warehouse import Warehouse
from churnlens.sources import fixtures
from conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.for_testdata(spark, SMOKE_DIR)


def test_spine_has_no_gaps(wh):
    s = month_spine(wh.s("companies"), wh.as_of())
    w = Window.partitionBy("company_id").orderBy("month_start")
    gaps = (s.withColumn("prev", F.lag("month_start").over(w))
            .where(F.col("prev").isNotNull() & (F.add_months("prev", 1) != F.col("month_start"))))
    assert gaps.count() == 0
    last = s.groupBy("company_id").agg(F.max("month_start").alias("m"))
    assert last.where(F.col("m") != month_start(F.lit(wh.as_of()))).count() == 0


def test_month_tables_have_spine_rows(wh):
    n = month_spine(wh.s("companies"), wh.as_of()).count()
    assert wh.monthly_metrics().count() == n
    assert wh.company_mrr().count() == n
    assert wh.company_revenue_at_risk("heuristic").count() == n
    assert wh.features().count() == n


def test_monthly_events_reconcile_with_events_in_spine(wh):
    comp = wh.s("companies").select("company_id", month_start("signup_date").alias("first"))
    ev = (wh.s("events").join(wh.s("users").select("user_id", "company_id"), "user_id")
          .join(comp, "company_id")
          .where(month_start("event_timestamp") >= F.col("first")))
    total = wh.monthly_metrics().agg(F.sum("total_events")).first()[0]
    assert total == ev.count()


def test_feature_counts_non_negative(wh):
    cols = ["active_users_30d", "logins_30d", "invites_30d", "uploads_30d", "tickets_60d",
            "failed_payments_60d"]
    bad = wh.features().where(" OR ".join(f"{c} < 0" for c in cols))
    assert bad.count() == 0


def test_all_checks_are_zero(wh):
    g = {"company_daily_activity": wh.daily_activity(),
         "company_monthly_metrics": wh.monthly_metrics(), "company_mrr": wh.company_mrr(),
         "company_churn_label": wh.churn_label(), "funnel_company": wh.funnel(),
         "company_ltv": wh.ltv(), "company_features_for_model": wh.features()}
    pk = checks.primary_keys(wh.silver(), g, wh.silver_flagged()).collect()
    assert all(r.duplicate_keys == 0 and r.null_key_rows == 0 for r in pk if not r.table_name.startswith("typed."))
    dirty = {r.table_name: (r.duplicate_keys, r.null_key_rows) for r in pk if r.table_name.startswith("typed.")}
    assert dirty["typed.companies"][0] > 0 and dirty["typed.events"][0] > 0 and dirty["typed.payments"][1] > 0
    assert all(r.bad_rows == 0 for r in checks.foreign_keys(wh.silver()).collect())
    sanity = checks.sanity_checks(wh.s("companies"), wh.churn_label(), wh.company_mrr(),
                                  wh.daily_activity(), wh.monthly_metrics(), wh.features())
    assert {r.check_name: r.bad_rows for r in sanity.collect()} == {
        r.check_name: 0 for r in sanity.collect()}


def test_rebuild_is_identical(spark, wh):
    other = Warehouse(spark, lambda: fixtures.raw_tables(spark, SMOKE_DIR), materialize=False)
    a = wh.features()
    b = features.company_features(
        other.s("companies"), gold.user_day_activity(other.s("events"), other.s("users")),
        other.s("support_tickets"), other.s("payments"), other.s("subscriptions"),
        other.s("subscription_plans"), other.churn_label(), other.as_of())
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_layers_follow_the_files(spark, tmp_path):
    """Test tables that change are read anew; unchanged ones keep their built layers."""
    import shutil
    for f in ("customer", "nation", "orders", "lineitem", "part"):
        shutil.copy(f"{SMOKE_DIR}/{f}.parquet", tmp_path)
    first = Warehouse.for_testdata(spark, str(tmp_path))
    assert Warehouse.for_testdata(spark, str(tmp_path)) is first
    n = first.s("companies").count()
    some = spark.read.parquet(f"{SMOKE_DIR}/customer.parquet").where("c_custkey % 2 = 0").toPandas()
    some.to_parquet(tmp_path / "customer.parquet")
    second = Warehouse.for_testdata(spark, str(tmp_path))
    assert second is not first and second.s("companies").count() < n
