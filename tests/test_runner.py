"""End-to-end run with partitioned writes and the BI export."""

import os
import tempfile

from churnlens.plans import model
from churnlens.plans.runner import build_all
from churnlens.sources import io
from conftest import SMOKE_DIR


def test_build_all_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    t = build_all(spark, out, testdata=SMOKE_DIR, cutoff=model.FIXTURE_CUTOFF)
    assert "company_risk_monitor" in t
    mon = io.read_table(spark, out, "gold/company_risk_monitor_model")
    mrr = io.read_table(spark, out, "gold/company_mrr")
    assert mon.count() == mrr.count()
    assert any(d.startswith("month_start=") for d in os.listdir(io.table_path(spark, out, "gold/company_mrr")))
    sanity = io.read_table(spark, out, "checks/sanity").collect()
    assert all(r.bad_rows == 0 for r in sanity if r.check_name != "not_churned_with_date")
    fk = io.read_table(spark, out, "checks/foreign_keys").collect()
    assert all(r.bad_rows == 0 for r in fk)
    quarantine = io.read_table(spark, out, "checks/quarantine").collect()
    assert len(quarantine) == 6 and sum(r.quarantined_rows for r in quarantine) > 0
    rejected = {(r.table_name, r.reason): r.rows for r in io.read_table(spark, out, "checks/rejected_rows").collect()}
    assert rejected["companies", "duplicate"] > 0 and rejected["payments", "null_key"] > 0
    csv = spark.read.option("header", "true").csv(f"{out}/export/company_risk_monitor")
    assert csv.count() == mon.count()
