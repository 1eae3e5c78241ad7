"""End-to-end run: raw files -> silver -> gold -> model -> risk monitor.

    python -m churnlens.plans.runner --raw RAW_DIR --out OUT_DIR [--format csv]
    python -m churnlens.plans.runner --testdata /root/testdata/sf0.01 --out OUT_DIR

Every table is written once (Parquet, zstd; month-keyed gold tables
partitioned by month) and read back by its consumers, so a lost executor
costs a re-read of one table, not a recomputation of the whole chain.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import time

from pyspark.sql import SparkSession

from ..sources import fixtures, io
from . import checks, model
from .silver import quarantine_counts, rejected_rows
from .warehouse import Warehouse


def build_all(spark: SparkSession, out_root: str, raw_root: str | None = None,
                 raw_format: str = "csv", testdata: str | None = None,
                 cutoff: _dt.date = model.DEFAULT_CUTOFF,
                 export_csv: bool = True) -> dict[str, float]:
    if testdata:
        raw_fn = lambda: fixtures.raw_tables(spark, testdata)
    else:
        raw_fn = lambda: io.read_raw_dir(spark, raw_root, raw_format)
    wh = Warehouse(spark, raw_fn, root=out_root, cutoff=cutoff, partition_months=True)
    timings: dict[str, float] = {}

    def step(name, fn):
        t = time.time()
        fn()
        timings[name] = round(time.time() - t, 3)

    step("silver", wh.silver)
    step("as_of_date", wh.as_of)
    step("company_daily_activity", wh.daily_activity)
    step("company_monthly_metrics", wh.monthly_metrics)
    step("company_mrr", wh.company_mrr)
    step("company_churn_label", wh.churn_label)
    step("funnel_company", wh.funnel)
    step("retention_company_cohorts", wh.retention)
    step("mrr_trend_breakdown", wh.mrr_trend)
    step("company_ltv", wh.ltv)
    step("company_features_for_model", wh.features)
    step("company_churn_predictions", wh.predictions)
    step("company_revenue_at_risk", lambda: wh.company_revenue_at_risk("model"))
    step("company_risk_monitor", lambda: wh.risk_monitor("model"))

    def quality():
        gold = {"company_daily_activity": wh.daily_activity(),
                "company_monthly_metrics": wh.monthly_metrics(), "company_mrr": wh.company_mrr(),
                "company_churn_label": wh.churn_label(), "funnel_company": wh.funnel(),
                "company_ltv": wh.ltv(), "company_features_for_model": wh.features()}
        io.write_table(checks.primary_keys(wh.silver(), gold, wh.silver_flagged()), out_root, "checks/primary_keys")
        io.write_table(checks.foreign_keys(wh.silver()), out_root, "checks/foreign_keys")
        io.write_table(quarantine_counts(wh.silver_flagged()), out_root, "checks/quarantine")
        io.write_table(rejected_rows(wh.silver_flagged()), out_root, "checks/rejected_rows")
        io.write_table(checks.sanity_checks(wh.s("companies"), wh.churn_label(), wh.company_mrr(),
                                            wh.daily_activity(), wh.monthly_metrics(),
                                            wh.features()), out_root, "checks/sanity")
    step("checks", quality)
    if export_csv:
        step("export_risk_monitor_csv",
             lambda: io.export_csv(wh.risk_monitor("model"), f"{out_root}/export/company_risk_monitor"))
    return timings


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--out", required=True)
    ap.add_argument("--raw")
    ap.add_argument("--format", default="csv")
    ap.add_argument("--testdata")
    ap.add_argument("--cutoff", default=None)
    a = ap.parse_args(argv)
    from ..session import get_spark
    spark = get_spark()
    cutoff = (_dt.date.fromisoformat(a.cutoff) if a.cutoff else
              (model.FIXTURE_CUTOFF if a.testdata else model.DEFAULT_CUTOFF))
    t = build_all(spark, a.out, a.raw, a.format, a.testdata, cutoff)
    print(json.dumps(t))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
