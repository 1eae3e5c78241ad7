"""Layered build with materialised intermediate tables.

``Warehouse`` builds raw -> silver -> gold lazily and writes each shared
layer that is dear to make once as Parquet under the session's ``spark.checkpoint.dir`` (a
shared folder on a cluster), then reads it back. That cuts lineage
(a lost executor re-reads a file instead of recomputing the whole chain),
gives later stages column statistics, and lets every downstream table
reuse silver/gold instead of re-cleaning 100 TB per table.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import lit_date, whole_month_diff
from ..session import JOIN_WHERE_DEALT, ensure_checkpoint_dir
from ..sources import fixtures, io
from . import analytics, features, gold, model, risk, scoring
from .silver import BUILD_ORDER, FK_PARENTS, accepted, build_silver_table

_REGISTRY: dict[tuple, "Warehouse"] = {}
_REGISTRY_LOCK = threading.Lock()
# Month-keyed gold tables are written partitioned by their month column
# in production runs, so month-filtered reads prune to one folder.
MONTH_KEYS = ("month_start", "as_of_date")
#: Company-months of one task; all the joins of a dashboard keep some 1 KB for each.
MONTHS_A_PART = 250_000


def _as_read(df: DataFrame) -> DataFrame:
    """With the schema that the table has when it is written and read: every column may be NULL."""
    return df.select(*[F.col(f.name) if f.nullable else F.when(F.lit(False), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
                       for f in df.schema.fields])


class Warehouse:
    def __init__(self, spark: SparkSession, raw: Callable[[], dict[str, DataFrame]],
                 root: str | None = None, materialize: bool = True,
                 cutoff: _dt.date | None = None, partition_months: bool = False):
        self.spark = spark
        for k, v in JOIN_WHERE_DEALT.items():
            spark.conf.set(k, v)
        self._raw_fn = raw
        self.root = root or f"{ensure_checkpoint_dir(spark)}/churnlens-{uuid.uuid4().hex[:8]}"
        self.materialize = materialize
        self.cutoff = cutoff or model.DEFAULT_CUTOFF
        self.partition_months = partition_months
        self._memo: dict[str, object] = {}
        self._queries = 0
        # Re-entrant: builders call other memoised builders. Concurrent
        # callers wait for a layer instead of writing it twice.
        self._lock = threading.RLock()

    # -- construction helpers -------------------------------------------------
    @classmethod
    def for_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        # built again when the files under it are others than they were
        key = (spark.sparkContext.applicationId, sf_dir, io.listing(spark, sf_dir), tuple(sorted(kw.items())))
        with _REGISTRY_LOCK:
            wh = _REGISTRY.get(key)
            if wh is None:
                kw = {"cutoff": model.FIXTURE_CUTOFF} | kw
                wh = cls(spark, lambda: fixtures.raw_tables(spark, sf_dir), **kw)
                _REGISTRY[key] = wh
        return wh.next_query()

    def _keep(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        if not self.materialize:
            return df
        if partition_by is None and self.partition_months:
            partition_by = next(([c] for c in MONTH_KEYS if c in df.columns
                                 and not name.startswith("silver/")), None)
        io.write_table(df, self.root, name, partition_by)
        return io.read_table(self.spark, self.root, name).select(*df.columns)

    def memo(self, name: str, build: Callable[[], object]):
        with self._lock:
            if name not in self._memo:
                self._memo[name] = build()
            return self._memo[name]

    def table(self, name: str, build: Callable[[], DataFrame],
              partition_by: list[str] | None = None) -> DataFrame:
        return self.memo(name, lambda: self._keep(name, build(), partition_by))

    def view(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that is cheap to make from written ones where it is read: not
        written for the one query that needs it first, but when another comes
        (``next_query``), and always where tables are the output."""
        if self.partition_months:
            return self.table(name, build)
        with self._lock:
            if name not in self._memo:
                first = self.memo(f"view/{name}", lambda: (self._queries, _as_read(build())))
                if first[0] == self._queries:
                    return first[1]
            return self.table(name, lambda: first[1])

    def next_query(self) -> "Warehouse":
        with self._lock:
            self._queries += 1
        return self

    def month_parts(self) -> int:
        """Into how many tasks company-months are dealt (``spine_with_months``): none holds many
        more than ``MONTHS_A_PART``, as its joins keep a part's months in memory."""
        def count() -> int:
            months = whole_month_diff(lit_date(self.as_of()), "signup_date") + 1
            n = self.s("companies").agg(F.sum(F.greatest(months, F.lit(0)).cast("long")).alias("n")).first()["n"] or 0
            return max(self.spark.sparkContext.defaultParallelism, -(-n // MONTHS_A_PART))
        return self.memo("month_parts", count)

    # -- files ----------------------------------------------------------------
    def ingested_events(self) -> DataFrame:
        """A1 on CSV files of raw events, some with line breaks inside quoted values."""
        path = self.memo("csv/events", lambda: io.export_csv(
            fixtures.events_with_breaks(self.raw()["events"]), f"{self.root}/csv/events"))
        return io.read_raw(self.spark, path, "events").drop(io.CORRUPT)

    def exported_monitor(self, source: str = "heuristic") -> DataFrame:
        """The risk monitor's export, read back."""
        monitor = self.risk_monitor(source)
        path = self.memo(f"export/{source}", lambda: io.export_csv(monitor, f"{self.root}/export/{source}"))
        return io.read_export(self.spark, path, monitor)

    # -- layers ---------------------------------------------------------------
    def raw(self) -> dict[str, DataFrame]:
        return self.memo("raw", self._raw_fn)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """A table of the silver layer, written."""
        return self.table(f"silver/{name}", lambda: df)

    def flagged(self, t: str) -> DataFrame:
        """One silver table with its flags, built after the tables that its foreign keys name."""
        return self.table(f"silver/{t}", lambda: build_silver_table(
            t, self.raw()[t], {p: self.s(p) for _, p, _ in FK_PARENTS.get(t, [])}, keep=self.keep))

    def silver_flagged(self) -> dict[str, DataFrame]:
        """Silver tables with their FK flags (quarantine = flag false)."""
        return {t: self.flagged(t) for t in BUILD_ORDER}

    def s(self, t: str) -> DataFrame:
        return accepted(self.flagged(t))

    def silver(self) -> dict[str, DataFrame]:
        return {t: self.s(t) for t in BUILD_ORDER}

    def as_of(self) -> _dt.date:
        return self.memo("as_of", lambda: gold.as_of_date(
            self.s("events"), self.s("payments"), self.s("subscriptions")))

    def user_day(self) -> DataFrame:
        return self.table("gold/_company_user_day",
                          lambda: gold.user_day_activity(self.s("events"), self.s("users")))

    def daily_activity(self) -> DataFrame:
        return self.table("gold/company_daily_activity",
                          lambda: gold.company_daily_activity(self.user_day()))

    def mau(self) -> DataFrame:
        """K4 once, shared by monthly metrics and MRR."""
        return self.table("gold/_monthly_active_users",
                          lambda: gold.monthly_active_users(self.user_day()))

    def monthly_metrics(self) -> DataFrame:
        return self.table("gold/company_monthly_metrics", lambda: gold.company_monthly_metrics(
            self.s("companies"), self.user_day(), self.s("support_tickets"),
            self.s("payments"), self.as_of(), daily=self.daily_activity(), mau=self.mau(), parts=self.month_parts()))

    def company_mrr(self) -> DataFrame:
        return self.view("gold/company_mrr", lambda: gold.company_mrr(
            self.s("companies"), self.user_day(), self.s("subscriptions"), self.s("subscription_plans"), self.as_of(),
            mau=self.mau(), parts=self.month_parts(), picked=self.table("gold/_mrr_companies", lambda: gold.mrr_companies(
                self.s("companies"), self.s("subscriptions"), self.s("subscription_plans"), self.as_of()))))

    def churn_label(self) -> DataFrame:
        return self.table("gold/company_churn_label", lambda: gold.company_churn_label(
            self.s("companies"), self.user_day(), self.s("subscriptions"), self.as_of()))

    def funnel(self) -> DataFrame:
        return self.table("gold/funnel_company", lambda: analytics.funnel_company(
            self.s("companies"), self.daily_activity(), self.s("subscriptions")))

    def retention(self) -> DataFrame:
        return self.table("gold/retention_company_cohorts", lambda: analytics.retention_cohorts(
            self.s("companies"), self.monthly_metrics()))

    def mrr_trend(self) -> DataFrame:
        return self.table("gold/mrr_trend_breakdown", lambda: analytics.mrr_trend_breakdown(
            self.company_mrr(), self.s("companies")))

    def ltv(self) -> DataFrame:
        return self.table("gold/company_ltv", lambda: analytics.company_ltv(
            self.company_mrr(), self.churn_label(), self.as_of()))

    def features(self) -> DataFrame:
        return self.view("gold/company_features_for_model", self._features)

    def kept_features(self) -> DataFrame:
        """The same, written at once for what reads it in many passes."""
        return self.table("gold/company_features_for_model", self._features)

    def _features(self) -> DataFrame:
        windows = self.table("gold/_month_windows", lambda: features.month_windows(
            self.user_day(), self.s("support_tickets"), self.s("payments")))
        picked = self.table("gold/_feature_companies", lambda: features.feature_companies(
            self.s("companies"), self.user_day(), self.s("subscriptions"), self.s("subscription_plans"),
            self.churn_label(), self.as_of()))
        return features.company_features(
            self.s("companies"), self.user_day(), self.s("support_tickets"), self.s("payments"),
            self.s("subscriptions"), self.s("subscription_plans"), self.churn_label(), self.as_of(),
            windows=[windows], picked=picked, parts=self.month_parts())

    # -- model and risk -------------------------------------------------------
    def heuristic(self) -> DataFrame:
        return self.view("gold/heuristic_scores",
                         lambda: model.heuristic_scores(self.features(), self.cutoff))

    def model(self):
        return self.memo("model", lambda: model.fit(
            self.kept_features(), self.cutoff, keep=lambda df: self._keep("gold/_training_rows", df)))

    def scored_test(self) -> DataFrame:
        return self.table("gold/_scored_test",
                          lambda: model.score(self.model()[0], self.model()[2]))

    def predictions(self) -> DataFrame:
        return self.table("gold/company_churn_predictions",
                          lambda: self.scored_test().select(*model.ID_COLS, "churn_probability"))

    def split(self) -> tuple[DataFrame, DataFrame]:
        """M1-M4: imputed training and test snapshots."""
        train, test = model.time_split(model.model_input(self.kept_features()), self.cutoff)
        train, (test,) = model.impute(train, [test])
        return train, test

    def coefficients(self, source: str = "discriminant") -> DataFrame:
        """A model's coefficient table (``discriminant``, or ``model`` for the MLlib fit)."""
        return self.table(f"gold/coefficients_{source}", lambda: (
            scoring.coefficient_table(self.model()[0]) if source == "model" else scoring.discriminant(self.split()[0])))

    def scored(self, source: str = "discriminant") -> DataFrame:
        """M8/A5: the test snapshots scored from a coefficient table, written and read back."""
        return self.table(f"gold/scored_{source}", lambda: scoring.score(self.split()[1], self.coefficients(source)))

    def fit_residuals(self) -> DataFrame:
        """M7: first-order residuals of the MLlib fit."""
        return scoring.residuals(self.model()[1], self.coefficients("model"))

    def _preds(self, source: str) -> DataFrame:
        return self.heuristic() if source == "heuristic" else self.predictions()

    def revenue_at_risk(self, source: str = "model") -> DataFrame:
        return self.table(f"gold/revenue_at_risk_{source}", lambda: risk.revenue_at_risk(
            self._preds(source).select(*model.ID_COLS, "churn_probability"), self.company_mrr()))

    def company_revenue_at_risk(self, source: str = "model") -> DataFrame:
        return self.view(f"gold/company_revenue_at_risk_{source}",
                         lambda: risk.company_revenue_at_risk(self.company_mrr(),
                                                              self.revenue_at_risk(source)))

    def risk_monitor(self, source: str = "model") -> DataFrame:
        return self.view(f"gold/company_risk_monitor_{source}", lambda: risk.company_risk_monitor(
            self.company_revenue_at_risk(source), self.features()))
