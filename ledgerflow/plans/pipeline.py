"""The whole run: payments, merchants, reports, or one of these stages."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from ledgerflow.operators.dates import DateRange
from ledgerflow.operators.enrich import new_run_id
from ledgerflow.plans.bronze import IngestResult, ingest_merchants, ingest_payments
from ledgerflow.plans.gold import GoldResult, build_reports
from ledgerflow.plans.reports import ReportRules
from ledgerflow.sources.deliveries import Landing

STAGES = ("all", "bronze", "gold")


@dataclass(frozen=True)
class Lake:
    """Where everything lies. Reports of other window lengths go to folders of their own."""

    payments_landing: Landing
    merchants_csv: str
    root: str

    @property
    def bronze_payments(self) -> str:
        return f"{self.root}/bronze_payments"

    @property
    def bronze_merchants(self) -> str:
        return f"{self.root}/bronze_merchants"

    @property
    def daily_payment_summary(self) -> str:
        return f"{self.root}/gold/daily_payment_summary"

    def merchant_performance(self, window_days: int) -> str:
        return f"{self.root}/gold/merchant_performance_{window_days}d"

    def audit(self, name: str) -> str:
        return f"{self.root}/audit/{name}"


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    stage: str = "all",
    *,
    rules: ReportRules = ReportRules(),
    run_id: str | None = None,
    dates: DateRange | None = None,
    payment_options: Mapping[str, Any] | None = None,
    merchant_options: Mapping[str, Any] | None = None,
    report_options: Mapping[str, Any] | None = None,
) -> dict[str, IngestResult | GoldResult]:
    """Run the stages in order under one run id; `dates` makes it a backfill.

    The last three hold further arguments of `ingest_payments` (columns, required,
    strict_unique, hash_exclude, extra), `ingest_merchants` and `build_reports`.
    """
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, got {stage!r}")
    run_id = run_id or new_run_id()
    results: dict[str, IngestResult | GoldResult] = {}
    if stage in ("all", "bronze"):
        results["payments"] = ingest_payments(
            spark,
            lake.payments_landing,
            lake.bronze_payments,
            run_id=run_id,
            dates=dates,
            quarantine_path=lake.audit("quarantined_payments"),
            manifest_path=lake.audit("payment_manifest"),
            report_path=lake.audit("run_report"),
            **(payment_options or {}),
        )
        results["merchants"] = ingest_merchants(
            spark,
            lake.merchants_csv,
            lake.bronze_merchants,
            run_id=run_id,
            manifest_path=lake.audit("merchant_manifest"),
            report_path=lake.audit("run_report"),
            **(merchant_options or {}),
        )
    if stage in ("all", "gold"):
        results["reports"] = build_reports(
            spark,
            lake.bronze_payments,
            lake.merchants_csv,
            lake.daily_payment_summary,
            lake.merchant_performance(rules.window_days),
            rules=rules,
            run_id=run_id,
            dates=dates,
            report_path=lake.audit("run_report"),
            **(report_options or {}),
        )
    return results
