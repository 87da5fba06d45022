"""Run the pipeline: `spark-submit` this file or `python -m ledgerflow`."""

from __future__ import annotations

import argparse
import sys

from ledgerflow.layout import APPROVAL_DENOMINATOR, APPROVED, CARD, PAYMENT_COLUMNS, REVERSED, WINDOW_DAYS
from ledgerflow.operators.dates import DateRange
from ledgerflow.plans.audit import FAILED
from ledgerflow.plans.pipeline import STAGES, Lake, run_pipeline
from ledgerflow.plans.reports import ReportRules
from ledgerflow.session import build_session
from ledgerflow.sources.deliveries import Landing


def listed(text: str | None) -> list[str]:
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerflow", description=__doc__)
    parser.add_argument("--payments", required=True, help="folder where payment deliveries arrive")
    parser.add_argument("--merchants", required=True, help="merchant CSV")
    parser.add_argument("--root", required=True, help="folder of all tables")
    parser.add_argument("--stage", choices=STAGES, default="all")
    parser.add_argument("--unit", choices=("file", "folder"), default="file", help="what counts as one delivery")
    parser.add_argument("--window-days", type=int, default=WINDOW_DAYS)
    parser.add_argument("--from-date", help="first day of a backfill")
    parser.add_argument("--to-date", help="last day of a backfill")
    parser.add_argument("--run-id")
    parser.add_argument("--columns", help="the one header all payment deliveries promise, comma-separated")
    parser.add_argument("--required", help="columns a payment delivery must have, comma-separated")
    parser.add_argument("--hash-exclude", default="", help="columns the record hash does not cover, comma-separated")
    parser.add_argument("--strict-unique", action="store_true", help="drop copies inside a delivery too")
    parser.add_argument("--extra", action="append", default=[], metavar="KEY=TEXT", help="a fact to record with the run")
    parser.add_argument("--approved-status", default=APPROVED)
    parser.add_argument("--reversed-status", default=REVERSED)
    parser.add_argument("--denominator-statuses", default=",".join(APPROVAL_DENOMINATOR))
    parser.add_argument("--payment-method", default=CARD, help="the method the approval rate is about")
    parser.add_argument("--set-aside-damaged", action="store_true", help="report without unreadable files, as PARTIAL")
    options = parser.parse_args(arguments)
    if bool(options.from_date) != bool(options.to_date):
        parser.error("a backfill needs --from-date and --to-date")
    dates = DateRange(options.from_date, options.to_date) if options.from_date else None
    results = run_pipeline(
        build_session(),
        Lake(Landing(options.payments, unit=options.unit), options.merchants, options.root),
        options.stage,
        rules=ReportRules(
            options.window_days,
            options.approved_status,
            tuple(listed(options.denominator_statuses)),
            options.payment_method,
            options.reversed_status,
        ),
        run_id=options.run_id,
        dates=dates,
        payment_options={
            "columns": listed(options.columns) or None,
            "required": listed(options.required) or PAYMENT_COLUMNS,
            "hash_exclude": listed(options.hash_exclude),
            "strict_unique": options.strict_unique,
            "extra": dict(pair.split("=", 1) for pair in options.extra),
        },
        merchant_options={"hash_exclude": listed(options.hash_exclude)},
        report_options={"set_aside_damaged": options.set_aside_damaged},
    )
    for name, result in results.items():
        print(f"{name}: {result.status} (run {result.run_id})")
    return 1 if any(result.status == FAILED for result in results.values()) else 0


if __name__ == "__main__":
    sys.exit(main())
