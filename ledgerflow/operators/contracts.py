"""Column contracts of inputs and outputs, and checks of report arguments."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from ledgerflow.layout import PAYMENT_METHODS, STATUSES


@dataclass(frozen=True)
class ColumnCheck:
    """Outcome of comparing actual with expected column names; truthy when it passed."""

    subject: str
    missing: tuple[str, ...]
    unexpected: tuple[str, ...]
    strict: bool

    @property
    def passed(self) -> bool:
        return not self.missing and not (self.strict and self.unexpected)

    @property
    def message(self) -> str | None:
        if self.passed:
            return None
        problems = []
        if self.missing:
            problems.append(f"missing columns: {', '.join(self.missing)}")
        if self.strict and self.unexpected:
            problems.append(f"unexpected columns: {', '.join(self.unexpected)}")
        return f"{self.subject}: {'; '.join(problems)}"

    def __bool__(self) -> bool:
        return self.passed


def check_columns(
    actual: Iterable[str], expected: Iterable[str], subject: str = "table", strict: bool = False
) -> ColumnCheck:
    """Compare by name, case-sensitively. Reads no data; needs only `df.columns`."""
    have, want = set(actual), set(expected)
    return ColumnCheck(subject, tuple(sorted(want - have)), tuple(sorted(have - want)), strict)


def check_rate_arguments(
    payment_method: str, denominator_statuses: Iterable[str], *single_statuses: str
) -> None:
    """Reject unknown codes early; a typo would otherwise give a silent NULL or 0 rate."""
    for status in [*denominator_statuses, *single_statuses]:
        if status not in STATUSES:
            raise ValueError(f"unknown status {status!r}, expected one of {STATUSES}")
    if payment_method not in PAYMENT_METHODS:
        raise ValueError(f"unknown payment method {payment_method!r}, expected one of {PAYMENT_METHODS}")


def check_unique(df, key: str, subject: str) -> None:
    """Fail when `key` repeats: a repeated dimension key multiplies every count joined to it."""
    repeated = [r[0] for r in df.groupBy(key).count().filter("count > 1").select(key).take(5)]
    if repeated:
        raise ValueError(f"{subject}: {key} is not unique, for example {repeated}")
