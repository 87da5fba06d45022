"""Inclusive date ranges on `YYYY-MM-DD` text, the type of the partition column."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column


@dataclass(frozen=True)
class DateRange:
    """Both ends belong to the range."""

    first: str
    last: str

    def __post_init__(self) -> None:
        first, last = date.fromisoformat(self.first), date.fromisoformat(self.last)
        if first > last:
            raise ValueError(f"date range starts on {first} after its end {last}")
        # 20240115 is ISO too, but would not compare with the partition text.
        object.__setattr__(self, "first", first.isoformat())
        object.__setattr__(self, "last", last.isoformat())

    def holds(self, column: Column) -> Column:
        """Predicate on the text column; prunes partitions when the column is one."""
        return column.between(self.first, self.last)

    def days(self) -> list[str]:
        first, last = date.fromisoformat(self.first), date.fromisoformat(self.last)
        return [(first + timedelta(n)).isoformat() for n in range((last - first).days + 1)]

    def widened(self, before: int = 0, after: int = 0) -> DateRange:
        """The range with that many more days on either side."""
        return DateRange(
            (date.fromisoformat(self.first) - timedelta(before)).isoformat(),
            (date.fromisoformat(self.last) + timedelta(after)).isoformat(),
        )
