"""Calendar arithmetic of statutory periods, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months_sticky(day: Column, months: Column | int) -> Column:
    """Months added; a month's last day stays a last day (31 Dec + 6 is 30 Jun, 30 Jun + 6 is 31 Dec)."""
    moved = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def window_end(as_of: Column, horizon: Column | int) -> Column:
    """The month-end ``horizon`` months on (29 Feb + 1 month is 31 Mar)."""
    return F.last_day(F.add_months(as_of, horizon))


def filing_deadline(period_end: Column, extension: Column | int = 0, months: int = 6, days: int = 15) -> Column:
    """Sticky ``months`` and the extension's months after a period's end, then ``days``."""
    return F.date_add(add_months_sticky(period_end, F.lit(months) + extension), days)


def month_index(day: Column) -> Column:
    """Months since year 0: differences count months."""
    return F.year(day) * 12 + F.month(day)


def month_ends(first: Column, last: Column) -> Column:
    """The array of month-ends from the first date's month to the last date's, none after ``last``."""
    start = F.last_day(first)
    steps = F.sequence(F.trunc(first, "month"), F.greatest(F.trunc(last, "month"), F.trunc(first, "month")), F.expr("INTERVAL 1 MONTH"))
    return F.filter(F.transform(steps, F.last_day), lambda d: (d >= start) & (d <= last))


def local_date(instant: Column, zone: str = "Europe/Warsaw") -> Column:
    """The calendar date of an instant in a zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def settled_by(end: Column, launch: Column, lag_months: int) -> Column:
    """The day on which a window that ends on ``end`` counts as settled: later by a lag once it ends after the launch."""
    return F.when(end >= launch, F.add_months(end, lag_months)).otherwise(end)
