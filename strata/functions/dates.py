"""Execution-date helpers: the date is a job parameter, turned into literals on the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(execution_date: str | _dt.date) -> _dt.date:
    if isinstance(execution_date, _dt.date):
        return execution_date
    return _dt.date.fromisoformat(execution_date)


def date_range(start: str, end: str) -> list[_dt.date]:
    """Inclusive list of dates (a handful per backfill; driver-side parameters only)."""
    s, e = parse_date(start), parse_date(end)
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]


def partition_predicate(execution_date: str | _dt.date) -> Column:
    """year = Y AND month = M AND day = D on int partition columns (prunes directories)."""
    d = parse_date(execution_date)
    return (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)


def partition_range_predicate(start: str, end: str) -> Column:
    """Inclusive date range on (year, month, day); still a partition-column-only filter."""
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    s, e = parse_date(start), parse_date(end)
    return key.between(s.year * 10000 + s.month * 100 + s.day, e.year * 10000 + e.month * 100 + e.day)


def day_slice(column: str, execution_date: str | _dt.date) -> Column:
    """Half-open range ``col >= d AND col < d + 1`` — the pushdown-friendly form of DATE(col) = d."""
    d = parse_date(execution_date)
    nxt = d + _dt.timedelta(days=1)
    # Date literals are promoted to the column's own timestamp type, so the bounds push down.
    return (F.col(column) >= F.lit(d)) & (F.col(column) < F.lit(nxt))


def date_parts(execution_date: str | _dt.date) -> dict[str, Column]:
    d = parse_date(execution_date)
    return {"year": F.lit(d.year), "month": F.lit(d.month), "day": F.lit(d.day)}


def date_from_parts() -> Column:
    """ISO date string from (year, month, day) columns."""
    return F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd")
