"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "MM")


def months_crossed(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates: 31 January to 1 February is 1."""
    years = F.year(end) - F.year(start)
    return (years * 12 + F.month(end) - F.month(start)).cast("int")


def as_date(day: str | date) -> Column:
    """A DATE literal; a literal keeps comparisons foldable and pushed to the scan."""
    return F.lit(date.fromisoformat(day) if isinstance(day, str) else day)
