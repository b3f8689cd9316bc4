"""Date arithmetic at day granularity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days(start: str | Column, end: str | Column) -> Column:
    return F.datediff(end, start)


def complete_months(start: Column, end: Column) -> Column:
    """Calendar months between two dates that are over, by comparing days of the month."""
    whole = (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    return whole - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)


def week(d: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", d))


def age_at(reference: Column, year_of_birth: Column) -> Column:
    return F.year(reference) - year_of_birth


def age_band(age: Column, width: int = 10) -> Column:
    low = F.floor(age / width) * width
    return F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string"))
