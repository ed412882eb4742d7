"""Date expressions; every one takes the run date, none reads the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def days_before(as_of: date, n: int) -> Column:
    return F.date_sub(F.lit(as_of), n)


def months_before(as_of: date, n: int) -> Column:
    return F.add_months(F.lit(as_of), -n)


def age_days(name: str | Column, as_of: date) -> Column:
    """Days from a date to the run date; negative for later dates."""
    return F.date_diff(F.lit(as_of), F.to_date(_col(name)))


def epoch_date(name: str | Column) -> Column:
    """Date of epoch milliseconds in the session zone."""
    return F.to_date(F.timestamp_millis(_col(name)))


def minute_bucket(name: str | Column) -> Column:
    return F.date_trunc("minute", _col(name))


def fmt_date(name: str | Column, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(_col(name), pattern)


def run_stamp(as_of: datetime) -> Column:
    """Date and time of the run as text, hours, minutes and seconds without leading zeros."""
    return F.lit(f"{as_of:%Y-%m-%d} {as_of.hour}:{as_of.minute}:{as_of.second}")
