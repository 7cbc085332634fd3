"""Scalar expressions shared by the layers. All stay inside generated code."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: str, last: str, separator: str = " ") -> Column:
    """First and last name; NULL when either is NULL."""
    return F.concat(F.col(first), F.lit(separator), F.col(last))


def date_id(day: str | Column) -> Column:
    """A day as the integer yyyymmdd, without a trip through text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_of(day: str | Column) -> Column:
    """A day's month as the integer yyyymm; the partition column of dated tables."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def moment(value: date | datetime) -> Column:
    """A literal that compares with dates and zone-less timestamps without a cast of
    the column, so the comparison reaches the scan."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)
