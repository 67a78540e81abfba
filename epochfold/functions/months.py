"""Partition months and the tests for open and closed versions.

All are built-in expressions, so those on a month column prune directories and those on a date
column reach the file reader. A NULL end is neither open nor closed.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from epochfold.model import Contract, col


def month_end(column: Column) -> Column:
    """Last day of the month as ``yyyy-MM-dd`` text, the value of a partition directory."""
    return F.last_day(column).cast("string")


def month_start(column: Column) -> Column:
    """First day of the month as a date: the value behind a ``months()`` partition."""
    return F.date_trunc("month", column).cast("date")


def open_by_month(contract: Contract) -> Column:
    return col(contract.to_month) == F.lit(contract.open_month)


def closed_by_month(contract: Contract) -> Column:
    return col(contract.to_month) != F.lit(contract.open_month)


def closed_by_end(contract: Contract) -> Column:
    """`closed_by_month` for rows whose months follow from their interval, as a range of dates.

    A file reader can use it; a test of `last_day` it cannot.
    """
    first = contract.open_date.replace(day=1)
    end = col(contract.valid_to)
    closed = end < F.lit(first)
    if (first.year, first.month) < (date.max.year, date.max.month):
        following = (first + timedelta(days=31)).replace(day=1)
        closed = closed | (end >= F.lit(following))
    return closed


def open_by_date(contract: Contract) -> Column:
    return col(contract.valid_to) == F.lit(contract.open_date)


def closed_by_date(contract: Contract) -> Column:
    return col(contract.valid_to) != F.lit(contract.open_date)
