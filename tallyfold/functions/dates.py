"""Fiscal-calendar expressions. `as_of` is always given, never the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4


def parse_date(text: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to date; text that is no date becomes null, also in ANSI mode."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_label(d: Column) -> Column:
    """Display form such as ``Apr-24``; keys should use the month's first day."""
    return F.date_format(d, "MMM-yy")


def month_index(d: Column) -> Column:
    """Consecutive month number, so that month distance is a subtraction."""
    return F.year(d) * 12 + F.month(d)


def month_of_index(n: Column) -> Column:
    """First day of the month of that `month_index`."""
    return F.make_date(F.floor((n - 1) / 12).cast("int"), F.pmod(n - 1, F.lit(12)) + 1, F.lit(1))


def fiscal_year(d: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """The calendar year in which the date's fiscal year begins."""
    return F.year(d) + (F.month(d) >= start_month).cast("int") - 1


def fiscal_start(d: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.make_date(fiscal_year(d, start_month), F.lit(start_month), F.lit(1))


def shift_months(d: Column, months: int, eom: str = "clamp") -> Column:
    """Move a date by whole months.

    ``clamp`` keeps the day number where it exists (30 Apr - 1 month = 30 Mar);
    ``snap`` sends a month end to a month end (30 Apr - 1 month = 31 Mar).
    """
    moved = F.add_months(d, months)
    if eom == "clamp":
        return moved
    if eom == "snap":
        return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)
    raise ValueError(f"eom must be 'clamp' or 'snap', not {eom!r}")


def in_current_month(d: Column, as_of: dt.date) -> Column:
    return month_start(d) == F.lit(as_of.replace(day=1))


def between_dates(d: Column, low: dt.date, high: dt.date) -> Column:
    """From the day `low` through the day `high`, for dates and for timestamps.

    The bare column is compared with literals, so a scan can skip files by it.
    """
    return (d >= F.lit(low)) & (d < F.lit(high + dt.timedelta(days=1)))


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def last_of_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def fiscal_start_of(as_of: dt.date, start_month: int = FISCAL_START_MONTH) -> dt.date:
    year = as_of.year if as_of.month >= start_month else as_of.year - 1
    return dt.date(year, start_month, 1)


def month_sequence(first: Column, months: int) -> Column:
    """Array of `months` consecutive month starts."""
    return F.sequence(first, F.add_months(first, months - 1), F.expr("interval 1 month"))


def elapsed_fiscal_months(as_of: dt.date, start_month: int = FISCAL_START_MONTH) -> Column:
    """Month starts of the fiscal year that have begun by `as_of`."""
    return F.sequence(
        F.lit(fiscal_start_of(as_of, start_month)),
        F.lit(as_of.replace(day=1)),
        F.expr("interval 1 month"),
    )


def sort_dates(array: Column) -> Column:
    return F.array_sort(array)


def array_minus(a: Column, b: Column) -> Column:
    """Elements of a not in b; a null b takes nothing away."""
    return F.when(b.isNull(), a).otherwise(F.array_except(a, b))


def month_list(array: Column) -> Column:
    """Sorted month starts as one comma-joined text of labels."""
    return F.concat_ws(",", F.transform(sort_dates(array), month_label))
