"""Customer tenure in days.

A year counts 365 days and a month 30.42, so the arithmetic runs in whole
hundredths of a day and the final division drops the fraction toward zero.
Nothing is rounded on the way. Dates that are no numbers give NULL.

Every function whose arguments are ``(snapshot, date_opened)`` can be passed to
the pivot job as its ``tenure``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from deposit_analytics.constants import (
    CENTURY,
    DAY_HUNDREDTHS,
    GREGORIAN_OFFSET_HUNDREDTHS,
    MONTH_HUNDREDTHS,
    YEAR_HUNDREDTHS,
)


def _digits(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).try_cast("bigint")


def _point(year: Column, month: Column, day: Column) -> Column:
    return year * YEAR_HUNDREDTHS + month * MONTH_HUNDREDTHS + day * DAY_HUNDREDTHS


def _whole_days(hundredths: Column) -> Column:
    return F.call_function("div", hundredths, F.lit(DAY_HUNDREDTHS))


def _opened(date_opened: Column, century: str, cut_year: int | None = None) -> Column:
    if cut_year is None:
        full = F.concat(F.lit(century), date_opened)
    else:
        later = _digits(date_opened, 1, 2) < cut_year
        full = F.concat(F.when(later, str(int(century) + 1)).otherwise(century), date_opened)
    return _point(_digits(full, 1, 4), _digits(date_opened, 3, 2), _digits(date_opened, 5, 2))


def as_of_snapshot(
    snapshot: Column, date_opened: Column, century: str = CENTURY, cut_year: int | None = None
) -> Column:
    """Tenure on the snapshot date. The one to use.

    Opening years have two digits. They are of ``century``, or, when a
    ``cut_year`` is given, of the next one if they are below it.
    """
    seen = _point(_digits(snapshot, 1, 4), _digits(snapshot, 5, 2), _digits(snapshot, 7, 2))
    return _whole_days(seen - _opened(date_opened, century, cut_year))


def as_of_date(
    as_of: dt.date, date_opened: Column, century: str = CENTURY, cut_year: int | None = None
) -> Column:
    """Tenure on one Gregorian day, whatever the snapshot.

    The day is an argument, so a report over old snapshots gives the same
    answer on every run.
    """
    today = (
        as_of.year * YEAR_HUNDREDTHS
        + as_of.month * MONTH_HUNDREDTHS
        + as_of.day * DAY_HUNDREDTHS
        - GREGORIAN_OFFSET_HUNDREDTHS
    )
    return _whole_days(F.lit(today).cast("bigint") - _opened(date_opened, century, cut_year))


def compat_v2(snapshot: Column, date_opened: Column) -> Column:
    """Tenure of the month-end report, which is NULL for every row.

    That report cuts month and day out of a ``YYYY-MM-DD`` text at the places
    of a ``YYYYMMDD`` text. The day it reads ends in a dash and is no number.
    """
    return F.lit(None).cast("bigint")


def compat_v3(snapshot: Column, date_opened: Column, century: str = CENTURY) -> Column:
    """Tenure of the daily report: month read from the year's last two digits.

    The day on both sides is the opening day and cancels out, but a missing
    opening day still makes the tenure NULL.
    """
    day = _digits(date_opened, 5, 2)
    seen = _point(_digits(snapshot, 1, 4), _digits(snapshot, 3, 2), day)
    return _whole_days(seen - _opened(date_opened, century))
