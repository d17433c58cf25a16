"""Jalali snapshot calendar: day table, membership test, lookback start."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.constants import LAST_MONTH, LONG_MONTH, LOOKBACK_MONTHS, SHORT_MONTH


@dataclass(frozen=True)
class Calendar:
    """Snapshot dates ``first``..``last`` (``YYYYMMDD``, inclusive).

    ``day`` keeps one day of the month only: ``"01"`` for first-of-month runs,
    ``"31"`` for month ends of the long months, ``None`` for daily runs.
    ``leap_years`` get a 30th day in month 12; there are none by default.
    ``years`` states the first and last year the caller has snapshots of; a
    range beyond them is an error, never cut.
    """

    first: str
    last: str
    day: str | None = None
    leap_years: tuple[int, ...] = ()
    years: tuple[int, int] | None = None

    def __post_init__(self):
        for text in (self.first, self.last):
            if not re.fullmatch(r"\d{4}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])", text):
                raise ValueError(f"not a YYYYMMDD date: {text!r}")
        if self.day is not None and not re.fullmatch(r"0[1-9]|[12]\d|3[01]", self.day):
            raise ValueError(f"not a two-digit day: {self.day!r}")
        if self.years is not None and not self.years[0] <= self._year(self.first) <= self._year(self.last) <= self.years[1]:
            raise ValueError(f"{self.first} to {self.last} is not within the years {self.years}")

    @staticmethod
    def _year(text: str) -> int:
        return int(text[:4])

    def in_range(self, snapshot: Column) -> Column:
        """Range test on the text itself, so that it reaches the file scan."""
        if self.first == self.last:
            return snapshot == self.first
        return snapshot.between(self.first, self.last)

    def dates(self) -> list[str]:
        """The days as texts; at most 366 for each calendar year."""
        wanted = range(1, LONG_MONTH + 1) if self.day is None else (int(self.day),)
        every = (
            f"{year:04d}{month:02d}{day:02d}"
            for year in range(self._year(self.first), self._year(self.last) + 1)
            for month in range(1, 13)
            for day in wanted
            if day <= self._length(year, month)
        )
        return [date for date in every if self.first <= date <= self.last]

    def _length(self, year: int, month: int) -> int:
        """Days in a month."""
        if month == 12:
            return LAST_MONTH + (year in self.leap_years)
        return LONG_MONTH if month <= 6 else SHORT_MONTH

    def contains(self, column: str = "snapshot") -> Column:
        """True for the days of this calendar.

        A predicate instead of a join: the range part is pushed to the files,
        the days are one hash lookup per row, and on a table partitioned by
        snapshot all of it prunes partitions before any file is opened. The
        days are bounded by the calendar, not by the data.
        """
        dates = self.dates()
        if not dates:
            return F.lit(False)
        listed = ", ".join(f"'{date}'" for date in dates)
        return self.in_range(F.col(column)) & F.expr(f"`{column}` IN ({listed})")

    def days(self, spark: SparkSession) -> DataFrame:
        """The calendar as a table: snapshot, year, month, day."""
        year, month, day = F.col("year"), F.col("month"), F.col("day")
        length = (
            F.when(month <= 6, LONG_MONTH)
            .when(month <= 11, SHORT_MONTH)
            .when(year.isin(list(self.leap_years)), LAST_MONTH + 1)
            .otherwise(LAST_MONTH)
        )
        table = (
            spark.range(self._year(self.first), self._year(self.last) + 1, numPartitions=1)
            .select(F.col("id").cast("int").alias("year"))
            .select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .select("year", "month", F.explode(F.sequence(F.lit(1), length)).alias("day"))
            .select(
                F.lpad((year * 10000 + month * 100 + day).cast("string"), 8, "0").alias("snapshot"),
                "year",
                "month",
                "day",
            )
            .where(self.in_range(F.col("snapshot")))
        )
        return table if self.day is None else table.where(day == int(self.day))

    def last_day(self) -> str:
        """Latest day of the calendar range, whatever ``day`` says."""
        dates = replace(self, day=None).dates()
        if not dates:
            raise ValueError(f"no calendar day between {self.first} and {self.last}")
        return dates[-1]


def months_back(snapshot: Column, months: int = LOOKBACK_MONTHS) -> Column:
    """Same day ``months`` earlier, zero-padded; the day is not clipped.

    The result is a lower bound for text comparison, so it may name a day its
    month does not have. On a literal the optimizer folds it to a literal,
    which the file scan can use.
    """
    index = (
        F.substring(snapshot, 1, 4).try_cast("int") * 12
        + F.substring(snapshot, 5, 2).try_cast("int")
        - 1
        - months
    )
    year = F.call_function("div", index, F.lit(12)).cast("string")
    month = (index % 12 + 1).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.substring(snapshot, 7, 2))
