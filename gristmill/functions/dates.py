"""Period constants and date parsing."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """A monthly vision and the date constants derived from it."""

    year: int
    month: int

    @staticmethod
    def of(yyyymm: int) -> "Period":
        period = Period(yyyymm // 100, yyyymm % 100)
        if not 1 <= period.month <= 12:
            raise ValueError(f"not a YYYYMM period: {yyyymm}")
        return period

    @property
    def value(self) -> int:
        return self.year * 100 + self.month

    @property
    def first_day(self) -> date:
        return date(self.year, self.month, 1)

    @property
    def last_day(self) -> date:
        return date(self.year, self.month, calendar.monthrange(self.year, self.month)[1])

    @property
    def year_start(self) -> date:
        return date(self.year, 1, 1)

    @property
    def year_end(self) -> date:
        return date(self.year, 12, 31)

    @property
    def rolling_start(self) -> date:
        """First day of the following month, one year back (kept as the programs define it)."""
        return date(self.year, 1, 1) if self.month == 12 else date(self.year - 1, self.month + 1, 1)

    @property
    def closing_day(self) -> date:
        return date(self.year, self.month, 10)

    def shift(self, months: int) -> "Period":
        index = self.year * 12 + self.month - 1 + months
        return Period(index // 12, index % 12 + 1)

    def previous(self) -> "Period":
        return self.shift(-1)

    @staticmethod
    def span(first: int, last: int) -> list["Period"]:
        out, current = [], Period.of(first)
        while current.value <= last:
            out.append(current)
            current = current.shift(1)
        return out


def _month_day(mmdd: Column) -> Column:
    return F.lpad(mmdd.cast("string"), 4, "0")


def anniversary_month(mmdd: Column) -> Column:
    return F.substring(_month_day(mmdd), 1, 2).try_cast("int")


def anniversary_day(mmdd: Column) -> Column:
    return F.substring(_month_day(mmdd), 3, 2).try_cast("int")


def anniversary(mmdd: Column, observed: date) -> Column:
    """Last anniversary not after the observation day; null for a day that the year does not have."""
    def in_year(year: int) -> Column:
        return F.try_to_date(F.concat(F.lit(str(year)), _month_day(mmdd)), "yyyyMMdd")

    this_year = in_year(observed.year)
    return F.when(this_year > F.lit(observed), in_year(observed.year - 1)).otherwise(this_year)


def sas_date(c: Column) -> Column:
    """Date part of ``14MAY1991:00:00:00``."""
    return F.try_to_date(F.substring(c, 1, 9), "ddMMMyyyy")


def days_incl(end: Column, start: Column) -> Column:
    return F.date_diff(end, start) + 1


def previous_month(c: Column) -> Column:
    return F.add_months(c, -1)
