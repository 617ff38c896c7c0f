"""Calendar month used as reporting period."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    year: int
    month: int

    @classmethod
    def containing(cls, day: dt.date) -> Period:
        return cls(day.year, day.month)

    @property
    def days(self) -> int:
        return calendar.monthrange(self.year, self.month)[1]

    @property
    def start(self) -> dt.date:
        return dt.date(self.year, self.month, 1)

    @property
    def end(self) -> dt.date:
        return dt.date(self.year, self.month, self.days)

    def contains(self, date: Column) -> Column:
        """First to last day, both at midnight: a later hour on the last day falls outside."""
        return date.between(F.lit(self.start), F.lit(self.end))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
