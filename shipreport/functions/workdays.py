"""Working-day arithmetic without joins.

Weekdays between two dates have a closed form. Holidays correct it by a count
that is read from a dense array literal indexed by day number, so aging, spans
and arrival dates stay inside generated code with no calendar join and no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

_MONDAY = date(1899, 12, 25)  # day number 0 falls on a Monday
_MAX_DATES = 200 * 366  # two centuries of dates bound every holiday list


def _literal(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")


def _number_of(day: date) -> int:
    return (day - _MONDAY).days


def _weekdays_before(number: Column) -> Column:
    return F.floor(number / 7) * 5 + F.least(F.pmod(number, F.lit(7)), F.lit(5))


class WorkCalendar:
    """Monday to Friday without the given holidays."""

    def __init__(self, holidays: list[date] = ()):
        # A holiday on a weekend changes nothing.
        self._days = sorted({_number_of(h) for h in holidays if h.weekday() < 5})
        weekday_rank = [n // 7 * 5 + n % 7 + 1 for n in self._days]
        # The k-th working day lies after holiday i exactly when k exceeds this value.
        self._passed_at = [rank - i - 1 for i, rank in enumerate(weekday_rank)]

    @classmethod
    def from_table(cls, table: DataFrame, column: str = "date") -> "WorkCalendar":
        """Read a holiday table; distinct dates are few by nature and checked to be."""
        days = (
            table.select(F.to_date(F.col(column)).alias("d")).where("d is not null").distinct()
            .limit(_MAX_DATES + 1).collect()
        )
        if len(days) > _MAX_DATES:
            raise ValueError("a holiday table cannot hold more dates than two centuries have")
        return cls([r.d for r in days])

    def _count_below(self, sorted_values: list[int], value: Column) -> Column:
        """How many of the sorted values are smaller than the given one."""
        if not sorted_values:
            return F.lit(0)
        low, high = sorted_values[0], sorted_values[-1]
        counts = [bisect_left(sorted_values, v) for v in range(low, high + 2)]
        at = F.least(F.greatest(value, F.lit(low)), F.lit(high + 1)) - low
        # greatest and least skip nulls, so a null value is kept null by hand
        return F.when(value.isNotNull(), F.get(_literal(counts), at.cast("int")))

    def _number(self, day: Column) -> Column:
        return F.datediff(day.cast("date"), F.lit(_MONDAY))

    def before(self, day: Column) -> Column:
        """Working days before a date, counted from a fixed origin."""
        number = self._number(day)
        return _weekdays_before(number) - self._count_below(self._days, number)

    def through(self, day: Column) -> Column:
        """Working days up to and including a date."""
        return self.before(F.date_add(day.cast("date"), 1))

    def aging(self, start: Column, end: Column) -> Column:
        """Days an item has aged: 0 when end is not after start, else working days in [start, end) + 1."""
        s, e = start.cast("date"), end.cast("date")
        return F.when(e <= s, F.lit(0)).otherwise(self.before(e) - self.before(s) + 1).cast("long")

    def span(self, start: Column, end: Column) -> Column:
        """Working days in [start, end], 0 when end lies before start."""
        s, e = start.cast("date"), end.cast("date")
        return F.when(e < s, F.lit(0)).otherwise(self.through(e) - self.before(s)).cast("long")

    def nth(self, rank: Column) -> Column:
        """The date of the rank-th working day since the origin."""
        weekday_rank = rank + self._count_below(self._passed_at, rank) - 1
        days = F.floor(weekday_rank / 5) * 7 + F.pmod(weekday_rank, F.lit(5))
        return F.date_add(F.lit(_MONDAY), days.cast("int"))

    def add(self, start: Column, days: Column) -> Column:
        """Move a timestamp by working days and keep its time of day.

        Forward moves count from the start date itself; a zero or backward move
        from a day off first rolls on to the next working day.
        """
        steps = days.cast("long")
        rank = F.when(steps >= 1, self.through(start) + steps).otherwise(self.before(start) + 1 + steps)
        moved = F.datediff(self.nth(rank), start.cast("date"))
        moment = start.cast("timestamp")
        return F.timestamp_add("DAY", moved, moment)


def arrival(entry: Column, promised_days: Column, calendar: WorkCalendar | None) -> Column:
    """Estimated arrival: entry plus the promise plus one day, in working or calendar days."""
    days = promised_days.try_cast("double")
    if calendar is None:
        whole = F.round((days + 1) * 86_400_000_000).cast("long")
        return F.timestamp_micros(F.unix_micros(entry.cast("timestamp")) + whole)
    return calendar.add(entry, F.when(days >= 0, F.floor(days)).otherwise(F.ceil(days)) + 1)

