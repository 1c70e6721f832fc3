"""Date windows of the period words a report config may use."""

from __future__ import annotations

from datetime import date, datetime, timedelta

PREVIOUS = {"previous_months", "prev_months", "bulan_sebelumnya"}
LAST = {"last_n_months", "last_months", "month_range"}


def month_shift(day: date, months: int) -> date:
    """First day of the month so many months away."""
    number = day.year * 12 + day.month - 1 + months
    return date(number // 12, number % 12 + 1, 1)


def period_window(period: str | None, months: int | None, as_of: date) -> tuple[date, date]:
    """Half-open [start, end) of a period word; the default reaches through today."""
    word = (period or "").strip().lower()
    if word == "year":
        return date(as_of.year, 1, 1), date(as_of.year + 1, 1, 1)
    if word in PREVIOUS:
        return month_shift(as_of, -(months or 2)), month_shift(as_of, 0)
    return month_shift(as_of, 1 - (months or 3)), as_of + timedelta(days=1)


def month_table_window(months: int, now: datetime) -> tuple[datetime, datetime]:
    """The older window: whole months, with today's clock time left on both bounds."""
    clock = now.timetz().replace(tzinfo=None)
    return (datetime.combine(month_shift(now.date(), 1 - months), clock),
            datetime.combine(month_shift(now.date(), 1), clock))


def splits_by_month(period: str | None, given) -> bool:
    """Whether outputs are split by month: as given, else by the period word."""
    if given is None:
        return (period or "").strip().lower() not in LAST
    if isinstance(given, str):
        return given.strip().lower() not in {"0", "false", "no", "n", "off"}
    return bool(given)
