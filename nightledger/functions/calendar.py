"""Dates, stay calendars and durations.

Durations are counted on the calendar (days and seconds of the day) so that they
do not depend on the session time zone for ``timestamp_ntz`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400

# The anchor Sunday of the weekday number and the holiday spells
# (first day, last day). The last spell has no end: days after its start count
# down to it and turn negative.
WEEKDAY_ANCHOR = date(2016, 2, 28)
HOLIDAYS_2016 = (
    (date(2016, 4, 2), date(2016, 4, 4)),
    (date(2016, 4, 30), date(2016, 5, 2)),
    (date(2016, 6, 9), None),
)
WEEKEND_NUMBERS = (5, 6)


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions of a second are cut from both."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * DAY_SECONDS + second_of_day(end) - second_of_day(start)


def day_deadline(day: Column) -> Column:
    """The last second of ``day``."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(DAY_SECONDS - 1))


def rest_hours(order_ts: Column, checkin: Column) -> Column:
    """Hours from the order to the end of the check-in day; negative once it has passed."""
    midnight_gap = F.datediff(checkin, F.to_date(order_ts)).cast("long") * DAY_SECONDS
    return (midnight_gap + DAY_SECONDS - 1 - second_of_day(order_ts)) / 3600.0


def weekday_number(day: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.pmod(F.datediff(day, F.lit(WEEKDAY_ANCHOR)), F.lit(7)).cast("int")


def is_weekend(weekday: Column) -> Column:
    """1 on Friday and Saturday nights; a missing weekday counts as 0."""
    return F.coalesce(weekday.isin(*WEEKEND_NUMBERS).cast("int"), F.lit(0))


def lead_days(stay_date: Column, order_ts: Column) -> Column:
    return F.datediff(stay_date, F.to_date(order_ts))


def days_to_holiday(day: Column, holidays: Sequence[tuple[date, date | None]] = HOLIDAYS_2016) -> Column:
    """Days until the next spell starts, 0 inside one; the last spell is counted through its end."""
    ahead = F.lit(0)
    for first, last in reversed(holidays):
        until = F.datediff(F.lit(first), day)
        if last is None:
            ahead = until
        else:
            ahead = F.when(day < F.lit(first), until).when(day <= F.lit(last), 0).otherwise(ahead)
    return F.coalesce(ahead, F.lit(0)).cast("int")


def within(value: Column, low, high) -> Column:
    """Half-open range."""
    return (value >= F.lit(low)) & (value < F.lit(high))


def hour_number(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)) * 24 + F.hour(ts)


def day_number(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts))
