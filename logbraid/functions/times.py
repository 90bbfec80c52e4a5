"""Time-of-day and timestamp expressions. All are free of the session time zone."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a time of day with milliseconds.
CLOCK_FORMAT = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\.[0-9]{3}$"

DEFAULT_BASE_DATE = "1970-01-01"

# Days beyond this, some 274,000 years, are no time: a timestamp ends soon after.
LAST_DAY = 100_000_000


def valid_clock(clock: Column) -> Column:
    """The clock if it is a well-formed time of day, else NULL.

    Well-formed clocks have one width, so they order as text the way they order as times.
    """
    return F.when(clock.rlike(CLOCK_FORMAT), clock)


def clock_digits(clock: Column) -> Column:
    """A well-formed clock as the number its digits make, which orders as the clock does."""
    return F.translate(clock, ":.", "").cast("int")


def event_time_of_digits(
    digits: Column, day: Column, base_date: str = DEFAULT_BASE_DATE
) -> Column:
    """As `event_time`, of a clock as `clock_digits` gives it."""
    return from_micros(event_micros(digits, day, base_date))


def event_micros(digits: Column, day: Column, base_date: str = DEFAULT_BASE_DATE) -> Column:
    """`event_time_of_digits` in microseconds, by whole numbers alone."""
    days = F.when(day.between(0, LAST_DAY), day).cast("bigint")
    minutes = F.floor(digits / F.lit(100_000))
    hours = F.floor(minutes / F.lit(100))
    millis = ((days * 24 + hours) * 60 + minutes % 100) * 60_000 + digits % 100_000
    return micros(F.lit(f"{base_date} 00:00:00").cast("timestamp_ntz")) + millis * 1000


def event_time(clock: Column, day: Column, base_date: str = DEFAULT_BASE_DATE) -> Column:
    """`base_date` + `day` days + `clock`; NULL if any part is, or the day is past `LAST_DAY`."""
    first_day = F.concat(F.lit(f"{base_date} "), clock).try_cast("timestamp_ntz")
    days = F.when(day.between(0, LAST_DAY), day).cast("int")
    return first_day + F.make_dt_interval(days=days)


def micros(ts: Column) -> Column:
    """Microseconds from 1970-01-01 of a TIMESTAMP_NTZ.

    `unix_micros` takes only zoned timestamps, and a cast to one would fold local times
    together wherever the session zone has daylight saving. An interval becomes a whole number
    only in whole seconds, so the time since midnight is taken a million times; decimals would
    cost several times as much.
    """
    day = ts.cast("date")
    since_midnight = (ts - day.cast("timestamp_ntz")) * F.lit(1_000_000)
    return F.unix_date(day).cast("bigint") * F.lit(86_400_000_000) + since_midnight.cast(
        "interval second"
    ).cast("bigint")


def from_micros(us: Column) -> Column:
    """The TIMESTAMP_NTZ that `micros` gave."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.lit(timedelta(microseconds=1)) * us


def bucket(us: Column, width: int) -> Column:
    """Start of the `width`-wide bucket of time that holds `us`, all in whole microseconds."""
    return us - F.pmod(us, F.lit(width))


def in_micros(width: timedelta) -> int:
    return width // timedelta(microseconds=1)
