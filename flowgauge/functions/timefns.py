"""Time expressions on ``TIMESTAMP_NTZ`` columns. All stay inside the JVM."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "t": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}
DAY_SECONDS = 86400


def step_seconds(step: str) -> int:
    """Seconds in a step such as ``10T``, ``10min``, ``H`` or ``10 minutes``.

    Slots are aligned to midnight, so only steps that divide a day are accepted.
    """
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", step)
    unit = _UNIT_SECONDS.get(match.group(2).lower()) if match else None
    if unit is None:
        raise ValueError(f"not a time step: {step!r}")
    seconds = int(match.group(1) or 1) * unit
    if seconds < 1 or DAY_SECONDS % seconds:
        raise ValueError(f"a step must divide 24 hours: {step!r}")
    return seconds


def step_interval(step: str) -> Column:
    """The step as a day-time interval."""
    return F.expr(f"INTERVAL '{step_seconds(step)}' SECOND")


def bucket(time: Column | str, step: str) -> Column:
    """Start of the midnight-aligned slot that holds ``time``."""
    return F.window(time, f"{step_seconds(step)} seconds")["start"]


def day_start(time: Column | str) -> Column:
    """Midnight of the day; by way of DATE, so no session time zone is involved."""
    return F.to_date(time).cast("timestamp_ntz")


def monday_weekday(date: Column | str) -> Column:
    """Weekday with Monday = 0."""
    return F.weekday(date)


def is_weekend(date: Column | str) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def week_number(date: Column | str) -> Column:
    """ISO week."""
    return F.weekofyear(date)


def parse_time(value: Column | str) -> Column:
    """Text to time; unparsable text gives null."""
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast("timestamp_ntz")


def time_text(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def date_text(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def day_name(date: Column | str) -> Column:
    """English day name."""
    return F.date_format(date, "EEEE")


def two_digits(number: Column | str) -> Column:
    column = F.col(number) if isinstance(number, str) else number
    return F.lpad(column.cast("string"), 2, "0")
