"""Calendar arithmetic on wall-clock timestamps.

Station times are naive local times, so slots are counted from the date and
hour fields alone.  That keeps the result independent of the session time zone
(no daylight-saving jumps) and turns time slots into plain longs, which are
cheaper to group, join and generate than timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_HOURS = {"hour": 1, "day": 24}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(ts: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(F.to_date(_col(ts)), F.lit("1970-01-01").cast("date")).cast("bigint")


def hour_number(ts: Column | str) -> Column:
    """Hours since 1970-01-01 00:00 on the wall clock."""
    return day_number(ts) * 24 + F.hour(_col(ts))


def slot_number(ts: Column | str, unit: str) -> Column:
    return {"hour": hour_number, "day": day_number}[unit](ts)


def hour_start(hours: Column | str) -> Column:
    """Inverse of :func:`hour_number`: the timestamp at which that hour begins."""
    hours = _col(hours)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return epoch + F.make_dt_interval(F.floor(hours / 24).cast("int"), F.pmod(hours, F.lit(24)).cast("int"), zero)


def slot_start(slots: Column | str, unit: str) -> Column:
    return hour_start(_col(slots) * SLOT_HOURS[unit])


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 on the wall clock."""
    ts = _col(ts)
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (
        (hour_number(ts) * 60 + F.minute(ts)) * F.lit(60_000_000)
        + (seconds * 1_000_000).cast("bigint")
    )


def micros_between(start: Column | str, end: Column | str) -> Column:
    return epoch_micros(end) - epoch_micros(start)


def whole_units_between(start: Column | str, end: Column | str, unit: str) -> Column:
    """Elapsed time in whole seconds, minutes or hours, fractions cut off."""
    size = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}[unit]
    elapsed = micros_between(start, end)
    return ((elapsed - elapsed % size) / size).cast("bigint")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in fractional hours."""
    return micros_between(start, end) / F.lit(3_600_000_000.0)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in fractional minutes."""
    return micros_between(start, end) / F.lit(60_000_000.0)


def top_of_next_hour(ts: Column | str) -> Column:
    """10:00 and 10:59 both give 11:00."""
    return hour_start(hour_number(ts) + 1)


def end_of_day(ts: Column | str) -> Column:
    """Midnight at the end of the day the timestamp lies in."""
    return hour_start((day_number(ts) + 1) * 24)


def add_minutes(ts: Column | str, minutes: Column | str) -> Column:
    minutes = _col(minutes)
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def season(ts: Column | str) -> Column:
    """Astronomical season by fixed calendar days."""
    day = F.month(_col(ts)) * 100 + F.dayofmonth(_col(ts))
    # Last day (month * 100 + day) of each season within a year.
    return (
        F.when(day <= 320, "winter")
        .when(day <= 620, "spring")
        .when(day <= 922, "summer")
        .when(day <= 1220, "autumn")
        .when(day <= 1231, "winter")
    )


# The report buckets, each given by its label and last year.  The
# last label of each list is open at the top.
THREE_BUCKETS = (("1970-1985", 1985), ("1986-2000", 2000), ("2001-2015", None))
NINE_BUCKETS = (
    ("1970-1975", 1975),
    ("1976-1980", 1980),
    ("1981-1985", 1985),
    ("1986-1990", 1990),
    ("1991-1995", 1995),
    ("1996-2000", 2000),
    ("2001-2005", 2005),
    ("2006-2010", 2010),
    ("2011-2015", None),
)


def year_bucket(year: Column | str, buckets: tuple = THREE_BUCKETS) -> Column:
    """Label of the first bucket whose last year is not before ``year``."""
    year = _col(year)
    chain = F
    for label, last in buckets:
        if last is None:
            return chain.otherwise(label)
        chain = chain.when(year <= last, label)
    return chain


def fixed_bucket(year: Column | str, first: int, width: int) -> Column:
    """Start year of the fixed-width bucket that holds ``year``."""
    return (F.lit(first) + F.floor((_col(year) - first) / width) * width).cast("int")


def on_day(ts: Column | str, day: str) -> Column:
    """Rows of one calendar day, as a range so that it reaches the scan."""
    return within_days(ts, day, day)


def within_days(ts: Column | str, first: str, last: str) -> Column:
    """Closed range of dates: the last day counts to its end."""
    ts = _col(ts)
    low = F.lit(first + " 00:00:00").cast("timestamp_ntz")
    high = F.lit(last + " 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(1))
    return (ts >= low) & (ts < high)
