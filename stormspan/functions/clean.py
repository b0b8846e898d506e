"""Coercion of dirty text columns.  All casts are ``try_`` casts: Spark 4 runs in
ANSI mode and a plain cast of 'T' to a number would stop the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import _col, add_minutes


def unreadable(text: Column | str) -> Column:
    """True where a non-null text is not a number."""
    text = _col(text)
    return text.isNotNull() & text.try_cast("double").isNull()


def finite(value: Column | str) -> Column:
    """The value, or null where it is NaN or infinite (NaN orders above infinity)."""
    value = _col(value)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def strict_precip(df: DataFrame, value: str, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Zero every reading whose timestamp carries an unreadable one.

    'T' (trace) and flagged values such as '0.05s' count as unreadable, and all
    rows that share their station and timestamp are zeroed with them.  Nulls on
    other timestamps stay null, and so do 'NaN' and infinite readings.  Null
    keys and timestamps equal each other.  The instants are made distinct with
    map-side aggregation before they meet the readings, so the raw rows are not
    gathered per station.
    """
    at = [*keys, ts]
    bad = df.filter(unreadable(value)).select(*[F.col(c).alias(f"_bad_{i}") for i, c in enumerate(at)]).distinct()
    met = [F.col(c).eqNullSafe(F.col(f"_bad_{i}")) for i, c in enumerate(at)]
    marked = df.join(bad.withColumn("_bad", F.lit(True)), met, "left")
    read = F.when(F.col("_bad"), F.lit(0.0)).otherwise(finite(F.col(value).try_cast("double")))
    return marked.withColumn(value, read).select(*df.columns)


def lenient_precip(text: Column | str) -> Column:
    """Keep digits and dots, then read a number: '0.05s' -> 0.05, 'T' -> 0."""
    digits = F.regexp_replace(_col(text), "[^0-9.]+", "")
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def percent(text: Column | str) -> Column:
    """'19.60%' -> 19.6; thousands commas are dropped."""
    return number(F.regexp_replace(_col(text), "%$", ""))


def number(text: Column | str) -> Column:
    """A number that may carry thousands commas: '1,090' -> 1090."""
    return F.regexp_replace(_col(text), ",", "").try_cast("double")


def area_key(text: Column | str) -> Column:
    """Canonical area name: upper case, letters and blanks only."""
    return F.regexp_replace(F.upper(_col(text)), "[^A-Z ]+", "")


def canonical_city(df: DataFrame, city: str, spellings: Sequence[str], name: str = "Chicago") -> DataFrame:
    """Keep the rows whose city is one of the known spellings, under one name."""
    return df.filter(F.col(city).isin(list(spellings))).withColumn(city, F.lit(name))


def zip_key(code: Column | str) -> Column:
    """Numeric zip to text; a missing zip becomes '0', a group of its own."""
    return F.coalesce(_col(code), F.lit(0)).cast("int").cast("string")


def period_seconds(text: Column | str) -> Column:
    """':HH:MM:SS' -> seconds."""
    parts = F.split(F.substring(_col(text), 2, 100), ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def wall_clock(text: Column | str) -> Column:
    """'2016-08-20 08:40' or with seconds -> timestamp, null when unreadable.

    A cast to a zoneless timestamp, so no session time zone and no
    daylight-saving gap comes into it.
    """
    return _col(text).try_cast("timestamp_ntz")


def us_timestamp(text: Column | str) -> Column:
    """'8/20/2016 8:40:00 AM' -> timestamp, null when unreadable.

    The date parts are put in order and 12 o'clock becomes 0; afternoons are
    added as an interval, so the text is taken apart only once.
    """
    text = _col(text)
    shape = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (1[0-2]|0?[1-9]):(\d{2}:\d{2}) [AaPp][Mm]\s*$"
    clock = F.replace(F.regexp_replace(text, shape, "$3-$1-$2 $4:$5"), F.lit(" 12:"), F.lit(" 0:"))
    afternoon = F.when(F.upper(F.right(F.rtrim(text), F.lit(2))) == "PM", 12).otherwise(0)
    return wall_clock(clock) + F.make_dt_interval(F.lit(0), afternoon)


def date_and_time(date: Column | str, time: Column | str) -> Column:
    """Date text and time text -> timestamp, null when unreadable."""
    return wall_clock(F.concat(_col(date), F.lit(" "), _col(time)))


def close_time(opened: Column | str, minutes: Column | str) -> Column:
    """Opening time plus a duration in minutes."""
    return add_minutes(opened, minutes)


def with_date_range(df: DataFrame, text: str) -> DataFrame:
    """Irregular date ranges -> columns start_date, end_date, year.

    Accepts 'm/d/y', 'm/d-d/y' and 'm/d-m/d/y'.  Two-digit years above 20 lie in
    the 1900s, the rest in the 2000s.  A single day has no end date; a text of
    another shape gives nulls.
    """
    shape = r"^\s*(\d+)/(\d+)(?:-(?:(\d+)/)?(\d+))?/(\d+)\s*$"
    names = ("_m1", "_d1", "_m2", "_d2", "_y")
    parts = df.withColumns({
        name: F.regexp_extract(text, shape, i + 1).try_cast("int") for i, name in enumerate(names)
    })
    year = F.col("_y")
    parts = parts.withColumn(
        "year", F.when(year >= 1985, year).when(year > 20, year + 1900).otherwise(year + 2000)
    )
    return parts.withColumns({
        "start_date": _date("year", "_m1", "_d1"),
        "end_date": _date("year", F.coalesce("_m2", "_m1"), "_d2"),
    }).drop(*names)


def _date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date of three numbers; null when one is missing or the day does not exist."""
    parts = [_col(c).cast("string") for c in (year, month, day)]
    dashed = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])
    return dashed.try_cast("date")


def shifted_micros(micros: Column | str, hours_back: int = 5) -> Column:
    """Epoch microseconds (GMT) -> wall clock, moved back a fixed number of hours."""
    moved = _col(micros) - F.lit(hours_back * 3_600_000_000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    day = F.lit(86_400_000_000)
    rest = F.pmod(moved, day)
    days = ((moved - rest) / day).cast("int")
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)"))


def valid_us_date(text: Column | str, first_year: int = 2009, last_year: int = 2016) -> Column:
    """M/D/YYYY with month 1-12, day 1-31 and a year in the covered range."""
    parts = F.split(_col(text), "/")
    month, day, year = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
    ok = (
        (F.size(parts) == 3)
        & month.between(1, 12)
        & day.between(1, 31)
        & year.between(first_year, last_year)
    )
    return F.coalesce(ok, F.lit(False))


def duration_hours(label: Column | str) -> Column:
    """'10-day' -> 240.0, '3-hr' -> 3.0, '30-min' -> 0.5."""
    label = _col(label)
    amount = F.regexp_extract(label, r"^(\d+)-", 1).try_cast("double")
    unit = F.regexp_extract(label, r"-(\w+)$", 1)
    return F.when(unit == "day", amount * 24).when(unit == "hr", amount).when(unit == "min", amount / 60)


def return_period_number(label: Column | str) -> Column:
    """'25-year' -> 25."""
    return F.regexp_extract(_col(label), r"^(\d+)-year$", 1).try_cast("int")


def present_or_missing(value: Column | str, sentinel: float = 0.0) -> Column:
    """Sentinel and NaN readings become null."""
    value = _col(value)
    return F.when(~F.isnan(value) & (value != sentinel), value)
