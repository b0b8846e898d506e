"""Station readings to n-year storms and their frequency reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import season
from ..functions.clean import lenient_precip, strict_precip, wall_clock
from ..functions.thresholds import Band, bands
from ..operators.reshape import count_grid
from ..operators.series import hourly_max
from ..operators.storms import rain_events, unique_storms

# The columns of a raw station file that are used.
READINGS_SCHEMA = "STATION string, STATION_NAME string, DATE string, HOURLYPrecip string"
# Hourly precipitation is recorded from this day on.
FIRST_DAY = "1970-01-01"


def clean_readings(raw: DataFrame, *, strict: bool = True, first_day: str = FIRST_DAY) -> DataFrame:
    """Raw station rows -> (station, ts, precip), from ``first_day`` on.

    ``strict`` zeroes every reading at a station's instant with an unreadable
    one; otherwise digits are kept from flagged readings.
    """
    readings = raw.select(
        F.col("STATION").alias("station"),
        wall_clock("DATE").alias("ts"),
        F.col("HOURLYPrecip").alias("precip"),
    ).filter(F.col("ts") >= F.lit(first_day + " 00:00:00").cast("timestamp_ntz"))
    if strict:
        return strict_precip(readings, "precip", "ts", ["station"])
    return readings.withColumn("precip", lenient_precip("precip"))


def station_storms(readings: DataFrame, limits: Sequence[Band] | None = None, **more) -> DataFrame:
    """Non-overlapping n-year storms per station, with the year they start in."""
    hourly = hourly_max(readings, ["station"], "ts", "precip")
    storms = unique_storms(hourly, ["station"], "ts", "precip", limits or bands(), **more)
    return storms.withColumn("year", F.year("start_time"))


def station_events(readings: DataFrame) -> DataFrame:
    """Rain events per station with intensity, year and season."""
    hourly = hourly_max(readings, ["station"], "ts", "precip")
    return rain_events(hourly, ["station"], "ts", "precip").withColumns({
        "avg_intensity": F.try_divide("total_precip", "duration_hrs"),
        "year": F.year("start_time"),
        "season": season("start_time"),
    })


def storms_by_year(storms: DataFrame, first: int, last: int, periods: Sequence[int] = (1, 2, 5, 10, 25, 50, 100)) -> DataFrame:
    """Years x return periods, zeros included, columns named '<n>-year'."""
    named = storms.withColumn("class", F.concat(F.col("n").cast("string"), F.lit("-year")))
    return count_grid(named, "year", first, last, "class", [f"{n}-year" for n in periods])


def storms_by_season(storms: DataFrame, first: int, last: int) -> DataFrame:
    """Years x seasons, zeros included."""
    dated = storms.withColumn("season", season("start_time"))
    return count_grid(dated, "year", first, last, "season", ["winter", "spring", "summer", "autumn"])
