"""Overflow events: feeds, totals per outfall, rain before an event, overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import day_number, end_of_day, minutes_between, top_of_next_hour
from ..functions.clean import close_time, date_and_time, period_seconds, us_timestamp
from ..functions.lookups import waterway_name
from .scan import running_sums
from .series import resample, rolling_column, rolling_totals

FEED_COLUMNS = (
    "outfall_structure", "outfall_location", "tide_gate", "waterway_reach", "plant",
    "open_time", "close_time", "open_seconds",
)


def current_feed(feed: DataFrame) -> DataFrame:
    """Typed rows of the current feed: US timestamps and ':HH:MM:SS' periods as text."""
    return feed.select(
        "outfall_structure", "outfall_location", "tide_gate", "waterway_reach", "plant",
        us_timestamp("open_text").alias("open_time"),
        us_timestamp("close_text").alias("close_time"),
        period_seconds("period_text").alias("open_seconds"),
    )


def archive_feed(feed: DataFrame) -> DataFrame:
    """Archive rows in the current layout: segment number, date + time, minutes."""
    opened = date_and_time("date", "starttime")
    return feed.select(
        F.col("location").alias("outfall_structure"),
        F.col("location").alias("outfall_location"),
        F.lit("").alias("tide_gate"),
        waterway_name("segment").alias("waterway_reach"),
        F.lit("").alias("plant"),
        opened.alias("open_time"),
        close_time(opened, "duration").alias("close_time"),
        (F.col("duration").cast("bigint") * 60).alias("open_seconds"),
    )


def unify_feeds(current: DataFrame, archive: DataFrame) -> DataFrame:
    return current_feed(current).unionByName(archive_feed(archive))


def with_open_minutes(events: DataFrame, opened: str = "open_time", closed: str = "close_time") -> DataFrame:
    return events.withColumn("open_minutes", minutes_between(opened, closed))


def covered_by_range(opened: str, closed: str, first: str, last: str) -> Column:
    """Events whose opening and closing days lie inside the closed range of days."""
    low, high = (day_number(F.lit(d).cast("date").cast("timestamp_ntz")) for d in (first, last))
    return (day_number(opened) >= low) & (day_number(closed) <= high)


def outfall_totals(
    events: DataFrame, locations: DataFrame, outfall: str, minutes: str, *, top: int = 10
) -> DataFrame:
    """Minutes per located outfall; the ``top`` largest are coloured red, others blue.

    Events are summed per outfall before they meet the locations, and the top
    rows come from a distributed top-k.
    """
    totals = (
        events.groupBy(outfall).agg(F.sum(minutes).alias("total_minutes")).join(locations, outfall)
    )
    largest = (
        totals.orderBy(F.desc("total_minutes"), outfall).limit(top).select(outfall, F.lit("red").alias("_top"))
    )
    flagged = totals.join(largest, outfall, "left")
    return flagged.withColumn("color", F.coalesce("_top", F.lit("blue"))).drop("_top")


def rain_before(
    events: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    readings: DataFrame,
    ts: str,
    value: str,
    *,
    hours: int = 24,
    until: str = "hour",
    out: str = "prior_rain",
) -> DataFrame:
    """Rain in the ``hours`` hourly labels that end with the event's hour or day.

    The label is the top of the next hour, or with ``until='day'`` the midnight
    that ends the event's day.  Rolling totals are made once per station and
    hour; events then find theirs by an equi-join on (station, label) instead of
    a range join, and the label in the key spreads a hot station.  The series is
    extended so that events shortly after the last reading still see it; with no
    rain in reach the sum is 0.
    """
    keys = list(keys)
    label = {"hour": top_of_next_hour, "day": end_of_day}[until](event_ts)
    series = resample(readings, keys, ts, value, label="right", fill=0.0, extend=hours - 1, out="_rain")
    totals = rolling_totals(series, keys, ts, "_rain", [hours]).select(
        *keys, F.col(ts).alias("_label"), F.col(rolling_column(hours)).alias(out)
    )
    found = events.withColumn("_label", label).join(totals, [*keys, "_label"], "left")
    return found.select(*events.columns, F.coalesce(out, F.lit(0.0)).alias(out))


def overlap_counts(
    intervals: DataFrame, keys: Sequence[str], start: str, end: str, *, chunk: int = 366
) -> DataFrame:
    """How many other intervals of its key each interval overlaps (closed ends).

    Counted as starts up to my end, less ends before my start, less myself: no
    pairs are formed.  Starts and ends are counted per (key, time) first; the
    running counts over the distinct times of a key are made per ``chunk`` (of
    days, or of a numeric time's own units) with what the chunks before it hold,
    so a hot key's times are shared by many tasks.

    A null end is an interval still open: it overlaps whatever starts after it.
    An interval without a start has a null count and counts for no other.  Null
    keys equal each other.
    """
    keys = list(keys)
    numeric = isinstance(intervals.schema[start].dataType, T.NumericType)
    place = F.floor((F.col("_t") if numeric else day_number("_t")) / chunk)

    def at(time: str, started: int) -> Column:
        return F.struct(F.col(time).alias("_t"), F.lit(started).alias("_s"), F.lit(1 - started).alias("_e"))

    times = (
        intervals.filter(F.col(start).isNotNull())
        .select(*keys, F.inline(F.array(at(start, 1), at(end, 0))))
        .groupBy(*keys, place.alias("_chunk"), "_t")
        .agg(F.sum("_s").alias("_s"), F.sum("_e").alias("_e"))
    )
    counts = {"_started": F.col("_s"), "_ended": F.col("_e")}
    times = running_sums(times, keys, "_chunk", "_t", counts).withColumn("_ended", F.col("_ended") - F.col("_e"))

    def looked_up(found: DataFrame, at: str, count: str) -> DataFrame:
        names = [*keys, at]
        side = times.select(*[F.col(c).alias(f"_{at}_{i}") for i, c in enumerate((*keys, "_t"))], count)
        return found.join(side, [F.col(c).eqNullSafe(F.col(f"_{at}_{i}")) for i, c in enumerate(names)], "left")

    counted = looked_up(looked_up(intervals, end, "_started"), start, "_ended")
    others = F.when(F.col(start).isNotNull(), F.col("_started") - F.col("_ended") - 1)
    return counted.select(*intervals.columns, others.alias("overlaps"))
