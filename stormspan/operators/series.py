"""Regular time series from irregular readings, and rolling totals over them.

Skew.  Readings are first aggregated per (keys, slot) with map-side partial
aggregation, so a station that holds a third of all raw rows is reduced inside
the scan tasks and never meets in one place.  What remains is one row per
station and hour, about 8,800 a year, whatever the reading rate.  Windows over
a station are therefore bounded by the calendar; ``chunk_hours`` splits even
those when a few stations carry very long histories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import hour_number, slot_number, slot_start
from ..functions.clean import finite

#: Slots of a gap generated at a time.
GAP_SLOTS = 10_000
AGGREGATES = {"max": F.max, "sum": F.sum, "mean": F.avg, "count": F.count}


def resample(
    readings: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    *,
    unit: str = "hour",
    how: str = "max",
    label: str = "left",
    fill: float | None = None,
    extend: int = 0,
    out: str | None = None,
) -> DataFrame:
    """One row per key and slot, gaps included.

    Sub-hourly readings accumulate since the hour began, so an hour's rain is
    the ``max``.  Slots are [start, start + 1); ``label='right'`` stamps a slot
    with its end.  Slots between a key's first and last reading that hold none
    get ``fill`` (null by default); ``extend`` adds that many empty slots after
    the last one.  NaN and infinite readings count as missing.

    The gaps are generated from each row's distance to the next row of its key,
    so no calendar table is joined in and the raw readings are scanned once.  A
    gap is laid out in pieces of ``GAP_SLOTS``: one far-off timestamp makes many
    rows, never one row with a long array.
    """
    out = out or value
    keys = list(keys)
    filled = (
        readings.filter(F.col(ts).isNotNull())
        .groupBy(*keys, slot_number(ts, unit).alias("_slot"))
        .agg(AGGREGATES[how](finite(value)).alias(out))
        .withColumn("_next", F.lead("_slot").over(Window.partitionBy(*keys).orderBy("_slot")))
        .withColumn("_last", F.coalesce(F.col("_next") - 1, F.col("_slot") + extend))
        .withColumn("_from", F.explode(F.sequence("_slot", "_last", F.lit(GAP_SLOTS).cast("bigint"))))
        .withColumn(
            "_at", F.explode(F.sequence("_from", F.least(F.col("_from") + (GAP_SLOTS - 1), F.col("_last"))))
        )
    )
    shift = {"left": 0, "right": 1}[label]
    seen = F.when(F.col("_at") == F.col("_slot"), F.col(out))
    if fill is not None:
        seen = F.coalesce(seen, F.lit(fill))
    return filled.select(*keys, slot_start(F.col("_at") + shift, unit).alias(ts), seen.alias(out))


def hourly_max(
    readings: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    *,
    label: str = "right",
    fill: float | None = 0.0,
    **more,
) -> DataFrame:
    """Hourly rain: the largest reading of each hour, stamped with the hour's end."""
    return resample(readings, keys, ts, value, unit="hour", how="max", label=label, fill=fill, **more)


def daily_sum(
    readings: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    *,
    fill: float | None = 0.0,
    **more,
) -> DataFrame:
    """Daily totals; a day without readings totals ``fill``."""
    return resample(readings, keys, ts, value, unit="day", how="sum", fill=fill, **more)


def with_halo(
    series: DataFrame, ts: str, chunk_hours: int, halo_hours: int, chunk: str = "_chunk", halo: str = "_halo"
) -> DataFrame:
    """Assign rows to time chunks, repeating each chunk's tail in the next one.

    Rows flagged ``halo`` exist only so that the next chunk can look back.
    """
    if halo_hours > chunk_hours:
        raise ValueError("a chunk must be at least as long as its halo")
    hour = hour_number(ts)
    home = F.floor(hour / chunk_hours)
    in_tail = F.pmod(hour, F.lit(chunk_hours)) >= chunk_hours - halo_hours
    homes = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
    return series.withColumn("_home", home).withColumn(chunk, F.explode(homes)).withColumn(
        halo, F.col(chunk) != F.col("_home")
    ).drop("_home")


def whole_units(value: str, unit: int) -> Column:
    """A reading in whole units of 1 / ``unit``; null for NaN and infinite ones."""
    return F.round(finite(value) * unit).cast("bigint")


def rolling_column(hours: int) -> str:
    return f"roll_{hours}"


def rolling_totals(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    hours: Sequence[int],
    *,
    full: bool = False,
    digits: int = 4,
    chunk_hours: int | None = None,
) -> DataFrame:
    """Add ``roll_k``: the sum of the last k rows, current row included.

    ``full=False`` accepts shorter windows at the start and skips nulls;
    ``full=True`` gives null until k non-null values are in the window.

    Totals are differences of one running sum, so eleven window lengths cost
    eleven subtractions per row instead of 546 additions.  The running sum is
    kept in whole units of 10**-digits: gauges report hundredths, and whole
    numbers make the difference exact where running sums of doubles drift.
    Use :func:`rolling_frame` for values that need more digits.
    """
    keys, hours = list(keys), list(hours)
    before = series.columns
    parts = list(keys)
    if chunk_hours:
        series = with_halo(series, ts, chunk_hours, max(hours))
        parts.append("_chunk")
    window = Window.partitionBy(*parts).orderBy(ts)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    unit = 10**digits
    units = whole_units(value, unit)
    running = {"_sum": F.coalesce(F.sum(units).over(so_far), F.lit(0).cast("bigint"))}
    if full:
        running["_count"] = F.count(finite(value)).over(so_far)
    series = series.withColumns(running)
    zero = F.lit(0).cast("bigint")
    past = {f"_past_{k}": F.lag("_sum", k).over(window) for k in hours}
    if full:
        past |= {f"_seen_{k}": F.lag("_count", k).over(window) for k in hours}
    series = series.withColumns(past)

    def total(k: int) -> Column:
        amount = (F.col("_sum") - F.coalesce(F.col(f"_past_{k}"), zero)) / F.lit(float(unit))
        if full:
            seen = F.col("_count") - F.coalesce(F.col(f"_seen_{k}"), zero)
            return F.when(seen == k, amount)
        return amount

    if chunk_hours:
        series = series.filter(~F.col("_halo"))
    return series.select(*before, *[total(k).alias(rolling_column(k)) for k in hours])


def rolling_frame(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    rows: int,
    *,
    full: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Rolling sum of one length as a plain ROWS frame over doubles."""
    frame = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(rows - 1), 0)
    total = F.sum(value).over(frame)
    if full:
        total = F.when(F.count(value).over(frame) == rows, total)
    else:
        total = F.coalesce(total, F.lit(0.0))
    return series.withColumn(out or rolling_column(rows), total)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Cumulative sum within a group that the calendar bounds (hours, days, years)."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(frame))


def cumulative_share(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, *, digits: int = 4
) -> DataFrame:
    """Running total, its share of the group's total, and the first wet row.

    ``keys`` must name one storm or one day, so a group is a handful of hours.
    """
    unit = 10**digits
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    units = whole_units(value, unit)
    running, total = F.sum(units).over(so_far), F.sum(units).over(whole)
    return series.withColumns({
        "cumulative": running / F.lit(float(unit)),
        "share": F.try_divide(running.cast("double"), total.cast("double")),
        "first_wet": F.min(F.when(F.col(value) > 0, F.col(ts))).over(whole),
    })


def count_days(df: DataFrame, keys: Sequence[str], ts: str, condition: Column) -> DataFrame:
    """Number of distinct days with a qualifying row."""
    days = df.filter(condition).select(*keys, F.to_date(ts).alias("_day")).distinct()
    return days.groupBy(*keys).agg(F.count("*").alias("days"))
