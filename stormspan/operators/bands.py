"""Bands whose limits come from a table, where they are too many for a CASE expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import finite
from .series import rolling_column, rolling_totals


def in_bands(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    limits: DataFrame,
    limit: str,
    label: str,
    *,
    scale: Callable[[Column], Column] = lambda x: x,
    per_band: int = 1,
) -> DataFrame:
    """Add the ``label`` of the band that holds ``value``.

    A limit's band reaches up to the next limit of its ``keys``, the last one has no upper
    end; a value below every limit, a missing value and a key without limits get null.  Of
    equal limits the greatest label counts; null keys equal each other.

    The range from a key's lowest to highest limit is cut into ``per_band`` equal cells per
    band.  A band is listed once in each cell it touches, less than ``per_band`` + 1 times
    its number in all, and a value meets the bands of its own cell by an equi-join, so no
    range condition is joined on alone.  ``scale`` is any rising function of a value that
    spreads the limits more evenly (``F.log`` for limits over many orders of magnitude):
    a value is compared with the limits that share its cell.
    """
    keys = list(keys)
    own = [f"_key_{i}" for i in range(len(keys))]
    met = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    known = limits.select(
        *[F.col(k).alias(o) for k, o in zip(keys, own)], finite(limit).cast("double").alias("_low"), F.col(label).alias("_label")
    )
    known = known.filter("_low is not null").groupBy(*own, "_low").agg(F.max("_label").alias("_label"))
    low, high = scale(F.col("_low")), scale(F.col("_high"))
    grid = known.groupBy(*own).agg(
        F.min(low).alias("_first"), F.max(low).alias("_last"), (F.count("*") * per_band).alias("_cells")
    )
    width = (F.col("_last") - F.col("_first")) / F.col("_cells")
    grid = grid.select(*own, "_first", "_last", F.when(width > 0, width).otherwise(1.0).alias("_width"))

    def cell(x: Column) -> Column:
        # Rounding keeps the order, so a value never falls outside of its band's cells.
        return F.floor((F.least(x, F.col("_last")) - F.col("_first")) / F.col("_width"))

    ends = known.withColumn("_high", F.lead("_low").over(Window.partitionBy(*own).orderBy("_low")))
    spread = F.sequence(cell(low), cell(F.coalesce(high, F.col("_last"))))
    sides = [F.col(o).alias(f"_of_{i}") for i, o in enumerate(own)]
    same = [F.col(o).eqNullSafe(F.col(f"_of_{i}")) for i, o in enumerate(own)]
    listed = (
        ends.join(grid.select(*sides, "_first", "_last", "_width"), same)
        .select(*own, "_low", "_high", "_label", F.explode(spread).alias("_in"))
    )
    seen = finite(value).cast("double")
    placed = rows.join(grid, met, "left").withColumn("_value", seen)
    placed = placed.withColumn("_cell", cell(scale(F.col("_value")))).drop(*own, "_first", "_last", "_width")
    inside = (F.col("_value") >= F.col("_low")) & (F.col("_high").isNull() | (F.col("_value") < F.col("_high")))
    found = placed.join(listed, [*met, F.col("_cell") == F.col("_in"), inside], "left")
    return found.select(*[c for c in rows.columns if c != label], F.col("_label").alias(label))


def windows_in_bands(
    series: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    hours: Sequence[int],
    limits: DataFrame,
    *,
    full: bool = False,
    **more,
) -> DataFrame:
    """Every window end that reaches a class of ``limits`` (duration_hrs, n, limit).

    The counterpart of ``storms.classified_windows`` for limits that only a table holds;
    ``hours`` names the durations to look at.
    """
    keys = list(keys)
    rolled = rolling_totals(series, keys, ts, value, hours, full=full, **more)
    spread = F.array(*[
        F.struct(F.lit(k).alias("duration_hrs"), F.col(rolling_column(k)).alias("inches")) for k in hours
    ])
    windows = rolled.select(*keys, F.col(ts).alias("end_time"), F.inline(spread))
    return in_bands(windows, ["duration_hrs"], "inches", limits, "limit", "n").filter("n is not null")
