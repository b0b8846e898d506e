"""Scans over a key's history in two levels, so that a history is shared by many tasks.

A window per key sends the whole history of a hot key to one task.  Here rows are folded
per (keys, chunk), where a chunk is a piece of the order such as a year; what has to cross
a chunk's border is a small summary, and only summaries meet per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


def running_sums(
    rows: DataFrame, keys: Sequence[str], chunk: str, order: str, sums: Mapping[str, Column]
) -> DataFrame:
    """Add running sums in (chunk, order), the current row included; nulls come last.

    Each chunk is summed by itself and joined to the total of the chunks before it: one
    summary row per key and non-empty chunk.  Null keys equal each other.  The values must
    have no nulls, and ties in the order are summed in any order.
    """
    keys = list(keys)
    place = [*keys, chunk]
    inside = Window.partitionBy(*place).orderBy(F.asc_nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*place).agg(*[F.sum(c).alias(f"_total_{i}") for i, c in enumerate(sums.values())])
    carried = totals.select(
        *[F.col(c).alias(f"_of_{i}") for i, c in enumerate(place)],
        *[F.sum(f"_total_{i}").over(across).alias(f"_carry_{i}") for i in range(len(sums))],
    )
    near = rows.withColumns({out: F.sum(c).over(inside) for out, c in sums.items()})
    met = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(place)]
    whole = [
        (F.col(out) + F.coalesce(f"_carry_{i}", F.lit(0))).alias(out) for i, out in enumerate(sums)
    ]
    return near.join(carried, met, "left").select(*rows.columns, *whole)


def fold_segments(
    rows: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: str,
    opens: Column,
    keep: Column,
    folds: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """One row per key and segment: a row where ``opens`` holds begins the next segment.

    ``folds`` names its outputs as (sum, min or max, value).  Rows without ``keep`` count
    for the borders and are folded into nothing.  A segment may span any number of chunks:
    its pieces, one row per chunk and segment, are merged per key, so the merging task
    holds a row per piece and not the rows.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(chunk, "_piece").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        rows.withColumn("_piece", F.sum(opens.cast("int")).over(inside))
        .filter(keep)
        .groupBy(*keys, chunk, "_piece")
        .agg(*[FOLDS[how](value).alias(out) for out, (how, value) in folds.items()])
    )
    # Piece 0 goes on with the last segment that an earlier chunk opened.
    opened = F.when(F.col("_piece") > 0, F.struct(F.col(chunk).alias("chunk"), F.col("_piece").alias("piece")))
    return (
        pieces.withColumn("_segment", F.last(opened, ignorenulls=True).over(across))
        .groupBy(*keys, "_segment")
        .agg(*[FOLDS[how](out).alias(out) for out, (how, _) in folds.items()])
        .drop("_segment")
    )
