"""Previous and next row in time, without gathering a key in one task.

A plain ``lag`` over a station sends every raw row of that station to one task.
Here rows are windowed per (keys, time chunk); only the first and last row of a
chunk need a neighbour from outside it, and those come from a summary with one
row per non-empty chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import epoch_micros, hour_number, hours_between
from ..functions.radar import depth_inches


def with_neighbours(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    carry: Sequence[str] = (),
    *,
    chunk_hours: int = 1,
    previous: bool = True,
    following: bool = False,
) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` for the timestamp and the ``carry`` columns.

    Order is (ts, tie); rows without a timestamp are left out; null keys equal
    each other.  With nothing to
    carry the summary is a plain minimum and maximum of the timestamp, which is
    hashed; carried columns need a maximum over structs, which sorts.
    """
    keys = list(keys)
    fields = [ts, *[c for c in carry if c != ts]]
    chunked = rows.filter(F.col(ts).isNotNull()).withColumn(
        "_chunk", F.floor(hour_number(ts) / chunk_hours)
    )
    place = F.struct(ts, tie, *[c for c in fields if c not in (ts, tie)]) if carry else F.struct(ts)
    edge = place if carry else F.col(ts)
    sides = {}
    if previous:
        sides["prev"] = (F.lag, F.max(edge))
    if following:
        sides["next"] = (F.lead, F.min(edge))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, tie)
    across = Window.partitionBy(*keys).orderBy("_chunk")
    edges = chunked.groupBy(*keys, "_chunk").agg(
        *[extreme.alias(f"_edge_{side}") for side, (_, extreme) in sides.items()]
    )
    edges = edges.select(
        *[F.col(c).alias(f"_of_{i}") for i, c in enumerate((*keys, "_chunk"))],
        *[step(f"_edge_{side}").over(across).alias(f"_far_{side}") for side, (step, _) in sides.items()],
    )
    near = chunked.withColumns(
        {f"_near_{side}": step(place).over(inside) for side, (step, _) in sides.items()}
    )
    met = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate((*keys, "_chunk"))]
    joined = near.join(edges, met, "left")

    def found(side: str, field: str) -> Column:
        far = F.col(f"_far_{side}")
        return F.coalesce(F.col(f"_near_{side}")[field], far[field] if carry else far).alias(f"{side}_{field}")

    return joined.select(*rows.columns, *[found(side, field) for side in sides for field in fields])


def gap_edges(
    rows: DataFrame, keys: Sequence[str], ts: str, tie: str, longest_seconds: int, **more
) -> DataFrame:
    """Rows on either side of a gap longer than ``longest_seconds``."""
    limit = longest_seconds * 1_000_000
    near = with_neighbours(rows, keys, ts, tie, previous=True, following=True, **more)
    after = epoch_micros(ts) - epoch_micros(f"prev_{ts}") > limit
    before = epoch_micros(f"next_{ts}") - epoch_micros(ts) > limit
    edge = (
        F.when(after & before, "both").when(after, "after_gap").when(before, "before_gap")
    )
    return near.withColumn("edge", edge).filter("edge is not null").select(*rows.columns, "edge")


def without_first(rows: DataFrame, keys: Sequence[str], ts: str, tie: str, **more) -> DataFrame:
    """Drop each key's earliest row, which has no predecessor to measure from."""
    near = with_neighbours(rows, keys, ts, tie, **more)
    return near.filter(F.col(f"prev_{ts}").isNotNull())


def rate_to_depth(
    rows: DataFrame, keys: Sequence[str], ts: str, tie: str, rate: str, **more
) -> DataFrame:
    """Inches fallen since the previous reading, at the current rate in mm per hour."""
    near = without_first(rows, keys, ts, tie, **more)
    hours = hours_between(f"prev_{ts}", ts)
    return near.withColumn("hours", hours).withColumn("depth", depth_inches(rate, "hours")).select(
        *rows.columns, "hours", "depth"
    )
