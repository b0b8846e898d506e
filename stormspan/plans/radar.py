"""Decoded radar sweeps to a table of scan times by zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import add_minutes
from ..functions.radar import CITY_BOX, BoundingBox, scan_inches
from ..operators.spatial import first_polygon, gates_to_points, zone_pivot
from ..sources.readers import time_from_name


def rain_grid(
    sweeps: DataFrame,
    polygons: DataFrame,
    zones: Sequence[str],
    *,
    box: BoundingBox = CITY_BOX,
    hours_back: int = 5,
    cell: float = 0.05,
) -> DataFrame:
    """Mean inches per scan and zone, one column per zone.

    Scan times come from the file names and are moved back by ``hours_back``.
    Only the averages are shuffled: placing, boxing and locating are narrow.
    """
    scan = add_minutes(time_from_name("path"), F.lit(-60 * hours_back))
    timed = sweeps.withColumn("timestamp", scan)
    points = gates_to_points(timed, ["timestamp"], box=box)
    located = first_polygon(points, polygons, cell=cell).withColumn("precip", scan_inches("dbz"))
    return zone_pivot(located, ["timestamp"], zones, "precip")
