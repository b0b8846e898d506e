"""River reversals and cumulative overflow per outfall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import with_date_range
from ..operators.keys import first_known
from ..operators.overflows import with_open_minutes
from ..sources.readers import text_blocks


def reversals(texts: DataFrame, text: str = "value") -> DataFrame:
    """Five-line blocks (dates, three locks, total) -> one row per reversal."""
    blocks = text_blocks(texts, text, 5, ["date_raw", "obrien", "crcw", "wilmette", "total"])
    dated = with_date_range(blocks.filter(F.trim("date_raw") != ""), "date_raw")
    numbers = {c: F.trim(c).try_cast("double") for c in ("obrien", "crcw", "wilmette", "total")}
    return dated.withColumns(numbers).select(
        "crcw", "date_raw", "end_date", "obrien", "start_date", "total", "wilmette", "year"
    )


def outfall_points(features: DataFrame, order: str) -> DataFrame:
    """One row per outfall: the first known value of each attribute, in ``order``.

    ``features`` holds tarp_connection, lat, lon, waterway_reach, associated_plant.
    """
    attributes = ["associated_plant", "lat", "lon", "waterway_reach"]
    return first_known(features, ["tarp_connection"], attributes, order)


def cumulative_by_outfall(events: DataFrame, points: DataFrame) -> DataFrame:
    """Total open minutes of each located outfall, with its position."""
    minutes = with_open_minutes(events).groupBy("outfall_structure").agg(
        F.sum("open_minutes").alias("duration_mins")
    )
    named = points.withColumnRenamed("tarp_connection", "outfall_structure")
    return (
        minutes.join(named, "outfall_structure")
        .withColumn("duration_ms", (F.col("duration_mins") * 60_000).cast("bigint"))
        .withColumnRenamed("outfall_structure", "name")
    )
