"""File sinks.  Intermediates should be Parquet; these are the published formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """CSV with a header and no row index, optionally one folder per group value.

    Rows are clustered by the partition columns first, so each task writes few
    folders.  The clustering is a rebalance, which adaptive execution splits
    where a folder holds many rows, by their measured size.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_json_records(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """One JSON object per line; nulls are written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def feature(geometry: Column, properties: Sequence[str]) -> Column:
    """A GeoJSON feature as JSON text."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            geometry.alias("geometry"),
            F.struct(*properties).alias("properties"),
        )
    )


def point_geometry(lon: str = "lon", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def polygon_geometry(ring: str = "ring") -> Column:
    corners = F.transform(ring, lambda p: F.array(p.getField("x"), p.getField("y")))
    return F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates"))


def parts_geometry(parts: str = "parts") -> Column:
    """Every part with all its rings."""
    corner = lambda p: F.array(p.getField("x"), p.getField("y"))
    rings = F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, corner)))
    return F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates"))


def write_features(df: DataFrame, geometry: Column, properties: Sequence[str], path: str, *, mode: str = "errorifexists") -> None:
    """Line-delimited GeoJSON: one feature per line, written in parallel.

    A single FeatureCollection document would have to pass through one task.
    """
    df.select(feature(geometry, properties).alias("value")).write.mode(mode).text(path)
