"""Radar sweeps to points, and points to polygons.

A sweep table has one row per ray: site_lat, site_lon, azimuth (degrees),
first_gate and gate_width (km), gates array<double> (dBZ, 0 or NaN = missing).
A polygon table has one row per polygon: zone, pos (its place in the list) and
either ring array<struct<x, y>> (x = lon, y = lat; closed or not) or parts, an
array of polygons of which each is an array of rings, the outer one and holes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.radar import (
    CLARKE_1866,
    DEFAULT_SITE,
    BoundingBox,
    Ellipsoid,
    add_lat_lon,
    add_ray_terms,
    at_position,
    rain_rate,
    sphere_lat_lon,
)


def gates_to_points(
    sweeps: DataFrame,
    keep: Sequence[str],
    *,
    floor_dbz: float | None = 20.0,
    box: BoundingBox | None = None,
    ellipsoid: Ellipsoid | None = CLARKE_1866,
) -> DataFrame:
    """One row per echo above ``floor_dbz``: ``keep`` columns, gate, dbz, lat, lon.

    ``ellipsoid=None`` places gates on a sphere.  Everything is expressions on
    one exploded row, with no shuffle and no Python: per-ray trigonometry runs
    before the explode, gates without an echo are dropped before any per-gate
    trigonometry, and the bounding box cuts before the polygons are asked.
    """
    rays = sweeps.withColumns({
        "site_lat": F.coalesce("site_lat", F.lit(DEFAULT_SITE[0])),
        "site_lon": F.coalesce("site_lon", F.lit(DEFAULT_SITE[1])),
    })
    if ellipsoid is not None:
        rays = add_ray_terms(rays, ellipsoid)
    gates = rays.select("*", F.posexplode("gates").alias("gate", "dbz")).drop("gates")
    echo = F.col("dbz").isNotNull() & ~F.isnan("dbz") & (F.col("dbz") != 0)
    if floor_dbz is not None:
        echo = echo & (F.col("dbz") > floor_dbz)
    gates = gates.filter(echo).withColumn(
        "_metres", (F.col("first_gate") + F.col("gate") * F.col("gate_width")) * 1000
    )
    keep = (*keep, "gate", "dbz")
    if ellipsoid is not None:
        points = add_lat_lon(gates, "_metres", keep, ellipsoid)
    else:
        place = sphere_lat_lon(F.col("site_lat"), F.col("site_lon"), F.col("azimuth"), F.col("_metres"))
        points = at_position(gates, keep, *place)
    return points.filter(box.holds("lat", "lon")) if box else points


#: Fine cells along a side of a coarse one, and the share of a cell by which edges are widened.
FINER, MARGIN = 8, 1e-6


def edges(polygons: DataFrame) -> DataFrame:
    """One row per edge of any ring of any part: pos, zone, x1, y1, x2, y2."""
    rings = F.flatten("parts") if "parts" in polygons.columns else F.array("ring")
    points = F.col("_ring")
    follower = F.transform(
        points,
        lambda p, i: F.struct(
            p.getField("x").cast("double").alias("x1"),
            p.getField("y").cast("double").alias("y1"),
            F.get(points, F.pmod(i + 1, F.size(points))).getField("x").cast("double").alias("x2"),
            F.get(points, F.pmod(i + 1, F.size(points))).getField("y").cast("double").alias("y2"),
        ),
    )
    return polygons.select("pos", "zone", F.explode(rings).alias("_ring")).select("pos", "zone", F.inline(follower))


def crosses(x: Column, y: Column, of: Callable[[str], Column] = F.col) -> Column:
    """Whether an edge (``of`` gives its x1, y1, x2, y2) lies to the right of the point.

    A point with an odd number of such edges is inside.  Upper and right borders
    count as inside, lower and left ones as outside.  Holes and further parts
    need nothing else: their edges are counted with the others.
    """
    x1, y1, x2, y2 = (of(c) for c in ("x1", "y1", "x2", "y2"))
    at = F.try_divide((y - y1) * (x2 - x1), y2 - y1) + x1
    in_band = (y > F.least(y1, y2)) & (y <= F.greatest(y1, y2))
    return in_band & (x <= F.greatest(x1, x2)) & ((x1 == x2) | F.coalesce(x <= at, F.lit(False)))


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")


def edge_bands(sides: DataFrame, size: float) -> DataFrame:
    """Each edge in every line of cells that it touches (``cell_y``)."""
    slack = F.lit(size * MARGIN)
    low, high = F.least("y1", "y2") - slack, F.greatest("y1", "y2") + slack
    return sides.withColumn("cell_y", F.explode(F.sequence(_cell(low, size), _cell(high, size))))


def covering(bands: DataFrame, size: float) -> DataFrame:
    """(pos, zone, cell_x, cell_y, sure) of the cells that a polygon's edges touch
    (not sure) and of cells wholly inside it (sure); of equal cells, not sure holds.

    An edge touches the cells along its stretch within a line of cells.  Any other
    cell is inside or outside as a whole, as its middle is: the crossings of a
    line's middle, in order, open and close the polygon in turn.
    """
    slack = F.lit(size * MARGIN)
    low, high = F.col("cell_y") * F.lit(size) - slack, (F.col("cell_y") + 1) * F.lit(size) + slack

    def on_edge(y: Column) -> Column:
        share = F.try_divide(y - F.col("y1"), F.col("y2") - F.col("y1"))
        at = F.col("x1") + share * (F.col("x2") - F.col("x1"))
        return F.least(F.greatest(at, F.least("x1", "x2")), F.greatest("x1", "x2"))

    level = F.col("y1") == F.col("y2")
    ends = [F.when(level, F.col(corner)).otherwise(on_edge(y)) for corner, y in (("x1", low), ("x2", high))]
    along = F.sequence(_cell(F.least(*ends) - slack, size), _cell(F.greatest(*ends) + slack, size))
    touched = bands.select("pos", "zone", F.explode(along).alias("cell_x"), "cell_y", F.lit(False).alias("sure"))
    middle = (F.col("cell_y") + 0.5) * F.lit(size)
    crossed = bands.filter((middle > F.least("y1", "y2")) & (middle <= F.greatest("y1", "y2"))).withColumn("_x", on_edge(middle))
    line = Window.partitionBy("pos", "zone", "cell_y").orderBy("_x")
    spans = crossed.withColumns({"_n": F.row_number().over(line), "_until": F.lead("_x").over(line)}).filter("_n % 2 = 1")
    between = F.sequence(_cell(F.col("_x"), size), _cell(F.col("_until"), size))
    inner = spans.select("pos", "zone", F.explode(between).alias("cell_x"), "cell_y", F.lit(True).alias("sure"))
    return touched.unionByName(inner)


def _odd(sides: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(sides, lambda e: crosses(x, y, e.getField))) % 2 == 1


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, *, x: str = "lon", y: str = "lat", cell: float = 0.05
) -> DataFrame:
    """Every (point, polygon) hit: the point's columns and ``zone``.

    Holes are outside, all parts of a polygon count.  Equi-joins on grid cells
    tell most hits at once: a cell wholly inside a polygon, coarse or fine, needs
    no ray.  Only a point in a fine cell on a border meets edges, those of the
    polygon's line of fine cells, and counts their crossings; no row carries a
    polygon.  ``cell`` should be about the size of a polygon.  Points are not
    shuffled where the covering is small: there is no broadcast hint, adaptive
    execution broadcasts it when its measured size allows, and a sort-merge join
    with skew splitting takes over when it does not.
    """
    return _hits(points, polygons, x, y, cell).select("_point.*", "zone")


def first_polygon(
    points: DataFrame, polygons: DataFrame, *, x: str = "lon", y: str = "lat", cell: float = 0.05
) -> DataFrame:
    """Each point with the first polygon (by ``pos``) that holds it; others drop out.

    As :func:`points_in_polygons`; a minimum over the hits of a point, combined
    before it is shuffled, settles which is first.  Points are told apart by their
    place, so they must come in a repeatable order, as from files.
    """
    numbered = points.select(F.struct(*points.columns).alias("_given"), x, y).withColumn("_id", F.monotonically_increasing_id())
    hits = _hits(numbered, polygons, x, y, cell)
    firsts = hits.groupBy("_point._id").agg(
        F.min(F.struct("pos", "zone")).alias("_first"), F.first("_point._given").alias("_given")
    )
    return firsts.select("_given.*", F.col("_first.zone").alias("zone"))


def _hits(points: DataFrame, polygons: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    """(_point, pos, zone) of every hit."""
    fine = cell / FINER
    polygon, block = ["pos", "zone"], ["pos", "zone", "cell_x", "cell_y"]
    # One exchange serves a line's edges and its crossings, another the cells and their blocks.
    lines = edge_bands(edges(polygons), fine).repartition(*polygon, "cell_y")
    cells = (
        covering(lines, fine)
        .withColumnsRenamed({"cell_x": "_fx", "cell_y": "_fy"})
        .withColumns({"cell_x": F.floor(F.col("_fx") / FINER), "cell_y": F.floor(F.col("_fy") / FINER)})
        .repartition(*block)
        .groupBy(*block, "_fx", "_fy")
        .agg(F.min("sure").alias("_sure"))
    )
    all_sure = F.sum(F.col("_sure").cast("int")).over(Window.partitionBy(*block)) == FINER * FINER
    cells = cells.withColumn("_whole", all_sure)
    coarse = cells.select(*polygon, "cell_x", "cell_y", "_whole").distinct()
    finer = cells.filter(~F.col("_whole")).select(*polygon, "_fx", "_fy", "_sure")
    bands = lines.groupBy(*polygon, "cell_y").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_sides"))
    bands = bands.withColumnRenamed("cell_y", "_fy")
    placed = points.select(
        F.struct(*points.columns).alias("_point"),
        F.col(x).cast("double").alias("_x"),
        F.col(y).cast("double").alias("_y"),
        _cell(F.col(x), fine).alias("_fx"),
        _cell(F.col(y), fine).alias("_fy"),
    ).withColumns({"cell_x": F.floor(F.col("_fx") / FINER), "cell_y": F.floor(F.col("_fy") / FINER)})

    def on(right: DataFrame, names: list[str], open_: Column) -> tuple[DataFrame, Column]:
        """Other names for the keys of ``right``, and the condition; settled rows need no match."""
        right = right.withColumnsRenamed({n: f"_of_{n}" for n in names})
        met = open_
        for n in names:
            met = met & F.col(n).eqNullSafe(F.col(f"_of_{n}"))
        return right, met

    near = placed.join(coarse, ["cell_x", "cell_y"])
    right, met = on(finer, [*polygon, "_fx", "_fy"], ~F.col("_whole"))
    near = near.join(right, met, "left").filter("_whole OR _sure IS NOT NULL").select(
        "_point", "_x", "_y", "_fy", *polygon, (F.col("_whole") | F.col("_sure")).alias("_settled")
    )
    right, met = on(bands, [*polygon, "_fy"], ~F.col("_settled"))
    near = near.join(right, met, "left")
    return near.filter(F.col("_settled") | _odd(F.col("_sides"), F.col("_x"), F.col("_y"))).select("_point", *polygon)


def zone_means(
    hits: DataFrame, polygons: DataFrame, value: str, *, by: Sequence[str] = (), zones: Sequence[str] = ()
) -> DataFrame:
    """Mean per polygon; a polygon without a point has mean 0.

    With ``by`` (for example a scan time) every value of ``by`` that occurs, null
    included, gets all of ``zones``, the list of names that the caller passes.
    The hits are averaged first; only averages meet the polygons.
    """
    by = list(by)
    if by and not zones:
        raise ValueError("means per scan need the list of zones")
    means = hits.groupBy(*by, "zone").agg(F.avg(value).alias(value))
    if not by:
        return polygons.select("zone").distinct().join(means, "zone", "left").fillna(0.0, [value])
    every = means.select(*by).distinct().withColumn("zone", F.explode(F.array(*[F.lit(z) for z in zones])))
    names = [*by, "zone"]
    side = means.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(names)], value)
    joined = every.join(side, [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(names)], "left")
    return joined.select(*names, value).fillna(0.0, [value])


def zone_pivot(hits: DataFrame, by: Sequence[str], zones: Sequence[str], value: str) -> DataFrame:
    """Mean per time and zone, one column per listed zone."""
    return hits.groupBy(*by).pivot("zone", list(zones)).agg(F.avg(value))


def compare_rates(
    echoes: DataFrame,
    keys: Sequence[str],
    dbz: str,
    first: tuple[float, float],
    others: Mapping[str, tuple[float, float]],
    *,
    factor: float = 1.0,
) -> DataFrame:
    """Totals under one reflectivity relation and under each of the named others, with their relative difference.

    One row per key and other relation; the echoes are read once, whatever the number of relations.
    """
    names = list(others)
    totals = echoes.groupBy(*keys).agg(
        (F.sum(rain_rate(dbz, first)) * F.lit(factor)).alias("total_a"),
        *[(F.sum(rain_rate(dbz, others[name])) * F.lit(factor)).alias(f"_total_{i}") for i, name in enumerate(names)],
    )
    spread = F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(f"_total_{i}").alias("total_b")) for i, name in enumerate(names)
    ])
    change = F.try_divide(F.abs(F.col("total_b") - F.col("total_a")), F.col("total_a"))
    return totals.select(*keys, "total_a", F.inline(spread)).withColumn("relative_difference", change)
