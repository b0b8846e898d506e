"""Radar sweeps to points, zones and time grids.

An embedding stands for a ray: its elements are the gates, ``vec_id`` sets the
azimuth and ``label`` the sweep.  The zones are a fixed handful of polygons.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions.radar import (
    ALTERNATIVE,
    CITY_BOX,
    CLARKE_1866,
    MARSHALL_PALMER,
    SCAN_HOURS,
    SPHERE_RADIUS,
    STORM,
    TRIAL,
    plane_xy,
    scan_inches,
)
from ..operators import spatial
from ..sources.readers import polygon_parts
from .registry import query, table

SITE_LAT, SITE_LON = 41.60444, -88.08472
FIRST_GATE, GATE_WIDTH = 2.125, 1.0

# (zone, ring): a rectangle, an L shape, a triangle across both, and one that no gate reaches.
ZONES = [
    ("west", [(-87.94, 41.64), (-87.74, 41.64), (-87.74, 41.86), (-87.94, 41.86)]),
    ("corner", [(-87.74, 41.64), (-87.53, 41.64), (-87.53, 41.74), (-87.64, 41.74), (-87.64, 41.90), (-87.74, 41.90)]),
    ("triangle", [(-87.90, 41.70), (-87.60, 41.72), (-87.75, 41.98), (-87.90, 41.70)]),
    ("empty", [(-80.0, 41.0), (-79.9, 41.0), (-79.9, 41.1)]),
]
ZONE_NAMES = [name for name, _ in ZONES]


def zones(spark):
    listed = F.array(*[
        F.struct(
            F.lit(name).alias("zone"),
            F.lit(pos).alias("pos"),
            F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring]).alias("ring"),
        )
        for pos, (name, ring) in enumerate(ZONES)
    ])
    return spark.range(1, numPartitions=1).select(F.inline(listed))


def sweeps(spark, folder):
    """Rays in the sweep layout; gates become reflectivities around 20 dBZ."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        "label",
        (F.lit("2016-08-12 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("label") * 5)).alias("ts"),
        F.lit(None).cast("double").alias("site_lat"),
        F.lit(None).cast("double").alias("site_lon"),
        ((F.col("vec_id") * 7 % 360).cast("double") + 0.5).alias("azimuth"),
        F.lit(FIRST_GATE).alias("first_gate"),
        F.lit(GATE_WIDTH).alias("gate_width"),
        F.transform("embedding", lambda g: g.cast("double") * 100 + 20).alias("gates"),
    )


_GATES = f"""
gates AS (
  SELECT vec_id, label, TIMESTAMP '2016-08-12' + to_minutes(label * 5) AS ts, CAST(vec_id * 7 % 360 AS DOUBLE) + 0.5::DOUBLE AS azimuth,
    i AS gate, CAST(embedding[i + 1] AS DOUBLE) * 100 + 20 AS dbz,
    ({FIRST_GATE}::DOUBLE + i * {GATE_WIDTH}::DOUBLE) * 1000 AS metres
  FROM (SELECT *, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS i FROM embeddings)),
echoes AS (SELECT * FROM gates WHERE dbz > 20)"""


def _vincenty() -> str:
    """The direct geodesic as a chain of SQL steps."""
    f = CLARKE_1866.flattening
    a = CLARKE_1866.semi_major
    b = a * (1 - f)
    e2 = (a * a - b * b) / (b * b)
    steps = f"""
  t0 AS (SELECT *, sin(radians(azimuth)) AS sa, cos(radians(azimuth)) AS ca, {1 - f!r}::DOUBLE * tan(radians({SITE_LAT}::DOUBLE)) AS tu FROM echoes),
  t1 AS (SELECT *, 1 / sqrt(1 + tu * tu) AS cu FROM t0),
  t2 AS (SELECT *, tu * cu AS su, atan2(tu, ca) AS s1, cu * sa AS sal FROM t1),
  t3 AS (SELECT *, 1 - sal * sal AS c2, (1 - sal * sal) * {e2!r}::DOUBLE AS u2 FROM t2),
  t4 AS (SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS big_a,
    u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS big_b,
    {f / 16!r}::DOUBLE * c2 * (4 + {f!r}::DOUBLE * (4 - 3 * c2)) AS big_c FROM t3),
  r0 AS (SELECT *, metres / ({b!r}::DOUBLE * big_a) AS arc, metres / ({b!r}::DOUBLE * big_a) AS sg FROM t4)"""
    for i in range(4):
        steps += f""",
  q{i} AS (SELECT *, cos(2 * s1 + sg) AS cm, sin(sg) AS ss, cos(sg) AS cs FROM r{i}),
  r{i + 1} AS (SELECT * EXCLUDE (sg, cm, ss, cs), arc + big_b * ss * (cm + big_b / 4 * (cs * (-1 + 2 * cm * cm)
    - big_b / 6 * cm * (-3 + 4 * ss * ss) * (-3 + 4 * cm * cm))) AS sg FROM q{i})"""
    return steps + f""",
  e0 AS (SELECT *, cos(2 * s1 + sg) AS cm, sin(sg) AS ss, cos(sg) AS cs FROM r4),
  points AS (SELECT vec_id, label, ts, gate, dbz,
    degrees(atan2(su * cs + cu * ss * ca, {1 - f!r}::DOUBLE * sqrt(sal * sal + (su * ss - cu * cs * ca) * (su * ss - cu * cs * ca)))) AS lat,
    {SITE_LON}::DOUBLE + degrees(atan2(ss * sa, cu * cs - su * ss * ca)
      - (1 - big_c) * {f!r}::DOUBLE * sal * (sg + big_c * ss * (cm + big_c * cs * (-1 + 2 * cm * cm)))) AS lon FROM e0),
  boxed AS (SELECT * FROM points WHERE lat BETWEEN {CITY_BOX.south} AND {CITY_BOX.north} AND lon BETWEEN {CITY_BOX.west} AND {CITY_BOX.east})"""


_POINTS = f"WITH {_GATES}, {_vincenty()}"


def _points(spark, folder, box=CITY_BOX):
    return spatial.gates_to_points(sweeps(spark, folder), ["vec_id", "label", "ts"], box=box)


@query(f"{_POINTS} SELECT vec_id, gate, dbz, round(lat, 6) AS lat, round(lon, 6) AS lon FROM boxed")
def gates_to_points(spark, folder):
    """Echoes above the floor inside the city, placed on the ellipsoid."""
    return _points(spark, folder).select(
        "vec_id", "gate", "dbz", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")
    )


@query(f"""WITH {_GATES},
p AS (SELECT vec_id, gate, metres / {SPHERE_RADIUS}::DOUBLE AS arc, radians({SITE_LAT}::DOUBLE) AS phi, radians(azimuth) AS th FROM echoes),
s AS (SELECT *, sin(phi) * cos(arc) + cos(phi) * sin(arc) * cos(th) AS so FROM p)
SELECT vec_id, gate, round(degrees(asin(so)), 6) AS lat,
  round({SITE_LON}::DOUBLE + degrees(atan2(sin(th) * sin(arc) * cos(phi), cos(arc) - sin(phi) * so)), 6) AS lon FROM s""")
def gates_on_sphere(spark, folder):
    points = spatial.gates_to_points(sweeps(spark, folder), ["vec_id"], ellipsoid=None)
    return points.select("vec_id", "gate", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""WITH {_GATES}
SELECT vec_id, gate, round(metres / 1000 * sin(radians(azimuth)), 6) AS x, round(metres / 1000 * cos(radians(azimuth)), 6) AS y FROM gates""")
def plane_positions(spark, folder):
    """Where every gate lies on a flat plane."""
    gates = sweeps(spark, folder).select("*", F.posexplode("gates").alias("gate", "dbz"))
    x, y = plane_xy("azimuth", F.col("first_gate") + F.col("gate") * F.col("gate_width"))
    return gates.select("vec_id", "gate", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


def _edges_sql(listed=tuple((name, [ring]) for name, ring in ZONES)) -> str:
    rows = []
    for pos, (name, rings) in enumerate(listed):
        for (x1, y1), (x2, y2) in (side for ring in rings for side in zip(ring, ring[1:] + ring[:1])):
            rows.append(f"('{name}', {pos}, {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)")
    return f"""edges(zone, pos, x1, y1, x2, y2) AS (VALUES {', '.join(rows)}),
hits AS (SELECT vec_id, gate, label, ts, dbz, lat, lon, zone, pos,
    pow(pow(10.0::DOUBLE, dbz / 10) / 200, 0.625::DOUBLE) * {SCAN_HOURS / 25.4!r}::DOUBLE AS precip
  FROM boxed, edges GROUP BY ALL
  HAVING count(*) FILTER (lat > least(y1, y2) AND lat <= greatest(y1, y2) AND lon <= greatest(x1, x2)
    AND (x1 = x2 OR (y1 <> y2 AND lon <= (lat - y1) * (x2 - x1) / nullif(y2 - y1, 0) + x1))) % 2 = 1)"""


_HITS = f"{_POINTS}, {_edges_sql()}"


def _hits(spark, folder):
    hits = spatial.points_in_polygons(_points(spark, folder), zones(spark), cell=0.1)
    return hits.withColumn("precip", scan_inches("dbz"))


_ZONE_LIST = ", ".join(f"('{n}')" for n in ZONE_NAMES)


@query(f"""{_HITS}
SELECT z.zone, coalesce(round(avg(precip), 9), 0) AS precip FROM (VALUES {_ZONE_LIST}) z(zone) LEFT JOIN hits h ON h.zone = z.zone GROUP BY 1""")
def zones_keep_empty(spark, folder):
    """Mean per zone; a zone without an echo has mean 0."""
    means = spatial.zone_means(_hits(spark, folder), zones(spark), "precip")
    return means.select("zone", F.round("precip", 9).alias("precip"))


@query(f"""{_HITS}, times AS (SELECT DISTINCT ts FROM hits)
SELECT t.ts, z.zone, coalesce(round(avg(precip), 9), 0) AS precip
FROM times t CROSS JOIN (VALUES {_ZONE_LIST}) z(zone) LEFT JOIN hits h ON h.zone = z.zone AND h.ts = t.ts GROUP BY 1, 2""")
def zone_means(spark, folder):
    """Mean per scan and zone, every zone in every scan."""
    means = spatial.zone_means(_hits(spark, folder), zones(spark), "precip", by=["ts"], zones=ZONE_NAMES)
    return means.select("ts", "zone", F.round("precip", 9).alias("precip"))


@query(f"""{_HITS},
firsts AS (SELECT vec_id, gate, ts, precip, arg_min(zone, pos) AS zone FROM hits GROUP BY 1, 2, 3, 4)
SELECT ts, {', '.join(f"round(avg(precip) FILTER (zone = '{n}'), 9) AS {n}" for n in ZONE_NAMES)} FROM firsts GROUP BY ts""")
def grid_pivot(spark, folder):
    """Mean rain per scan, one column per zone, a point counting for its first zone."""
    found = spatial.first_polygon(_points(spark, folder), zones(spark), cell=0.1)
    wide = spatial.zone_pivot(found.withColumn("precip", scan_inches("dbz")), ["ts"], ZONE_NAMES, "precip")
    return wide.select("ts", *[F.round(n, 9).alias(n) for n in ZONE_NAMES])


@query(f"""{_HITS}
SELECT zone, count(*) AS points FROM (SELECT vec_id, gate, arg_min(zone, pos) AS zone FROM hits GROUP BY 1, 2) GROUP BY 1""")
def first_zone_counts(spark, folder):
    found = spatial.first_polygon(_points(spark, folder), zones(spark), cell=0.1)
    return found.groupBy("zone").agg(F.count("*").alias("points"))


# GeoJSON geometries: a square with a hole that holds a smaller square, and two triangles.
GEOMETRIES = [
    ("ringed", "MultiPolygon", [
        [[[-87.94, 41.64], [-87.54, 41.64], [-87.54, 42.0], [-87.94, 42.0]], [[-87.85, 41.7], [-87.62, 41.7], [-87.62, 41.9], [-87.85, 41.9]]],
        [[[-87.76, 41.74], [-87.7, 41.74], [-87.7, 41.82], [-87.76, 41.82]]],
    ]),
    ("twofold", "MultiPolygon", [[[[-87.9, 41.66], [-87.8, 41.8], [-87.9, 41.95]]], [[[-87.56, 41.66], [-87.7, 41.8], [-87.56, 41.95]]]]),
    ("plain", "Polygon", [[[-87.8, 41.7], [-87.6, 41.75], [-87.7, 41.95], [-87.8, 41.7]]]),
]
_GEOMETRY_RINGS = tuple(
    (name, [[tuple(p) for p in ring] for part in (shape if kind == "MultiPolygon" else [shape]) for ring in part])
    for name, kind, shape in GEOMETRIES
)


@query(f"""{_POINTS}, {_edges_sql(_GEOMETRY_RINGS)}
SELECT zone, label, count(*) AS points, round(avg(precip), 9) AS precip FROM hits GROUP BY 1, 2""")
def parted_zone_means(spark, folder):
    """Points and mean rain per scan in zones of several parts and with holes, given as GeoJSON text."""
    given = F.array(*[
        F.struct(F.lit(name).alias("zone"), F.lit(pos).alias("pos"), F.lit(kind).alias("kind"), F.lit(json.dumps(shape)).alias("shape"))
        for pos, (name, kind, shape) in enumerate(GEOMETRIES)
    ])
    shapes = spark.range(1, numPartitions=1).select(F.inline(given))
    shapes = shapes.select("zone", "pos", polygon_parts(F.col("kind"), F.col("shape")).alias("parts"))
    hits = spatial.points_in_polygons(_points(spark, folder), shapes, cell=0.1).withColumn("precip", scan_inches("dbz"))
    means = hits.groupBy("zone", "label").agg(F.count("*").alias("points"), F.avg("precip").alias("precip"))
    return means.select("zone", "label", "points", F.round("precip", 9).alias("precip"))


_OTHERS = {"trial": TRIAL, "alternative": ALTERNATIVE, "storm": STORM}
_OTHERS_SQL = "(VALUES ('trial', 300.0::DOUBLE, 0.85::DOUBLE), ('alternative', 250.0::DOUBLE, 10::DOUBLE / 12), ('storm', 300.0::DOUBLE, 10::DOUBLE / 14)) o(relation, c, p)"


@query(f"""WITH {_GATES},
sums AS (SELECT label, relation, sum(pow(pow(10.0::DOUBLE, dbz / 10) / 200, 0.625::DOUBLE)) * {SCAN_HOURS / 25.4!r}::DOUBLE AS a,
    sum(pow(pow(10.0::DOUBLE, dbz / 10) / c, p)) * {SCAN_HOURS / 25.4!r}::DOUBLE AS b FROM gates, {_OTHERS_SQL} GROUP BY 1, 2)
SELECT label, relation, round(a, 6) AS total_a, round(b, 6) AS total_b, round(abs(b - a) / a, 6) AS relative_difference FROM sums""")
def zr_compare(spark, folder):
    """Totals per sweep under the usual reflectivity relation and three others, in one scan."""
    echoes = sweeps(spark, folder).select("label", F.explode("gates").alias("dbz"))
    compared = spatial.compare_rates(echoes, ["label"], "dbz", MARSHALL_PALMER, _OTHERS, factor=SCAN_HOURS / 25.4)
    return compared.select(
        "label", "relation", *[F.round(c, 6).alias(c) for c in ("total_a", "total_b", "relative_difference")]
    )
