"""Radar formulas: reflectivity to rain rate, polar to plane, polar to lat/lon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import _col

MM_PER_INCH = 25.4

# Fixed values: (a, exponent) of rate = (Z / a) ^ exponent.
MARSHALL_PALMER = (200.0, 0.625)
ALTERNATIVE = (250.0, 10 / 12)
STORM = (300.0, 10 / 14)
TRIAL = (300.0, 0.85)

# Hours a single radar scan stands for (five minutes).
SCAN_HOURS = 0.0833

# Site used when a sweep carries no position.
DEFAULT_SITE = (41.60444, -88.08472)


@dataclass(frozen=True)
class BoundingBox:
    south: float
    north: float
    west: float
    east: float

    def holds(self, lat: Column | str, lon: Column | str) -> Column:
        """Closed on all four sides."""
        return _col(lat).between(self.south, self.north) & _col(lon).between(self.west, self.east)


# Bounding box of the city.
CITY_BOX = BoundingBox(41.644335, 42.0231311, -87.940267, -87.524044)


@dataclass(frozen=True)
class Ellipsoid:
    semi_major: float
    flattening: float


# Clarke 1866 (semi-major axis, semi-minor axis in metres), and the
# GRS80 ellipsoid used by published geodesic examples.
CLARKE_1866 = Ellipsoid(6378206.4, 1 - 6356583.8 / 6378206.4)
GRS_80 = Ellipsoid(6378137.0, 1 / 298.257222101)
SPHERE_RADIUS = 6371008.8


def rain_rate(dbz: Column | str, relation: tuple[float, float] = MARSHALL_PALMER) -> Column:
    """Reflectivity in dBZ to mm per hour."""
    a, exponent = relation
    return F.pow(F.pow(F.lit(10.0), _col(dbz) / F.lit(10.0)) / F.lit(a), F.lit(exponent))


def scan_inches(dbz: Column | str, relation: tuple[float, float] = MARSHALL_PALMER) -> Column:
    """Inches of rain that fall during one scan."""
    return rain_rate(dbz, relation) * F.lit(SCAN_HOURS / MM_PER_INCH)


def inches(mm: Column | str) -> Column:
    return _col(mm) / F.lit(MM_PER_INCH)


def depth_inches(rate_mm: Column | str, hours: Column | str) -> Column:
    """Rate in mm per hour held for a number of hours, in inches."""
    return _col(rate_mm) * _col(hours) / F.lit(MM_PER_INCH)


def plane_xy(azimuth: Column | str, distance: Column | str) -> tuple[Column, Column]:
    """East and north offset of a gate from the site."""
    angle = F.radians(_col(azimuth))
    return _col(distance) * F.sin(angle), _col(distance) * F.cos(angle)


def sphere_lat_lon(
    lat: Column, lon: Column, azimuth: Column, metres: Column
) -> tuple[Column, Column]:
    """Forward position on a sphere; close enough at short ranges."""
    arc = metres / F.lit(SPHERE_RADIUS)
    phi, theta = F.radians(lat), F.radians(azimuth)
    sin_out = F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(theta)
    turn = F.atan2(
        F.sin(theta) * F.sin(arc) * F.cos(phi), F.cos(arc) - F.sin(phi) * sin_out
    )
    return F.degrees(F.asin(sin_out)), lon + F.degrees(turn)


def add_ray_terms(rays: DataFrame, ellipsoid: Ellipsoid = CLARKE_1866) -> DataFrame:
    """Everything in the geodesic that depends on the ray but not on the gate.

    Computed once per ray, before its gates are exploded, so the trigonometry of
    the site and azimuth is not repeated hundreds of times.
    """
    a, f = ellipsoid.semi_major, ellipsoid.flattening
    b = a * (1 - f)
    second_ecc = (a * a - b * b) / (b * b)
    azimuth = F.radians("azimuth")
    rays = rays.withColumns({
        "_sin_az": F.sin(azimuth),
        "_cos_az": F.cos(azimuth),
        "_tan_u": F.lit(1 - f) * F.tan(F.radians("site_lat")),
    })
    rays = rays.withColumn("_cos_u", F.lit(1.0) / F.sqrt(1 + F.col("_tan_u") * F.col("_tan_u")))
    rays = rays.withColumns({
        "_sin_u": F.col("_tan_u") * F.col("_cos_u"),
        "_sigma_1": F.atan2(F.col("_tan_u"), F.col("_cos_az")),
        "_sin_alpha": F.col("_cos_u") * F.col("_sin_az"),
    })
    rays = rays.withColumn("_cos2_alpha", 1 - F.col("_sin_alpha") * F.col("_sin_alpha"))
    root = F.sqrt(1 + F.col("_cos2_alpha") * F.lit(second_ecc))
    rays = rays.withColumn("_eps", (root - 1) / (root + 1))
    e, s1, c2 = F.col("_eps"), F.col("_sigma_1"), F.col("_cos2_alpha")
    e2, e3, e4 = e * e, e * e * e, e * e * e * e
    return rays.withColumns({
        "_scale": F.lit(b) * (1 + e2 / 4 + e4 / 64) / (1 - e),
        "_tau_1": s1
        + (e3 * 3 / 16 - e / 2) * F.sin(s1 * 2)
        + (e4 / 32 - e2 / 16) * F.sin(s1 * 4)
        - e3 / 48 * F.sin(s1 * 6)
        - e4 * 5 / 512 * F.sin(s1 * 8),
        "_back_1": e / 2 - e3 * 9 / 32,
        "_back_2": e2 * 5 / 16 - e4 * 37 / 96,
        "_back_3": e3 * 29 / 96,
        "_back_4": e4 * 539 / 1536,
        "_big_c": F.lit(f / 16) * c2 * (4 + F.lit(f) * (4 - 3 * c2)),
    })


def add_lat_lon(gates: DataFrame, metres: str, keep: tuple[str, ...], ellipsoid: Ellipsoid = CLARKE_1866) -> DataFrame:
    """Place gates by the direct geodesic on the ellipsoid: ``keep``, lat, lon.

    Arc length is turned into the arc on the auxiliary sphere by the reverted
    series (Karney 2013), and the arc into a position by Vincenty's closed
    formulas, so there is no iteration.  The position leaves through a one-row
    generator: a filter on lat or lon would otherwise be pushed down through
    the steps and repeat all of them inside the predicate.
    """
    f = ellipsoid.flattening
    tau = F.col("_tau")
    gates = gates.withColumn("_tau", F.col("_tau_1") + F.col(metres) / F.col("_scale"))
    gates = gates.withColumn(
        "_sigma",
        tau
        - F.col("_sigma_1")
        + F.col("_back_1") * F.sin(tau * 2)
        + F.col("_back_2") * F.sin(tau * 4)
        + F.col("_back_3") * F.sin(tau * 6)
        + F.col("_back_4") * F.sin(tau * 8),
    )
    gates = gates.withColumns({
        "_cos_2m": F.cos(2 * F.col("_sigma_1") + F.col("_sigma")),
        "_sin_s": F.sin("_sigma"),
        "_cos_s": F.cos("_sigma"),
    })
    sin_u, cos_u, sin_s, cos_s = (F.col(c) for c in ("_sin_u", "_cos_u", "_sin_s", "_cos_s"))
    cos_az, sin_az, sin_alpha = F.col("_cos_az"), F.col("_sin_az"), F.col("_sin_alpha")
    across = sin_u * sin_s - cos_u * cos_s * cos_az
    lat = F.atan2(
        sin_u * cos_s + cos_u * sin_s * cos_az,
        F.lit(1 - f) * F.sqrt(sin_alpha * sin_alpha + across * across),
    )
    turn = F.atan2(sin_s * sin_az, cos_u * cos_s - sin_u * sin_s * cos_az)
    c, cos_2m = F.col("_big_c"), F.col("_cos_2m")
    bend = F.col("_sigma") + c * sin_s * (cos_2m + c * cos_s * (-1 + 2 * cos_2m * cos_2m))
    shift = turn - (1 - c) * F.lit(f) * sin_alpha * bend
    return at_position(gates, keep, F.degrees(lat), F.col("site_lon") + F.degrees(shift))


def at_position(gates: DataFrame, keep: tuple[str, ...], lat: Column, lon: Column) -> DataFrame:
    """``keep`` with the computed ``lat`` and ``lon``, shielded from predicate pushdown."""
    position = F.array(F.struct(lat.alias("lat"), lon.alias("lon")))
    return gates.select(*keep, F.inline(position))
