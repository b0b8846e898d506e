"""Return-period thresholds: how many inches in how many hours make an n-year storm."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import _col

RETURN_PERIODS = (1, 2, 5, 10, 25, 50, 100)

# Inches of rain per duration for the 1-, 2-, 5-, 10-, 25-, 50- and
# 100-year storm (Illinois State Water Survey, Bulletin 70, northeast section).
INCHES = {
    "10-day": (4.12, 4.95, 6.04, 6.89, 8.18, 9.38, 11.14),
    "5-day": (3.25, 3.93, 4.91, 5.70, 6.93, 8.04, 9.96),
    "72-hr": (2.93, 3.55, 4.44, 5.18, 6.32, 7.41, 8.78),
    "48-hr": (2.70, 3.30, 4.09, 4.81, 5.88, 6.84, 8.16),
    "24-hr": (2.51, 3.04, 3.80, 4.47, 5.51, 6.46, 7.58),
    "18-hr": (2.30, 2.79, 3.50, 4.11, 5.06, 5.95, 6.97),
    "12-hr": (2.18, 2.64, 3.31, 3.89, 4.79, 5.62, 6.59),
    "6-hr": (1.88, 2.28, 2.85, 3.35, 4.13, 4.85, 5.68),
    "3-hr": (1.60, 1.94, 2.43, 2.86, 3.53, 4.14, 4.85),
    "2-hr": (1.48, 1.79, 2.24, 2.64, 3.25, 3.82, 4.47),
    "1-hr": (1.18, 1.43, 1.79, 2.10, 2.59, 3.04, 3.56),
    "30-min": (0.93, 1.12, 1.41, 1.65, 2.04, 2.39, 2.80),
    "15-min": (0.68, 0.82, 1.03, 1.21, 1.49, 1.75, 2.05),
    "10-min": (0.55, 0.67, 0.84, 0.98, 1.21, 1.42, 1.67),
    "5-min": (0.30, 0.36, 0.46, 0.54, 0.66, 0.78, 0.91),
}

# Length of each duration in hours.
HOURS = {
    "5-min": 0.0833,
    "10-min": 0.1667,
    "15-min": 0.25,
    "30-min": 0.5,
    "1-hr": 1.0,
    "2-hr": 2.0,
    "3-hr": 3.0,
    "6-hr": 6.0,
    "12-hr": 12.0,
    "18-hr": 18.0,
    "24-hr": 24.0,
    "48-hr": 48.0,
    "72-hr": 72.0,
    "5-day": 120.0,
    "10-day": 240.0,
}


@dataclass(frozen=True)
class Band:
    """Lower limits of one duration, by return period in ascending order."""

    hours: int
    limits: tuple[tuple[int, float], ...]

    @property
    def lowest(self) -> float:
        return self.limits[0][1]

    def classify(self, inches: Column | str) -> Column:
        """Largest n whose limit is reached, null below the lowest limit.

        A value belongs to n when it lies in [limit of n, limit of the next n);
        the top class has no upper limit.
        """
        inches = _col(inches)
        chain = F
        for n, limit in reversed(self.limits):
            chain = chain.when(inches >= F.lit(limit), F.lit(n))
        return chain.otherwise(F.lit(None).cast("int"))


def bands(
    table: Mapping[str, tuple[float, ...]] = INCHES,
    scale: float = 1.0,
    longest_hours: float = 240,
    periods: tuple[int, ...] = RETURN_PERIODS,
) -> list[Band]:
    """Bands of the hourly durations, shortest first.

    Durations under one hour cannot be seen in an hourly series and are left
    out.  ``scale`` multiplies the limits, for series in another unit.
    """
    found = [
        Band(int(HOURS[label]), tuple(zip(periods, (round(x * scale, 6) for x in limits))))
        for label, limits in table.items()
        if 1 <= HOURS[label] <= longest_hours
    ]
    return sorted(found, key=lambda band: band.hours)


def threshold(duration: str, n: int) -> float:
    """Inches that make an n-year storm over the named duration."""
    return INCHES[duration][RETURN_PERIODS.index(n)]


def hours_to_class(inches: Column | str, n: int, scale: float = 1.0) -> Column:
    """Hours within which ``inches`` of rain make an n-year storm.

    Linear between neighbouring durations and from (0 h, 0 in) below the
    shortest; null when no duration asks for more than ``inches``.
    """
    inches = _col(inches)
    at = RETURN_PERIODS.index(n)
    points = sorted((HOURS[label], round(limits[at] * scale, 6)) for label, limits in INCHES.items())
    chain, low_hours, low_inches = F, 0.0, 0.0
    for hours, limit in points:
        share = (inches - F.lit(low_inches)) / F.lit(limit - low_inches)
        on_segment = F.lit(low_hours) + F.lit(hours - low_hours) * share
        reached = inches <= F.lit(limit) if hours != points[-1][0] else inches < F.lit(limit)
        chain = chain.when(reached, on_segment)
        low_hours, low_inches = hours, limit
    return chain.otherwise(F.lit(None).cast("double"))
