"""Registered queries: each runs an operator over the given tables, most with an
equivalent SQL text for comparison."""

from __future__ import annotations

from .registry import ORACLES, QUERIES

from . import areas, cleaning, overflow, radar, rain, reports, storms  # noqa: E402,F401  (register)

__all__ = ["ORACLES", "QUERIES"]
