"""Nearest point of a short fixed list, as one expression per row (no join, no Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulyard.constants import CITIES


def nearest_city(lat: Column, lon: Column, points: Sequence[tuple[str, float, float]] = CITIES) -> Column:
    """Name of the closest point by straight distance in degrees; the first listed wins ties.

    A missing position has no distances at all, so the order falls to the list index: first point.
    """
    candidates = [
        F.struct(
            F.sqrt((lat - F.lit(la)) * (lat - F.lit(la)) + (lon - F.lit(lo)) * (lon - F.lit(lo))).alias("d"),
            F.lit(i).alias("i"),
            F.lit(name).alias("name"),
        )
        for i, (name, la, lo) in enumerate(points)
    ]
    return F.array_min(F.array(*candidates))["name"]
