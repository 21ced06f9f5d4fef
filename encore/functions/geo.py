"""Great-circle distance as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


DEG = math.pi / 180.0


def great_circle_miles(lat: Column, lon: Column, lat0: float, lon0: float,
                       radius: float = K.EARTH_RADIUS_MILES) -> Column:
    """Distance from (lat, lon) to a fixed point: radius * acos(unit-vector dot product)."""
    la, lo = lat * DEG, lon * DEG

    la0, lo0 = lat0 * DEG, lon0 * DEG
    x0, y0, z0 = math.cos(la0) * math.cos(lo0), math.cos(la0) * math.sin(lo0), math.sin(la0)
    dot = F.cos(la) * F.cos(lo) * x0 + F.cos(la) * F.sin(lo) * y0 + F.sin(la) * z0
    clamped = F.when(dot > 1, F.lit(1.0)).when(dot < -1, F.lit(-1.0)).otherwise(dot)
    return F.lit(radius) * F.acos(clamped)
