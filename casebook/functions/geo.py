"""Distance on the WGS-84 ellipsoid."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EQUATOR_KM = 6378.137
FLATTENING = 1 / 298.257223563


def ellipsoid_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Lambert's closed form for long lines: reduced latitudes plus a flattening term.

    Equal points give 0; exactly opposite points have no flattening term.
    """
    b1, b2 = (F.atan((1 - FLATTENING) * F.tan(F.radians(x))) for x in (lat1, lat2))
    half = (
        F.pow(F.sin((b2 - b1) / 2), 2)
        + F.cos(b1) * F.cos(b2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    arc = 2 * F.asin(F.sqrt(F.when(half > 1, 1.0).otherwise(half)))
    mid, diff = (b1 + b2) / 2, (b2 - b1) / 2
    x_den, y_den = F.pow(F.cos(arc / 2), 2), F.pow(F.sin(arc / 2), 2)
    x = F.when(x_den > 0, (arc - F.sin(arc)) * F.pow(F.sin(mid) * F.cos(diff), 2) / x_den).otherwise(0.0)
    y = F.when(y_den > 0, (arc + F.sin(arc)) * F.pow(F.cos(mid) * F.sin(diff), 2) / y_den).otherwise(0.0)
    return EQUATOR_KM * (arc - FLATTENING / 2 * (x + y))
