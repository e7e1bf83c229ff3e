"""Geodesy as column expressions (G3, G4): haversine miles, a transverse
Mercator (UTM) forward projection, and point-to-segment distance. No per-row
geometry library, no Python UDF.

The projection follows the series of Snyder, *Map Projections: A Working
Manual* (USGS PP 1395, 1987), pp. 60-61. It is written once over a small math
namespace, so that tests run the same code on plain numbers.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes

COLUMN_MATH = SimpleNamespace(sin=F.sin, cos=F.cos, tan=F.tan, sqrt=F.sqrt, radians=F.radians)
PY_MATH = SimpleNamespace(sin=math.sin, cos=math.cos, tan=math.tan, sqrt=math.sqrt, radians=math.radians)


def haversine_miles(lat1, lon1, lat2, lon2, m=COLUMN_MATH):
    """Great-circle distance on a sphere of radius 6367 km, in miles."""
    p1, l1, p2, l2 = m.radians(lat1), m.radians(lon1), m.radians(lat2), m.radians(lon2)
    a = m.sin((p2 - p1) / 2.0) ** 2 + m.cos(p1) * m.cos(p2) * m.sin((l2 - l1) / 2.0) ** 2
    c = 2 * (F.asin(m.sqrt(a)) if m is COLUMN_MATH else math.asin(m.sqrt(a)))
    return codes.EARTH_RADIUS_KM * c * codes.KM_TO_MILES


def utm_forward(lat, lon, m=COLUMN_MATH):
    """(easting, northing) in metres for UTM zone 13N."""
    a, f, k0 = codes.WGS84_A, codes.WGS84_F, codes.UTM_SCALE
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi = m.radians(lat)
    sphi, cphi, tphi = m.sin(phi), m.cos(phi), m.tan(phi)
    n = a / m.sqrt(1 - e2 * sphi * sphi)
    t = tphi * tphi
    c = ep2 * cphi * cphi
    aa = cphi * m.radians(lon - codes.UTM_CENTRAL_MERIDIAN)
    e4, e6 = e2 * e2, e2 * e2 * e2
    mm = a * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
              - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * m.sin(2 * phi)
              + (15 * e4 / 256 + 45 * e6 / 1024) * m.sin(4 * phi)
              - (35 * e6 / 3072) * m.sin(6 * phi))
    x = k0 * n * (aa + (1 - t + c) * aa ** 3 / 6
                  + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa ** 5 / 120) + codes.UTM_FALSE_EASTING
    y = k0 * (mm + n * tphi * (aa * aa / 2 + (5 - t + 9 * c + 4 * c * c) * aa ** 4 / 24
                               + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa ** 6 / 720))
    return x, y


def nearest_point_miles(lat: Column, lon: Column, points: list[tuple[float, float]]) -> Column:
    """Miles to the nearest of a few literal points."""
    ds = [haversine_miles(lat, lon, F.lit(plat), F.lit(plon)) for plat, plon in points]
    return ds[0] if len(ds) == 1 else F.least(*ds)


def segment_metres(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance from a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    at = F.when(len2 > 0, ((x - x1) * dx + (y - y1) * dy) / len2).otherwise(F.lit(0.0))
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), at))
    px, py = x1 + at * dx, y1 + at * dy
    return F.sqrt((x - px) * (x - px) + (y - py) * (y - py))
