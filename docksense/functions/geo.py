"""Geodesy and plane geometry columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0

# fixed values: GRS80 ellipsoid, UTM zone 31 north
_A, _F = 6378137.0, 1 / 298.257222101
_K0, _E0, _LON0 = 0.9996, 500000.0, math.radians(3.0)
_N = _F / (2 - _F)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_SHRINK = 2 * math.sqrt(_N) / (1 + _N)
# fixed values: coefficients of the Krüger series to the third order in n
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
]
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
]
_DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle metres."""
    o1, a1, o2, a2 = (F.radians(_col(c)) for c in (lon1, lat1, lon2, lat2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def unit_xyz(lon, lat) -> tuple[Column, Column, Column]:
    """Point of the unit sphere; chord order equals great-circle order."""
    o, a = F.radians(_col(lon)), F.radians(_col(lat))
    return F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)


def to_utm31(lon, lat) -> tuple[Column, Column]:
    """Degrees to (easting, northing) metres of UTM 31N."""
    phi, lam = F.radians(_col(lat)), F.radians(_col(lon)) - _LON0
    t = F.sinh(F.atanh(F.sin(phi)) - _SHRINK * F.atanh(_SHRINK * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _E0 + _K0 * _RECT * east, _K0 * _RECT * north


def from_utm31(x, y) -> tuple[Column, Column]:
    """UTM 31N metres to (lon, lat) degrees."""
    xi, eta = _col(y) / (_K0 * _RECT), (_col(x) - _E0) / (_K0 * _RECT)
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = _LON0 + F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.degrees(lam), F.degrees(phi)


def wkt_point(lon, lat) -> Column:
    return F.concat(F.lit("POINT("), _col(lon).cast("string"), F.lit(" "), _col(lat).cast("string"), F.lit(")"))


def geo_point(lon, lat, alt=None) -> Column:
    """GeoJSON point struct."""
    parts = [_col(lon), _col(lat)] + ([_col(alt)] if alt is not None else [])
    return F.struct(F.lit("Point").alias("type"), F.array(*[p.cast("double") for p in parts]).alias("coordinates"))


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    """Distance from a point to a segment in the plane; a zero-length segment is a point."""
    px, py, x1, y1, x2, y2 = (_col(c) for c in (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    along = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)
