"""Transverse Mercator (UTM zone 30, GRS80 ellipsoid) as column expressions, by Krüger's series."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A, FLATTENING, K0, EAST, LON0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, -3.0
_N = FLATTENING / (2 - FLATTENING)
_R = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_E = 2 * math.sqrt(_N) / (1 + _N)


def to_utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres, of degrees."""
    phi, lam = F.radians(lat), F.radians(lon - LON0)
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EAST + K0 * _R * x, K0 * _R * y


def to_geo(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees, of metres."""
    xi, eta = y / (K0 * _R), (x - EAST) / (K0 * _R)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return LON0 + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(phi)


def snap_box(y0: Column, x0: Column, y1: Column, x1: Column, step: float = 10.0) -> tuple[Column, Column, Column]:
    """Side and lower corner of a photo's box: 2.2 times the larger extent and 600 m, centred, on the grid."""
    side = F.ceil((F.greatest(y1 - y0, x1 - x0) * 2.2 + 600) / step) * step
    return side, F.rint(((y0 + y1) / 2 - side / 2) / step) * step, F.rint(((x0 + x1) / 2 - side / 2) / step) * step
