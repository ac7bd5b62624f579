"""Map projections as plain expressions, so that they run inside code generation.

Formulas: conformal conic with two parallels, transverse Mercator by Krueger series, and the
closed geocentric conversion, as in public geodesy guides. Angles are degrees at the surface.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The GRS80 ellipsoid, and EPSG:3301 (L-EST97).
A, INVERSE_F = 6378137.0, 298.257222101
LAT0, LON0 = 57 + 31 / 60 + 3.19415 / 3600, 24.0
PARALLELS = (58.0, 59 + 20 / 60)
FALSE_EAST, FALSE_NORTH = 500000.0, 6375000.0

_FLAT = 1 / INVERSE_F
_E = math.sqrt(_FLAT * (2 - _FLAT))


def _t(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_E * math.sin(lat)) ** 2)


_P1, _P2 = (math.radians(p) for p in PARALLELS)
_N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
_K = A * _m(_P1) / (_N * _t(_P1) ** _N)
_R0 = _K * _t(math.radians(LAT0)) ** _N


def conic_forward(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(east, north) in EPSG:3301 of degrees."""
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    r = F.pow(t, F.lit(_N)) * _K
    theta = (F.radians(lon) - math.radians(LON0)) * _N
    return FALSE_EAST + r * F.sin(theta), FALSE_NORTH + _R0 - r * F.cos(theta)


def conic_inverse(east: Column, north: Column) -> tuple[Column, Column]:
    """(lat, lon) degrees of EPSG:3301 coordinates."""
    x, y = east - FALSE_EAST, _R0 - (north - FALSE_NORTH)
    r = F.sqrt(x * x + y * y)
    t = F.pow(r / _K, F.lit(1 / _N))
    chi = math.pi / 2 - F.atan(t) * 2
    # Series in the eccentricity from conformal to geodetic latitude.
    e2 = _E * _E
    c2 = e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360
    c4 = 7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520
    c6 = 7 * e2**3 / 120 + 81 * e2**4 / 1120
    c8 = 4279 * e2**4 / 161280
    phi = chi + F.sin(chi * 2) * c2 + F.sin(chi * 4) * c4 + F.sin(chi * 6) * c6 + F.sin(chi * 8) * c8
    return F.degrees(phi), F.degrees(F.atan2(x, y) / _N) + LON0


def transverse_forward(lat: Column, lon: Column, lon0: float = 27.0, k0: float = 0.9996, false_east: float = 500000.0) -> tuple[Column, Column]:
    """(east, north) in a UTM zone (35N by default) of degrees."""
    n = _FLAT / (2 - _FLAT)
    big = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    s = F.sin(F.radians(lat))
    tau = F.sinh(F.atanh(s) - F.atanh(s * _E) * _E)
    d = F.radians(lon - lon0)
    xi, eta = F.atan2(tau, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + tau * tau))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
    return false_east + east * (k0 * big), north * (k0 * big)


def transverse_inverse(east: Column, north: Column, lon0: float = 27.0, k0: float = 0.9996, false_east: float = 500000.0) -> tuple[Column, Column]:
    """(lat, lon) degrees of UTM coordinates."""
    n = _FLAT / (2 - _FLAT)
    big = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = north / (k0 * big), (east - false_east) / (k0 * big)
    x, e = xi, eta
    for j, b in enumerate(beta, 1):
        x = x - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b
        e = e - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b
    chi = F.asin(F.sin(x) / F.cosh(e))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + F.sin(chi * (2 * j)) * d
    return F.degrees(phi), F.degrees(F.atan2(F.sinh(e), F.cos(x))) + lon0


def geocentric_to_geodetic(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """(lat, lon, height) of geocentric metres, by Bowring's formula."""
    e2 = _E * _E
    b = A * (1 - _FLAT)
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * A, p * b)
    lat = F.atan2(z + F.pow(F.sin(theta), F.lit(3.0)) * (e2 * A * A / b), p - F.pow(F.cos(theta), F.lit(3.0)) * (e2 * A))
    v = A / F.sqrt(1 - F.pow(F.sin(lat), F.lit(2.0)) * e2)
    height = p * F.cos(lat) + z * F.sin(lat) - (A * A) / v
    return F.degrees(lat), F.degrees(F.atan2(y, x)), height


def geodetic_to_geocentric(lat: Column, lon: Column, height: Column) -> tuple[Column, Column, Column]:
    e2 = _E * _E
    phi, lam = F.radians(lat), F.radians(lon)
    v = A / F.sqrt(1 - F.pow(F.sin(phi), F.lit(2.0)) * e2)
    return (v + height) * F.cos(phi) * F.cos(lam), (v + height) * F.cos(phi) * F.sin(lam), (v * (1 - e2) + height) * F.sin(phi)


def geocentric_to_conic(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    lat, lon, height = geocentric_to_geodetic(x, y, z)
    east, north = conic_forward(lat, lon)
    return east, north, height
