"""Transverse Mercator (UTM zones on WGS84) and back, as Column expressions, by the Krueger series to the third order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions import geometry as g

# The WGS84 ellipsoid and UTM's scale and false easting.
A, FLATTENING, SCALE, EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
N = FLATTENING / (2 - FLATTENING)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
# The series' coefficients.
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)
ECC = 2 * N**0.5 / (1 + N)


def zone(lon: Column) -> Column:
    return (F.floor(lon / 6) + 31).cast("int")


def _sum(first: Column, terms) -> Column:
    for t in terms:
        first = first + t
    return first


def to_metric(pt: Column, zone_: Column) -> Column:
    """Longitude and latitude (x, y in degrees) to metres of a zone, north of the equator."""
    phi, lam = F.radians(pt["y"]), F.radians(pt["x"] - (zone_ * 6 - 183))
    sin = F.sin(phi)
    t = F.sinh(F.atanh(sin) - ECC * F.atanh(ECC * sin))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = _sum(eta, (a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(ALPHA, 1)))
    north = _sum(xi, (a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(ALPHA, 1)))
    return g.point(EAST + SCALE * RADIUS * east, SCALE * RADIUS * north)


def to_degrees(pt: Column, zone_: Column) -> Column:
    """Metres of a zone to longitude and latitude."""
    xi, eta = pt["y"] / (SCALE * RADIUS), (pt["x"] - EAST) / (SCALE * RADIUS)
    xi1 = _sum(xi, (-b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(BETA, 1)))
    eta1 = _sum(eta, (-b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(BETA, 1)))
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = _sum(chi, (d * F.sin(2 * j * chi) for j, d in enumerate(DELTA, 1)))
    lam = F.atan2(F.sinh(eta1), F.cos(xi1))
    return g.point(F.degrees(lam) + (zone_ * 6 - 183), F.degrees(phi))


def line_to_metric(line: Column, zone_: Column) -> Column:
    return F.transform(line, lambda p: to_metric(p, zone_))
