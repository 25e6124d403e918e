"""Projections of ellipsoids as native expressions: transverse Mercator and Lambert's conformal conic, both ways.

Longitude and latitude are in degrees, x and y in the ellipsoid's unit. Transverse Mercator takes Krueger's series to the
fourth power of the third flattening (errors of nanometres within 30 degrees of the meridian); Lambert's conic is closed
forward and its inverse takes the series of the conformal latitude. Datum shifts are out of scope. Nulls give nulls.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ellipsoid:
    a: float = 6378137.0
    inverse_flattening: float = 298.257223563

    @property
    def n(self) -> float:
        """The third flattening."""
        return 1 / (2 * self.inverse_flattening - 1)

    @property
    def e(self) -> float:
        """The eccentricity."""
        f = 1 / self.inverse_flattening
        return math.sqrt(f * (2 - f))


WGS84 = Ellipsoid()

#: Coefficients of n to n^4 in the series of geographic to projected, of projected to geographic, and of
#: conformal to geographic latitude, for the sines of 2, 4, 6 and 8 times the angle.
FORWARD = [(1 / 2, -2 / 3, 5 / 16, 41 / 180), (0, 13 / 48, -3 / 5, 557 / 1440), (0, 0, 61 / 240, -103 / 140), (0, 0, 0, 49561 / 161280)]
BACKWARD = [(1 / 2, -2 / 3, 37 / 96, -1 / 360), (0, 1 / 48, 1 / 15, -437 / 1440), (0, 0, 17 / 480, -37 / 840), (0, 0, 0, 4397 / 161280)]
LATITUDE = [(2, -2 / 3, -2, 116 / 45), (0, 7 / 3, -8 / 5, -227 / 45), (0, 0, 56 / 15, -136 / 35), (0, 0, 0, 4279 / 630)]


def series(coefficients: list[tuple[float, ...]], n: float) -> list[float]:
    return [sum(c * n ** (k + 1) for k, c in enumerate(row)) for row in coefficients]


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    lat0: float = 0.0
    k0: float = 0.9996
    x0: float = 500_000.0
    y0: float = 0.0
    ellipsoid: Ellipsoid = WGS84

    @property
    def radius(self) -> float:
        """Of the circle whose circumference is the meridian's, scaled."""
        n = self.ellipsoid.n
        return self.k0 * self.ellipsoid.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def origin(self) -> float:
        """The northing, before ``y0``, of the latitude of origin."""
        e, lat = self.ellipsoid.e, math.radians(self.lat0)
        chi = math.atan(math.sinh(math.atanh(math.sin(lat)) - e * math.atanh(e * math.sin(lat))))
        return self.radius * (chi + sum(c * math.sin(2 * (j + 1) * chi) for j, c in enumerate(series(FORWARD, self.ellipsoid.n))))

    def forward(self, lon: Column, lat: Column) -> Column:
        e, phi, lam = self.ellipsoid.e, F.radians(lat), F.radians(lon - self.lon0)
        t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
        north, east = F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
        x, y = east, north
        for j, c in enumerate(series(FORWARD, self.ellipsoid.n), 1):
            x = x + c * F.cos(2 * j * north) * F.sinh(2 * j * east)
            y = y + c * F.sin(2 * j * north) * F.cosh(2 * j * east)
        return F.struct((x * self.radius + self.x0).alias("x"), (y * self.radius - self.origin + self.y0).alias("y"))

    def inverse(self, x: Column, y: Column) -> Column:
        n = self.ellipsoid.n
        north, east = (y - self.y0 + self.origin) / self.radius, (x - self.x0) / self.radius
        u, v = north, east
        for j, c in enumerate(series(BACKWARD, n), 1):
            u = u - c * F.sin(2 * j * north) * F.cosh(2 * j * east)
            v = v - c * F.cos(2 * j * north) * F.sinh(2 * j * east)
        chi = F.asin(F.sin(u) / F.cosh(v))
        return F.struct((F.degrees(F.atan2(F.sinh(v), F.cos(u))) + self.lon0).alias("x"), F.degrees(_latitude(chi, n)).alias("y"))


def _latitude(chi: Column, n: float) -> Column:
    """The geographic latitude of a conformal one."""
    return sum((c * F.sin(2 * j * chi) for j, c in enumerate(series(LATITUDE, n), 1)), chi)


@dataclass(frozen=True)
class LambertConformal:
    lon0: float
    lat0: float
    lat1: float
    lat2: float
    x0: float = 0.0
    y0: float = 0.0
    ellipsoid: Ellipsoid = WGS84

    def _isometric(self, lat: float) -> float:
        e, s = self.ellipsoid.e, math.sin(math.radians(lat))
        return math.atanh(s) - e * math.atanh(e * s)

    def _scale(self, lat: float) -> float:
        e, phi = self.ellipsoid.e, math.radians(lat)
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    @property
    def cone(self) -> float:
        if self.lat1 == self.lat2:
            return math.sin(math.radians(self.lat1))
        return math.log(self._scale(self.lat1) / self._scale(self.lat2)) / (self._isometric(self.lat2) - self._isometric(self.lat1))

    @property
    def reach(self) -> float:
        """The radius of the equator's arc."""
        return self.ellipsoid.a * self._scale(self.lat1) * math.exp(self.cone * self._isometric(self.lat1)) / self.cone

    @property
    def origin(self) -> float:
        return self.reach * math.exp(-self.cone * self._isometric(self.lat0))

    def forward(self, lon: Column, lat: Column) -> Column:
        e, s = self.ellipsoid.e, F.sin(F.radians(lat))
        rho = self.reach * F.exp(-self.cone * (F.atanh(s) - e * F.atanh(e * s)))
        turn = self.cone * F.radians(lon - self.lon0)
        return F.struct((rho * F.sin(turn) + self.x0).alias("x"), (F.lit(self.origin) - rho * F.cos(turn) + self.y0).alias("y"))

    def inverse(self, x: Column, y: Column) -> Column:
        sign = math.copysign(1.0, self.cone)
        dx, dy = (x - self.x0) * sign, (F.lit(self.origin) - (y - self.y0)) * sign
        rho = F.sqrt(dx * dx + dy * dy) * sign
        chi = F.atan(F.sinh(F.log(self.reach / rho) / self.cone))
        return F.struct((F.degrees(F.atan2(dx, dy) / self.cone) + self.lon0).alias("x"), F.degrees(_latitude(chi, self.ellipsoid.n)).alias("y"))


def utm(zone: int, south: bool = False) -> TransverseMercator:
    return TransverseMercator(lon0=6.0 * zone - 183.0, y0=10_000_000.0 if south else 0.0)
