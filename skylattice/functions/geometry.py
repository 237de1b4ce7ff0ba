"""Geometry of one row: boxes, rings, resampling weights and UTM coordinates."""

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PixelGrid:
    """Regular grid: pixel i has its centre at origin + (i + 1/2) * res.

    An origin may be a number, or the name of a column that both pixels and regions have,
    for grids that differ by tile. With ``north_up`` rows count downwards from ``y0``, as in
    rasters.
    """

    x0: float | str = 0.0
    y0: float | str = 0.0
    res: float = 10.0
    north_up: bool = False

    def _at(self, origin: float | str) -> Column:
        return F.col(origin) if isinstance(origin, str) else F.lit(origin)

    def center_x(self, x: Column) -> Column:
        return self._at(self.x0) + (x + F.lit(0.5)) * F.lit(self.res)

    def center_y(self, y: Column) -> Column:
        down = (y + F.lit(0.5)) * F.lit(self.res)
        return self._at(self.y0) - down if self.north_up else self._at(self.y0) + down

    def index_of(self, distance: Column, end=F.floor) -> Column:
        """Index whose centre is the last (``floor``) or first (``ceil``) by that distance."""
        return end(distance / F.lit(self.res) - F.lit(0.5)).cast("int")

    def range_x(self, low: str, high: str) -> tuple[Column, Column]:
        """First and last column whose centre lies within [low, high]."""
        start = self._at(self.x0)
        return self.index_of(F.col(low) - start, F.ceil), self.index_of(F.col(high) - start)

    def range_y(self, low: str, high: str) -> tuple[Column, Column]:
        """First and last row whose centre lies within [low, high]."""
        start = self._at(self.y0)
        if self.north_up:
            return self.index_of(start - F.col(high), F.ceil), self.index_of(start - F.col(low))
        return self.index_of(F.col(low) - start, F.ceil), self.index_of(F.col(high) - start)


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Closed ring of an axis-aligned box."""
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])


def join_rings(rings: Column) -> Column:
    """Several closed rings as one vertex list with a NULL between them.

    The even-odd rule holds for the union of edges, so holes and further parts need no
    other treatment; the gaps give no edge.
    """
    gap = F.array(F.lit(None).cast("struct<x:double,y:double>"))
    return F.flatten(F.transform(rings, lambda r, i: F.when(i == 0, r).otherwise(F.concat(gap, r))))


def split_rings(ring: Column) -> Column:
    """The closed rings of a vertex list; inverse of ``join_rings``."""
    gaps = F.filter(
        F.transform(ring, lambda p, i: F.when(p.isNull(), i)), lambda i: i.isNotNull()
    )
    starts = F.concat(F.array(F.lit(0)), F.transform(gaps, lambda i: i + 1))
    ends = F.concat(gaps, F.array(F.size(ring)))
    return F.zip_with(starts, ends, lambda a, b: F.slice(ring, a + 1, b - a))


def ring_bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def _edges(ring: Column) -> Column:
    n = F.size(ring) - 1
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )


def ring_crossings(ring: Column, py: Column) -> Column:
    """x positions at which the horizontal line through ``py`` crosses a closed ring."""
    spanning = F.filter(_edges(ring), lambda e: (e["a"]["y"] > py) != (e["b"]["y"] > py))

    def at_x(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]

    return F.transform(spanning, at_x)


def point_in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Even-odd rule: true if a ray from the point crosses the closed ring an odd number of times."""
    return F.size(F.filter(ring_crossings(ring, py), lambda x: px < x)) % 2 == 1


def cubic_weight(d: Column) -> Column:
    """Keys cubic convolution kernel with a = -1/2, for distance d >= 0."""
    near = F.lit(1.5) * d * d * d - F.lit(2.5) * d * d + F.lit(1.0)
    far = F.lit(-0.5) * d * d * d + F.lit(2.5) * d * d - F.lit(4.0) * d + F.lit(2.0)
    return F.when(d <= 1.0, near).when(d < 2.0, far).otherwise(F.lit(0.0))


# --- UTM on WGS84: Krueger series to third order ------------------------------------
# fixed values: ellipsoid and projection constants
_A = 6378137.0
_F = 1 / 298.257223563
_K0 = 0.9996
_FALSE_EASTING = 500000.0
_FALSE_NORTHING = 10000000.0

_n = _F / (2 - _F)
_RADIUS = _A / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_E = 2 * math.sqrt(_n) / (1 + _n)
_ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16,
    13 * _n**2 / 48 - 3 * _n**3 / 5,
    61 * _n**3 / 240,
)
_BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96,
    _n**2 / 48 + _n**3 / 15,
    17 * _n**3 / 480,
)
_DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3,
    7 * _n**2 / 3 - 8 * _n**3 / 5,
    56 * _n**3 / 15,
)


def _atanh(v: Column) -> Column:
    return F.lit(0.5) * F.log((F.lit(1.0) + v) / (F.lit(1.0) - v))


def utm_zone(lon: Column) -> Column:
    """Zone 1 to 60; longitude 180 belongs to the last one."""
    return F.least(F.floor((lon + F.lit(180.0)) / F.lit(6.0)) + 1, F.lit(60)).cast("int")


def _central_meridian(zone: Column) -> Column:
    return F.radians(zone.cast("double") * F.lit(6.0) - F.lit(183.0))


def to_utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres in the given zone."""
    phi = F.radians(lat)
    dlon = F.radians(lon) - _central_meridian(zone)
    sin_phi = F.sin(phi)
    t = F.sinh(_atanh(sin_phi) - F.lit(_E) * _atanh(F.lit(_E) * sin_phi))
    xi = F.atan2(t, F.cos(dlon))
    eta = _atanh(F.sin(dlon) / F.sqrt(F.lit(1.0) + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        k = F.lit(2.0 * j)
        east = east + F.lit(a) * F.cos(k * xi) * F.sinh(k * eta)
        north = north + F.lit(a) * F.sin(k * xi) * F.cosh(k * eta)
    scale = F.lit(_K0 * _RADIUS)
    south = F.when(lat < 0, F.lit(_FALSE_NORTHING)).otherwise(F.lit(0.0))
    return F.lit(_FALSE_EASTING) + scale * east, south + scale * north


def to_lonlat(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees; ``south`` is true for the southern hemisphere."""
    scale = F.lit(_K0 * _RADIUS)
    y = north - F.when(south, F.lit(_FALSE_NORTHING)).otherwise(F.lit(0.0))
    xi, eta = y / scale, (east - F.lit(_FALSE_EASTING)) / scale
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        k = F.lit(2.0 * j)
        xi0 = xi0 - F.lit(b) * F.sin(k * xi) * F.cosh(k * eta)
        eta0 = eta0 - F.lit(b) * F.cos(k * xi) * F.sinh(k * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lon = _central_meridian(zone) + F.atan2(F.sinh(eta0), F.cos(xi0))
    return F.degrees(lon), F.degrees(phi)
