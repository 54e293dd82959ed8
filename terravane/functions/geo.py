"""Measures on the sphere, tile arithmetic and box algebra as Column expressions.

Coordinates are WGS84 degrees. A ring is array<struct<x: double, y: double>>, closed. The measures differ on purpose and are
not interchangeable: spherical area and length, planar degrees scaled to km, and box arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
#: Kilometres of a degree of a great circle.
DEGREE_KM = 2 * math.pi * EARTH_KM / 360
PI = math.pi


def _wrapped(delta: Column) -> Column:
    return F.when(delta > PI, delta - 2 * PI).when(delta < -PI, delta + 2 * PI).otherwise(delta)


def haversine_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    a, b = F.radians(y1), F.radians(y2)
    d_lon = _wrapped(F.radians(x2) - F.radians(x1))
    value = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(d_lon / 2), F.lit(2.0))
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(value)))


def _segments(ring: Column) -> Column:
    n = F.size(ring)
    return F.when(n > 1, F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), lambda p, q: F.struct(p.x.alias("x1"), p.y.alias("y1"), q.x.alias("x2"), q.y.alias("y2"))))


def line_km(ring: Column) -> Column:
    """Great-circle length of a line or ring."""
    return F.aggregate(_segments(ring), F.lit(0.0), lambda t, s: t + haversine_km(s.x1, s.y1, s.x2, s.y2))


def ring_area_km2(ring: Column) -> Column:
    """Area on the sphere by trapezoids, the antimeridian unwrapped; 0 for fewer than four points."""
    total = F.aggregate(_segments(ring), F.lit(0.0), lambda t, s: t + _wrapped(F.radians(s.x2) - F.radians(s.x1)) * (2 + F.sin(F.radians(s.y1)) + F.sin(F.radians(s.y2))))
    return F.when(F.size(ring) < 4, 0.0).otherwise(F.abs(total) * F.lit(EARTH_KM**2 / 2))


def ring_moments(ring: Column) -> tuple[Column, Column]:
    """Signed planar area of a ring, and that area times the latitude of its centroid."""
    turn = lambda s: s.x1 * s.y2 - s.x2 * s.y1
    area = F.aggregate(_segments(ring), F.lit(0.0), lambda a, s: a + turn(s)) / 2
    moment = F.aggregate(_segments(ring), F.lit(0.0), lambda a, s: a + turn(s) * (s.y1 + s.y2)) / 6
    return area, moment


def box_area_km2(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """ring_area_km2 of a box, in closed form."""
    return F.abs(F.radians(x2) - F.radians(x1)) * F.abs(F.sin(F.radians(y2)) - F.sin(F.radians(y1))) * F.lit(EARTH_KM**2)


def planar_km(degrees: Column) -> Column:
    return degrees * F.lit(DEGREE_KM)


def local_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in a local frame: 110.574 km a degree of latitude, 111.320 cos(latitude) one of longitude."""
    dx = (x2 - x1) * 111.320 * F.cos(F.radians((y1 + y2) / 2))
    return F.hypot(dx, (y2 - y1) * 110.574)


def tile_column(lon: Column, zoom: Column) -> Column:
    """The column of tiles by the formula alone, past the map's edges as well."""
    return F.floor((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("long")


def tile_x(lon: Column, zoom: Column) -> Column:
    return F.least(F.greatest(tile_column(lon, zoom), F.lit(0)), F.pow(F.lit(2.0), zoom) - 1).cast("long")


def mercator(lat: Column) -> Column:
    """The height of a latitude on the Mercator map in radians. Spark's asinh of a large negative number is -Infinity, so the sign goes apart."""
    t = F.tan(F.radians(lat))
    return F.signum(t) * F.asinh(F.abs(t))


def on_globe(lat: Column) -> Column:
    """The latitude, or the pole beyond which it lies."""
    return F.when(lat > 90, 90.0).when(lat < -90, -90.0).otherwise(lat)


def tile_row(lat: Column, zoom: Column) -> Column:
    """The row of tiles by the formula alone, which goes on past the map's edge and repeats beyond the poles."""
    return F.floor((1.0 - mercator(lat) / PI) / 2.0 * F.pow(F.lit(2.0), zoom)).cast("long")


def tile_y(lat: Column, zoom: Column) -> Column:
    return F.least(F.greatest(tile_row(on_globe(lat), zoom), F.lit(0)), F.pow(F.lit(2.0), zoom) - 1).cast("long")


def tile_bounds(z: Column, x: Column, y: Column) -> Column:
    """West, south, east, north of a Web-Mercator tile."""
    n = F.pow(F.lit(2.0), z)
    lat = lambda row: F.degrees(F.atan(F.sinh(F.lit(PI) * (1.0 - 2.0 * row / n))))
    return F.struct((x / n * 360.0 - 180.0).alias("west"), lat(y + 1).alias("south"), ((x + 1) / n * 360.0 - 180.0).alias("east"), lat(y).alias("north"))


def tile_pixel(value: Column, low: Column, high: Column, extent: int = 4096) -> Column:
    """The place in a tile's extent, halves to even."""
    return F.bround((value - low) / (high - low) * extent, 0).cast("long")


def _bits(value: Column, n: Column, left: bool) -> Column:
    return F.call_function("shiftleft" if left else "shiftright", value.cast("long"), n.cast("int"))


#: Tiles of all zooms below each; zooms go to 31.
TILES_BELOW = [(4**z - 1) // 3 for z in range(32)]


def _below(z: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n).cast("long") for n in TILES_BELOW]), (z + 1).cast("int"))


def _curve() -> tuple[list[int], list[int]]:
    """Two levels of the Hilbert curve at a time: from the turn so far and two bits each of x and y to the turn after them and four bits of
    the number, and back; both have turn * 16 + bits at turn * 16 + bits. A turn is 2 if x and y are exchanged, plus 1 if they are reversed."""
    there, back = [0] * 64, [0] * 64
    for turn in range(4):
        for xy in range(16):
            swap, flip, d = turn >> 1, turn & 1, 0
            for level in (1, 0):
                x, y = xy >> 2 + level & 1, xy >> level & 1
                rx, ry = (y ^ flip, x ^ flip) if swap else (x ^ flip, y ^ flip)
                d = d << 2 | 3 * rx ^ ry
                if not ry:
                    swap, flip = swap ^ 1, flip ^ rx
            after = (swap << 1 | flip) << 4
            there[turn << 4 | xy], back[turn << 4 | d] = after | d, after | xy
    return there, back


def _table(values: list[int], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def _steps() -> Column:
    return F.sequence(F.lit(1), F.lit(16))


def _bound(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def hilbert_tile_id(z: Column, x: Column, y: Column) -> Column:
    """The number of a tile along the Hilbert curves of all zooms up to its own, in whole numbers alone."""
    zero, four = F.lit(0).cast("long"), F.lit(4)
    top = lambda v: _bits(v, 32 - z, True)  # noqa: E731  the zoom's bits are the first of 32
    start = F.struct(zero.alias("d"), F.lit(0).alias("e"), top(x).alias("x"), top(y).alias("y"))
    bits = lambda v: _bits(v, F.lit(30), False).bitwiseAND(F.lit(3).cast("long"))
    number = lambda s: _bits(s.d, four, True).bitwiseOR(s.e.bitwiseAND(F.lit(15)).cast("long"))

    def step(s: Column, _: Column) -> Column:
        at = s.e.bitwiseAND(F.lit(48)).cast("long") + bits(s.x) * 4 + bits(s.y)
        return F.struct(number(s).alias("d"), _table(_curve()[0], at).alias("e"), _bits(s.x, F.lit(2), True).alias("x"), _bits(s.y, F.lit(2), True).alias("y"))

    return _below(z) + F.aggregate(_steps(), start, step, lambda s: F.call_function("shiftrightunsigned", number(s), (64 - 2 * z).cast("int")))


def tile_of_hilbert(tile_id: Column) -> Column:
    """(z, x, y) of a number of hilbert_tile_id."""
    zero = F.lit(0).cast("long")
    below = F.array(*[F.lit(n).cast("long") for n in TILES_BELOW])
    number = lambda t: F.struct(t.cast("long").alias("id"), (F.size(F.filter(below, lambda n: n <= t)) - 1).cast("int").alias("z"))
    more = lambda v, e, shift: _bits(v, F.lit(2), True).bitwiseOR(_bits(e, F.lit(shift), False).bitwiseAND(F.lit(3).cast("long")))

    def step(s: Column, _: Column) -> Column:
        at = s.e.bitwiseAND(F.lit(48)).cast("long") + F.call_function("shiftrightunsigned", s.d, F.lit(60))
        return F.struct(_bits(s.d, F.lit(4), True).alias("d"), _table(_curve()[1], at).alias("e"), more(s.x, s.e, 2).alias("x"), more(s.y, s.e, 0).alias("y"))

    def place(p: Column) -> Column:
        start = F.struct(_bits(p.id - _below(p.z), 64 - 2 * p.z, True).alias("d"), F.lit(0).alias("e"), zero.alias("x"), zero.alias("y"))
        end = lambda v: _bits(v, 32 - p.z, False)
        return F.aggregate(_steps(), start, step, lambda s: F.struct(p.z.alias("z"), end(more(s.x, s.e, 2)).alias("x"), end(more(s.y, s.e, 0)).alias("y")))

    return _bound(_bound(tile_id, number), place)


def boxes_meet(a: str, b: str) -> Column:
    """Whether two boxes (x1, y1, x2, y2 under the prefixes) have a point in common."""
    c = F.col
    return (c(f"{a}x1") <= c(f"{b}x2")) & (c(f"{b}x1") <= c(f"{a}x2")) & (c(f"{a}y1") <= c(f"{b}y2")) & (c(f"{b}y1") <= c(f"{a}y2"))


def box_overlap(a: str, b: str) -> Column:
    """Area of the intersection of two boxes in square degrees."""
    c = F.col
    w = F.least(c(f"{a}x2"), c(f"{b}x2")) - F.greatest(c(f"{a}x1"), c(f"{b}x1"))
    h = F.least(c(f"{a}y2"), c(f"{b}y2")) - F.greatest(c(f"{a}y1"), c(f"{b}y1"))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def covers(ring: Column, x: Column, y: Column) -> Column:
    """Whether a simple ring covers a point: inside by the parity of crossings, or on the border."""
    on = F.exists(_segments(ring), lambda s: ((s.x2 - s.x1) * (y - s.y1) == (s.y2 - s.y1) * (x - s.x1)) & x.between(F.least(s.x1, s.x2), F.greatest(s.x1, s.x2)) & y.between(F.least(s.y1, s.y2), F.greatest(s.y1, s.y2)))
    crossings = F.size(F.filter(_segments(ring), lambda s: ((s.y1 > y) != (s.y2 > y)) & (x < (s.x2 - s.x1) * (y - s.y1) / (s.y2 - s.y1) + s.x1)))
    return on | (crossings % 2 == 1)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance of a point from a segment."""
    dx, dy = x2 - x1, y2 - y1
    n = dx * dx + dy * dy
    t = F.when(n > 0, F.least(F.greatest(((px - x1) * dx + (py - y1) * dy) / n, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return F.hypot(px - (x1 + t * dx), py - (y1 + t * dy))
