"""Great-circle distance and the two grids used to turn distance joins into equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0

# A cell is a hair wider than the search radius, so that rounding in the division
# can never put two points within the radius more than one cell apart.
_EDGE_MARGIN = 1.0 + 1e-9


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in km; the root's argument is clamped so antipodes stay finite."""
    half_lat = F.radians(lat_b - lat_a) / 2
    half_lon = F.radians(lon_b - lon_a) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.sin(
        half_lon
    ) * F.sin(half_lon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def km_to_degrees(km: float) -> float:
    return km / KM_PER_DEGREE


def usable_position(lat: Column, lon: Column) -> Column:
    """Both coordinates present and not NaN."""
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def degree_cell(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width * _EDGE_MARGIN)).cast("long")


def sphere_edge(km: float) -> float:
    """Cell edge of the unit-sphere grid: two points within ``km`` differ by at most this per axis."""
    return 2 * math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2)) * _EDGE_MARGIN


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    lat_r, lon_r = F.radians(lat), F.radians(lon)
    return F.cos(lat_r) * F.cos(lon_r), F.cos(lat_r) * F.sin(lon_r), F.sin(lat_r)


def chord_rank(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whole number that grows with the distance of two unit vectors, at about a millimetre's grain.

    It orders distances without a sine per pair, and equal distances compare equal.
    """
    square = sum(((p - q) * (p - q) for p, q in zip(a, b)), F.lit(0.0))
    return F.floor(square * F.lit(1e15) + F.lit(0.5)).cast("long")


def sphere_cell(lat: Column, lon: Column, km: float) -> Column:
    """Cell of the point's unit vector. Unlike a degree grid it has no poles and no date line."""
    edge = F.lit(sphere_edge(km))
    x, y, z = unit_vector(lat, lon)
    return F.struct(
        F.floor(x / edge).cast("long").alias("x"),
        F.floor(y / edge).cast("long").alias("y"),
        F.floor(z / edge).cast("long").alias("z"),
    )


def _offsets(half: bool) -> list[tuple[int, int, int]]:
    around = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    return [o for o in around if o >= (0, 0, 0)] if half else around


def neighbour_cells(cell: Column, km: float, half: bool = False) -> Column:
    """Array of the cells around ``cell`` that the sphere's surface crosses.

    With ``half`` only the cell itself and the neighbours that sort after it are listed, so
    that a self-join meets every unordered pair of neighbouring cells once.
    """
    edge = sphere_edge(km)
    cells = F.array(
        *[
            F.struct(
                (cell["x"] + F.lit(i)).alias("x"),
                (cell["y"] + F.lit(j)).alias("y"),
                (cell["z"] + F.lit(k)).alias("z"),
                F.lit((i, j, k) == (0, 0, 0)).alias("own"),
            )
            for i, j, k in _offsets(half)
        ]
    )

    def crosses(c: Column) -> Column:
        near, far = F.lit(0.0), F.lit(0.0)
        for axis in ("x", "y", "z"):
            low, high = c[axis] * F.lit(edge), (c[axis] + F.lit(1)) * F.lit(edge)
            nearest = F.greatest(low, -high, F.lit(0.0))
            farthest = F.greatest(F.abs(low), F.abs(high))
            near, far = near + nearest * nearest, far + farthest * farthest
        return (near <= F.lit(1.0 + 1e-9)) & (far >= F.lit(1.0 - 1e-9))

    return F.filter(cells, crosses)
