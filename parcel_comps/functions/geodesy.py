"""Measures on the WGS84 ellipsoid as column expressions.

Areas are exact for rings whose sides are straight in longitude and authalic latitude; at the size of parcels these do not
differ from geodesics. Distances scale both axes by the ellipsoid's own radii at one latitude, which is right to
about a millionth for what lies within some kilometres of it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.geometry import ring_area, sum_of
from parcel_comps.functions.scalars import ColumnOrName, col

# The ellipsoid's larger radius in metres and its flattening.
RADIUS_M = 6378137.0
FLATTENING = 1 / 298.257223563

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)
#: How much longer a measure on the flat earth can be than one on the ellipsoid: a degree of latitude at the equator.
FLAT_EXCESS = 1.01


def metres_per_degree(lat: ColumnOrName) -> tuple[Column, Column]:
    """Metres of a degree of longitude and of latitude at ``lat``."""
    sine = F.sin(F.radians(col(lat)))
    w = F.lit(1.0) - F.lit(_E2) * sine * sine
    degree = RADIUS_M * math.pi / 180
    return F.cos(F.radians(col(lat))) * degree / F.sqrt(w), F.lit(degree * (1 - _E2)) / (w * F.sqrt(w))


def scale_at(lat: ColumnOrName, earth: str) -> tuple[Column, Column]:
    """``metres_per_degree`` of an earth: "wgs84", or "flat" with one degree for all latitudes."""
    if earth == "wgs84":
        return metres_per_degree(lat)
    if earth != "flat":
        raise ValueError(f"unknown earth {earth!r}, expected 'flat' or 'wgs84'")
    return F.cos(F.radians(col(lat))) * fixed.METRES_PER_DEGREE, F.lit(fixed.METRES_PER_DEGREE)


def _authalic(lat: Column) -> Column:
    """A number that grows with latitude like the area south of it."""
    sine = F.sin(F.radians(lat))
    part = F.log((1.0 - _E * sine) / (1.0 + _E * sine)) / (2 * _E)
    return (sine / (1.0 - _E2 * sine * sine) - part) * (1 - _E2)


def area_acres_wgs84(g: ColumnOrName, subtract_holes: bool = False) -> Column:
    """Area on the ellipsoid; holes count as land unless ``subtract_holes``."""

    def area(ring: Column) -> Column:
        flat = F.transform(ring, lambda p: F.struct(F.radians(p["x"]).alias("x"), _authalic(p["y"]).alias("y")))
        return ring_area(flat) * (RADIUS_M * RADIUS_M / 2)

    def part_area(part: Column) -> Column:
        square = area(F.get(part, F.lit(0)))
        if subtract_holes:
            square = square - sum_of(F.transform(F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))), area))
        return F.coalesce(square, F.lit(0.0))

    return sum_of(F.transform(col(g), part_area)) / F.lit(fixed.SQM_PER_ACRE)
