"""Exact polygon-to-polygon distance as an Arrow-batched column function.

The distance of two polygons is the smallest distance of any side of one to any
side of the other, and 0 where they overlap. Spark has no expression for it, and
expanding sides x sides rows per pair would multiply the data, so one NumPy kernel
works on whole Arrow batches.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel_comps.functions.geodesy import scale_at
from parcel_comps.functions.geometry import contains_point, nearest_side
from parcel_comps.functions.scalars import ColumnOrName, col

# Ship this module's code inside the UDF, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Side pairs evaluated at once; bounds the kernel's memory whatever the polygons.
_CHUNK = 1 << 20


class _Polygons:
    """Flat views of one Arrow column of polygons."""

    def __init__(self, column: pa.Array, scale_x: np.ndarray, scale_y: np.ndarray):
        parts = column.flatten()
        rings = parts.flatten()
        points = rings.flatten()
        row_parts = np.cumsum(np.r_[0, _lengths(column)])
        part_rings = np.cumsum(np.r_[0, _lengths(parts)])
        ring_points = np.cumsum(np.r_[0, _lengths(rings)])
        row_points = ring_points[part_rings[row_parts]]
        row_of_point = np.repeat(np.arange(len(column)), np.diff(row_points))
        self.x = _doubles(points.field("x")) * scale_x[row_of_point]
        self.y = _doubles(points.field("y")) * scale_y[row_of_point]
        # A side starts at every point but the last of its ring.
        starts_side = np.ones(len(self.x), dtype=bool)
        ends = ring_points[1:][np.diff(ring_points) > 0] - 1
        starts_side[ends] = False
        self.side = np.flatnonzero(starts_side)
        self.row_sides = np.searchsorted(self.side, row_points)
        # One vertex per part, for the containment test.
        first = ring_points[part_rings[:-1]]
        keep = ring_points[part_rings[1:]] > first
        self.part_point = first[keep]
        self.part_row = np.repeat(np.arange(len(column)), np.diff(row_parts))[keep]


def _lengths(lists: pa.Array) -> np.ndarray:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.nan_to_num(lengths.astype("float64")).astype("int64")


def _doubles(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype("float64")


def _point_to_side(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    along = (px - ax) * dx + (py - ay) * dy
    t = np.clip(np.divide(along, length2, out=np.zeros_like(along), where=length2 > 0), 0.0, 1.0)
    return (px - ax - t * dx) ** 2 + (py - ay - t * dy) ** 2


def _side_to_side(a: _Polygons, i: np.ndarray, b: _Polygons, j: np.ndarray) -> np.ndarray:
    """Squared distance of sides i of a to sides j of b."""
    ax, ay, bx, by = a.x[i], a.y[i], a.x[i + 1], a.y[i + 1]
    cx, cy, dx, dy = b.x[j], b.y[j], b.x[j + 1], b.y[j + 1]
    best = np.minimum(
        np.minimum(_point_to_side(ax, ay, cx, cy, dx, dy), _point_to_side(bx, by, cx, cy, dx, dy)),
        np.minimum(_point_to_side(cx, cy, ax, ay, bx, by), _point_to_side(dx, dy, ax, ay, bx, by)),
    )
    c_turn = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    d_turn = (bx - ax) * (dy - ay) - (by - ay) * (dx - ax)
    a_turn = (dx - cx) * (ay - cy) - (dy - cy) * (ax - cx)
    b_turn = (dx - cx) * (by - cy) - (dy - cy) * (bx - cx)
    best[(c_turn * d_turn < 0) & (a_turn * b_turn < 0)] = 0.0
    return best


def _nearest_sides(a: _Polygons, b: _Polygons, rows: int) -> np.ndarray:
    """Smallest squared side-to-side distance of every row."""
    n_a, n_b = np.diff(a.row_sides), np.diff(b.row_sides)
    pairs = np.cumsum(np.r_[0, n_a * n_b])
    best = np.full(rows, np.inf)
    for low in range(0, int(pairs[-1]), _CHUNK):
        k = np.arange(low, min(low + _CHUNK, int(pairs[-1])))
        row = np.searchsorted(pairs, k, side="right") - 1
        k -= pairs[row]
        i = a.side[a.row_sides[row] + k // n_b[row]]
        j = b.side[b.row_sides[row] + k % n_b[row]]
        starts = np.flatnonzero(np.r_[True, np.diff(row) > 0])
        nearest = np.minimum.reduceat(_side_to_side(a, i, b, j), starts)
        np.minimum.at(best, row[starts], nearest)
    return best


def _inside(a: _Polygons, b: _Polygons, rows: int) -> np.ndarray:
    """Rows where a part of a starts inside b, by crossing parity."""
    hit = np.zeros(rows, dtype=bool)
    n_b = np.diff(b.row_sides)
    sides = np.cumsum(np.r_[0, n_b[a.part_row]])
    crossings = np.zeros(len(a.part_row), dtype="int64")
    for low in range(0, int(sides[-1]), _CHUNK):
        k = np.arange(low, min(low + _CHUNK, int(sides[-1])))
        part = np.searchsorted(sides, k, side="right") - 1
        j = b.side[b.row_sides[a.part_row[part]] + k - sides[part]]
        px, py = a.x[a.part_point[part]], a.y[a.part_point[part]]
        cx, cy, dx, dy = b.x[j], b.y[j], b.x[j + 1], b.y[j + 1]
        straddles = (cy > py) != (dy > py)
        rise = np.where(straddles, dy - cy, 1.0)
        crosses = straddles & (px < (dx - cx) * (py - cy) / rise + cx)
        np.add.at(crossings, part[crosses], 1)
    hit[a.part_row[crossings % 2 == 1]] = True
    return hit


def _distances(a: pa.Array, b: pa.Array, scale_x: pa.Array, scale_y: pa.Array) -> pa.Array:
    valid = a.is_valid().to_numpy(zero_copy_only=False) & b.is_valid().to_numpy(zero_copy_only=False)
    scale_x, scale_y = _doubles(scale_x), _doubles(scale_y)
    left, right = _Polygons(a, scale_x, scale_y), _Polygons(b, scale_x, scale_y)
    gap = np.sqrt(_nearest_sides(left, right, len(a)))
    gap[_inside(left, right, len(a)) | _inside(right, left, len(a))] = 0.0
    # No sides on one side of the pair means no geometry to measure.
    return pa.array(gap, mask=~valid | np.isinf(gap))


@F.arrow_udf(T.DoubleType())
def _measure(a: pa.Array, b: pa.Array, sx: pa.Array, sy: pa.Array) -> pa.Array:
    return _distances(a, b, sx, sy)


# Marked so that the optimizer never copies the call into a filter above its projection:
# each pair is measured once.
_distance_udf = _measure.asNondeterministic()


_BOTH = T.StructType([T.StructField("metres", T.DoubleType()), T.StructField("degrees", T.DoubleType())])


@F.arrow_udf(_BOTH)
def _measure_both(a: pa.Array, b: pa.Array, sx: pa.Array, sy: pa.Array, near: pa.Array) -> pa.Array:
    near = near.fill_null(False)
    rows = pa.array(np.flatnonzero(near.to_numpy(zero_copy_only=False)))
    one = pa.array(np.ones(len(rows)))
    degrees = np.full(len(a), np.nan)
    if len(rows):
        found = _distances(a.take(rows), b.take(rows), one, one)
        degrees[rows.to_numpy()] = found.to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays(
        [_distances(a, b, sx, sy), pa.array(degrees, mask=np.isnan(degrees))], names=["metres", "degrees"]
    )


_both_udf = _measure_both.asNondeterministic()


def boundary_distances(a: ColumnOrName, b: ColumnOrName, ref_lat: ColumnOrName, near: Column, earth: str = "flat") -> Column:
    """Struct of ``metres`` and, where ``near`` holds, ``degrees``: both from one pass over the batch."""
    return _both_udf(col(a), col(b), *scale_at(ref_lat, earth), near)


def boundary_distance_m(a: ColumnOrName, b: ColumnOrName, ref_lat: ColumnOrName, earth: str = "flat") -> Column:
    """Metres between two polygons, 0 where they meet, scaled at ``ref_lat`` (``geodesy.scale_at``)."""
    return _distance_udf(col(a), col(b), *scale_at(ref_lat, earth))


def boundary_distance_deg(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Distance of two polygons in plain degrees."""
    return _distance_udf(col(a), col(b), F.lit(1.0), F.lit(1.0))


def point_distance_m(g: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName, earth: str = "flat") -> Column:
    """Metres from a point to a polygon, 0 inside it; NULL without sides to measure. No Python."""
    gap = nearest_side(g, lon, lat, *scale_at(lat, earth))
    return F.when(contains_point(g, lon, lat), F.lit(0.0)).otherwise(gap)


def touches(
    a: ColumnOrName,
    b: ColumnOrName,
    ref_lat: ColumnOrName,
    tolerance: float = 5.0,
    unit: str = "metres",
) -> Column:
    """Do two polygons meet within a tolerance in metres or in degrees?"""
    gap = boundary_distance_m(a, b, ref_lat) if unit == "metres" else boundary_distance_deg(a, b)
    return F.coalesce(gap <= F.lit(float(tolerance)), F.lit(False))
