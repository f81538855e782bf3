"""Geometry column functions on ``array<array<array<struct<x,y>>>>`` polygons.

Parts hold rings and rings hold points; the first ring of a part is its outer
boundary. Lengths use a flat earth: 111,320 m per degree of latitude, scaled by
the cosine of a reference latitude for longitude.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions.scalars import ColumnOrName, col

_RING = "array<array<double>>"
_POLYGON = f"array<{_RING}>"
_MULTIPOLYGON = f"array<{_POLYGON}>"
_HEAD = "type string, coordinates string, rings string"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: Spark does not share sub-expressions
    of higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- parsing and writing -------------------------------------------------------------


def _points(rings: Column) -> Column:
    def point(p: Column) -> Column:
        return F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, point))


def parse_geometry(c: ColumnOrName) -> Column:
    """GeoJSON Polygon / MultiPolygon text, or Esri ``rings``, to canonical parts.

    Other kinds give NULL; see ``geometry_kind`` and ``parse_point``. An Esri
    polygon becomes one part even when it has several outer rings.
    """

    def parts(head: Column) -> Column:
        polygon = F.from_json(head["coordinates"], _POLYGON)
        multipolygon = F.from_json(head["coordinates"], _MULTIPOLYGON)
        return (
            F.when(head["type"] == "Polygon", F.array(_points(polygon)))
            .when(head["type"] == "MultiPolygon", F.transform(multipolygon, _points))
            .when(
                head["rings"].isNotNull(), F.array(_points(F.from_json(head["rings"], _POLYGON)))
            )
        )

    return _let(F.from_json(col(c), _HEAD), parts)


def geometry_kind(c: ColumnOrName) -> Column:
    return _let(
        F.from_json(col(c), _HEAD),
        lambda head: F.coalesce(head["type"], F.when(head["rings"].isNotNull(), F.lit("Polygon"))),
    )


def parse_point(c: ColumnOrName) -> Column:
    """Coordinates of a GeoJSON Point as ``struct<x,y>``, else NULL."""

    def point(head: Column) -> Column:
        xy = F.from_json(head["coordinates"], "array<double>")
        return F.when(
            head["type"] == "Point",
            F.struct(F.get(xy, F.lit(0)).alias("x"), F.get(xy, F.lit(1)).alias("y")),
        )

    return _let(F.from_json(col(c), _HEAD), point)


def to_multipolygon(g: ColumnOrName) -> Column:
    """Canonical parts as a GeoJSON MultiPolygon struct."""
    xy = F.transform(
        col(g),
        lambda part: F.transform(
            part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
        ),
    )
    return F.when(
        col(g).isNotNull(), F.struct(F.lit("MultiPolygon").alias("type"), xy.alias("coordinates"))
    )


def point_geojson(lon: ColumnOrName, lat: ColumnOrName) -> Column:
    return F.struct(
        F.lit("Point").alias("type"), F.array(col(lon), col(lat)).alias("coordinates")
    )


def hookline(
    lon: ColumnOrName, lat: ColumnOrName, end_lon: ColumnOrName, end_lat: ColumnOrName
) -> Column:
    """Two-point line from a listing to a comp as a GeoJSON struct."""
    ends = F.array(F.array(col(lon), col(lat)), F.array(col(end_lon), col(end_lat)))
    return F.struct(F.lit("LineString").alias("type"), ends.alias("coordinates"))


def rectangle(xmin: ColumnOrName, ymin: ColumnOrName, xmax: ColumnOrName, ymax: ColumnOrName) -> Column:
    """A one-part axis-aligned rectangle with a closed ring."""
    x0, y0, x1, y1 = (col(c) for c in (xmin, ymin, xmax, ymax))
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.array(F.array(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])))


# --- measures of one geometry --------------------------------------------------------


def vertices(g: ColumnOrName) -> Column:
    return F.flatten(F.flatten(col(g)))


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _mean_of(points: Column, axis: str) -> Column:
    total = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p[axis])
    return total / F.nullif(F.size(points), F.lit(0))


def _mean(points: Column) -> Column:
    return _let(
        points,
        lambda pts: F.when(
            F.size(pts) > 0,
            F.struct(_mean_of(pts, "y").alias("lat"), _mean_of(pts, "x").alias("lon")),
        ),
    )


def vertex_mean(g: ColumnOrName) -> Column:
    """Plain mean of all vertices, closing ones included, as ``struct<lat,lon>``."""
    return _mean(vertices(g))


def first_ring_mean(g: ColumnOrName) -> Column:
    """Mean of the first ring of the first part: where a map marker goes."""
    return _mean(F.get(F.get(col(g), F.lit(0)), F.lit(0)))


def bounding_box(g: ColumnOrName) -> Column:
    def box(points: Column) -> Column:
        xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
        return F.when(
            F.size(points) > 0,
            F.struct(
                F.array_min(xs).alias("xmin"),
                F.array_min(ys).alias("ymin"),
                F.array_max(xs).alias("xmax"),
                F.array_max(ys).alias("ymax"),
            ),
        )

    return _let(vertices(g), box)


def _sides(ring: Column) -> tuple[Column, Column]:
    """A ring's points without the last and without the first: the ends of its sides."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.slice(ring, 1, n), F.slice(ring, 2, n)


def ring_area(ring: Column) -> Column:
    """Unsigned area of a ring in squares of its unit (degrees)."""
    origin = F.get(ring, F.lit(0))
    crosses = F.zip_with(
        *_sides(ring),
        lambda p, q: (p["x"] - origin["x"]) * (q["y"] - origin["y"])
        - (q["x"] - origin["x"]) * (p["y"] - origin["y"]),
    )
    return F.abs(sum_of(crosses)) / 2.0


def area_acres(g: ColumnOrName, subtract_holes: bool = False) -> Column:
    """Flat-earth area; each part is scaled at the mean latitude of its outer vertices.

    Holes count as land unless ``subtract_holes``.
    """
    scale = fixed.METRES_PER_DEGREE * fixed.METRES_PER_DEGREE

    def part_area(part: Column) -> Column:
        outer = F.get(part, F.lit(0))
        degrees = ring_area(outer)
        if subtract_holes:
            holes = F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0)))
            degrees = degrees - sum_of(F.transform(holes, ring_area))
        east = F.cos(F.radians(_mean_of(outer, "y")))
        return F.coalesce(degrees * east * scale, F.lit(0.0))

    return sum_of(F.transform(col(g), part_area)) / F.lit(fixed.SQM_PER_ACRE)


def _moments(ring: Column, sign: Column) -> Column:
    """Doubled area and sixfold first moments of a ring around its own first point."""
    origin = F.get(ring, F.lit(0))

    def side(p: Column, q: Column) -> Column:
        px, py = p["x"] - origin["x"], p["y"] - origin["y"]
        qx, qy = q["x"] - origin["x"], q["y"] - origin["y"]
        return F.struct(
            (px * qy - qx * py).alias("cross"), (px + qx).alias("x"), (py + qy).alias("y")
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    sums = F.aggregate(
        F.zip_with(*_sides(ring), side),
        zero,
        lambda acc, s: F.struct(
            (acc["a"] + s["cross"]).alias("a"),
            (acc["x"] + s["x"] * s["cross"]).alias("x"),
            (acc["y"] + s["y"] * s["cross"]).alias("y"),
        ),
    )
    return F.struct(sums.alias("sums"), origin.alias("origin"), sign.alias("sign"))


def centroid(g: ColumnOrName) -> Column:
    """Area-weighted centroid as ``struct<lat,lon>``; holes weigh negative."""
    rings = F.flatten(
        F.transform(
            col(g),
            lambda part: F.transform(
                part, lambda ring, i: _moments(ring, F.when(i == 0, 1.0).otherwise(-1.0))
            ),
        )
    )

    def weighted(m: Column) -> Column:
        # Holes count negative whichever way their ring turns.
        turn = F.signum(m["sums"]["a"]) * m["sign"]
        area = m["sums"]["a"] / 2.0
        return F.struct(
            (area * turn).alias("a"),
            ((m["sums"]["x"] / 6.0 + m["origin"]["x"] * area) * turn).alias("x"),
            ((m["sums"]["y"] / 6.0 + m["origin"]["y"] * area) * turn).alias("y"),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(
        F.transform(rings, weighted),
        zero,
        lambda acc, r: F.struct(
            (acc["a"] + F.coalesce(r["a"], F.lit(0.0))).alias("a"),
            (acc["x"] + F.coalesce(r["x"], F.lit(0.0))).alias("x"),
            (acc["y"] + F.coalesce(r["y"], F.lit(0.0))).alias("y"),
        ),
        lambda acc: F.when(
            acc["a"] != 0,
            F.struct(
                (acc["y"] / F.nullif(acc["a"], F.lit(0.0))).alias("lat"),
                (acc["x"] / F.nullif(acc["a"], F.lit(0.0))).alias("lon"),
            ),
        ),
    )
    # A geometry without area has no weights; take its vertices.
    return F.coalesce(total, vertex_mean(g))


def part_count(g: ColumnOrName) -> Column:
    """Number of parts; 0 for anything that is not a polygon."""
    return F.coalesce(F.nullif(F.size(col(g)), F.lit(-1)), F.lit(0))


def hole_count(g: ColumnOrName) -> Column:
    holes = F.aggregate(
        F.transform(col(g), lambda part: F.greatest(F.size(part) - 1, F.lit(0))),
        F.lit(0),
        lambda acc, n: acc + n,
    )
    return F.coalesce(holes, F.lit(0))


def _vertex_distances(g: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName) -> Column:
    lat, lon = col(lat), col(lon)
    east = F.cos(F.radians(lat)) * fixed.METRES_PER_DEGREE
    return F.transform(
        vertices(g),
        lambda p: F.hypot((p["x"] - lon) * east, (p["y"] - lat) * fixed.METRES_PER_DEGREE),
    )


def farthest_vertex_m(g: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Metres from a point to the farthest vertex; 0 for an empty geometry."""
    return F.coalesce(F.array_max(_vertex_distances(g, lat, lon)), F.lit(0.0))


def nearest_vertex_m(g: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Metres from a point to the nearest vertex; infinite for an empty geometry."""
    return F.coalesce(F.array_min(_vertex_distances(g, lat, lon)), F.lit(float("inf")))


# --- point in polygon ----------------------------------------------------------------


def _segment_gap(p: Column, q: Column, x: Column, y: Column) -> Column:
    """Distance in coordinate units from (x, y) to the side p-q."""
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    length2 = dx * dx + dy * dy
    along = ((x - p["x"]) * dx + (y - p["y"]) * dy) / F.nullif(length2, F.lit(0.0))
    t = F.least(F.greatest(F.coalesce(along, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - (p["x"] + t * dx), y - (p["y"] + t * dy))


def nearest_side(
    g: ColumnOrName, lon: ColumnOrName, lat: ColumnOrName, east: Column, north: Column
) -> Column:
    """Distance from a point to the nearest side, degrees scaled by ``east`` and ``north``."""
    x, y = col(lon), col(lat)

    def scaled(p: Column) -> Column:
        return F.struct(((p["x"] - x) * east).alias("x"), ((p["y"] - y) * north).alias("y"))

    zero = F.lit(0.0)
    return F.array_min(
        F.flatten(
            F.transform(
                F.flatten(col(g)),
                lambda ring: F.zip_with(
                    F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
                    F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))),
                    lambda p, q: _segment_gap(scaled(p), scaled(q), zero, zero),
                ),
            )
        )
    )


def contains_point(
    g: ColumnOrName, lon: ColumnOrName, lat: ColumnOrName, tol_deg: float = 0.0
) -> Column:
    """Strict containment (the boundary is outside), or within ``tol_deg`` of the polygon."""
    x, y = col(lon), col(lat)
    rings = F.flatten(col(g))
    on_side = 1 << 20  # more than any polygon has crossings

    def crossing(p: Column, q: Column) -> Column:
        turn = (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])
        between = x.between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & y.between(
            F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"])
        )
        straddles = (p["y"] > y) != (q["y"] > y)
        return (
            F.when((turn == 0) & between, on_side)
            .when(straddles & ((q["y"] > p["y"]) == (turn > 0)), 1)
            .otherwise(0)
        )

    def crossings(ring: Column) -> Column:
        return F.aggregate(F.zip_with(*_sides(ring), crossing), F.lit(0), lambda acc, n: acc + n)

    def nearest(ring: Column) -> Column:
        return F.array_min(F.zip_with(*_sides(ring), lambda p, q: _segment_gap(p, q, x, y)))

    count = F.aggregate(F.transform(rings, crossings), F.lit(0), lambda acc, n: acc + n)
    inside = _let(count, lambda n: (n < on_side) & (n % 2 == 1))
    if tol_deg > 0:
        gap = F.array_min(F.transform(rings, nearest))
        inside = F.coalesce(inside, F.lit(False)) | (gap < F.lit(tol_deg))
    return F.coalesce(inside, F.lit(False))
