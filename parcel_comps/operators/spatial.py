"""Spatial operators: parcel resolution, comparable neighbours, radius search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed
from parcel_comps.functions import scalars as S
from parcel_comps.functions.addresses import normalize_address, street_of
from parcel_comps.functions.distance import (
    boundary_distance_m,
    boundary_distances,
    point_distance_m,
)
from parcel_comps.functions.geodesy import FLAT_EXCESS, area_acres_wgs84
from parcel_comps.functions.geometry import (
    area_acres,
    bounding_box,
    centroid,
    contains_point,
    farthest_vertex_m,
    first_ring_mean,
    hole_count,
    part_count,
)
from parcel_comps.operators import grid
from parcel_comps.operators.linkage import unique_index
from parcel_comps.operators.skew import skew_join
from parcel_comps.operators.tiles import ParcelTiles
from parcel_comps.plans.checkpoints import materialize
from parcel_comps.profiles import Profile, get_profile

# A point meets only the parcels of its own cell, so cells about the size of a large
# lot keep the number of tested pairs low.
_POINT_CELL_DEG = 0.002

# Twice the default: a search of 250 m covers two or three such cells, and its polygon is repeated in each.
_PAIR_CELL_DEG = 2 * grid.CELL_DEG

# Polygons of up to this many vertices go through the box join with their rows; larger ones join the pairs that are left.
LIGHT_VERTICES = 256

# A frame of parcels, or a stored table of which only tiles in use are read.
Parcels = DataFrame | ParcelTiles


def shape_key(geometry: str) -> Column:
    """128 bits of a polygon's content: parcels with one polygon share it."""
    halves = [F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(geometry), F.xxhash64(F.lit(1), geometry))]
    return F.when(F.col(geometry).isNotNull(), F.concat(*halves))


# Measures of a parcel that the spatial operators use, for both rule sets.
INDEX_COLUMNS = {
    "box": lambda g: bounding_box(g),
    "center": lambda g: centroid(g),
    "gross_acres": lambda g: area_acres(g),
    "net_acres": lambda g: area_acres(g, subtract_holes=True),
    "gross_acres_wgs84": lambda g: area_acres_wgs84(g),
    "net_acres_wgs84": lambda g: area_acres_wgs84(g, subtract_holes=True),
    "parts": lambda g: part_count(g),
    "holes": lambda g: hole_count(g),
    "marker": lambda g: first_ring_mean(g),
    "shape_id": lambda g: shape_key(g),
    "street_ascii": lambda g: street_of(normalize_address("address")),
    "street_unicode": lambda g: street_of(normalize_address("address", True), True),
}


def index_parcels(parcels: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Add ``INDEX_COLUMNS``: what the spatial operators need to know of each parcel.

    Store the result. Later jobs then read a few numbers instead of walking polygons;
    on a frame without them the operators compute the ones they use.
    """
    return parcels.select(
        *[c for c in parcels.columns if c not in INDEX_COLUMNS],
        *[measure(geometry).alias(name) for name, measure in INDEX_COLUMNS.items()],
    )


def attributes_of(parcels: Parcels) -> DataFrame:
    """Indexed parcels without their polygons."""
    if isinstance(parcels, ParcelTiles):
        return parcels.attributes
    if not set(INDEX_COLUMNS) <= set(parcels.columns):
        parcels = index_parcels(parcels)
    return parcels.drop("geometry")


def shapes_of(parcels: Parcels) -> DataFrame:
    """``shape_id`` and ``geometry``, each polygon once."""
    if isinstance(parcels, ParcelTiles):
        return parcels.shapes.select("shape_id", "geometry")
    if "shape_id" not in parcels.columns:
        parcels = parcels.withColumn("shape_id", shape_key("geometry"))
    return parcels.where("shape_id is not null").select("shape_id", "geometry").dropDuplicates(["shape_id"])


def with_shape(df: DataFrame, shapes: DataFrame, key: str, name: str, how: str = "inner") -> DataFrame:
    """``df`` with the polygon of the shape ``key`` as ``name``: polygons move only to rows that are left."""
    return df.join(shapes.select(F.col("shape_id").alias(key), F.col("geometry").alias(name)), key, how)


def _vertices(geometry: str) -> Column:
    return F.aggregate(F.flatten(geometry), F.lit(0), lambda n, ring: n + F.size(ring))


def _shaped_pairs(targets: DataFrame, neighbours: DataFrame, parcels: Parcels, keep: Column) -> DataFrame:
    """Pairs by boxes with both polygons, ``t_geometry`` and ``geometry``.

    There are many times more pairs than parcels, so a small polygon goes to its cells with its row, and no pair is shuffled
    for it. A large one would be repeated in every cell; its pairs are found without it, and it joins them afterwards.
    """
    shapes = shapes_of(parcels)

    def paired(left: DataFrame, right: DataFrame) -> DataFrame:
        return grid.box_join(left, right, "_search", "box", "target_id", "property_id", condition=keep, cell_deg=_PAIR_CELL_DEG)

    every = parcels.shapes if isinstance(parcels, ParcelTiles) else parcels
    if "shape_id" not in every.columns:
        every = shapes
    heavy = every.where(_vertices("geometry") > LIGHT_VERTICES).select("shape_id")
    some_heavy = not heavy.isEmpty()
    if not some_heavy:
        return paired(with_shape(targets, shapes, "t_shape", "t_geometry"), with_shape(neighbours, shapes, "shape_id", "geometry"))
    heavy = materialize(heavy.distinct())
    t_heavy = heavy.withColumnRenamed("shape_id", "t_shape")
    light = shapes.join(heavy, "shape_id", "left_anti")
    last = paired(targets.join(t_heavy, "t_shape", "left_semi"), neighbours).unionByName(
        paired(targets.join(t_heavy, "t_shape", "left_anti"), neighbours.join(heavy, "shape_id", "left_semi"))
    )
    last = with_shape(with_shape(last, shapes, "t_shape", "t_geometry"), shapes, "shape_id", "geometry")
    return paired(with_shape(targets, light, "t_shape", "t_geometry"), with_shape(neighbours, light, "shape_id", "geometry")).unionByName(last)


def _near(parcels: Parcels, search: DataFrame, box: str) -> Parcels:
    return parcels.near(search, box) if isinstance(parcels, ParcelTiles) else parcels


def _indexed(parcels: Parcels, profile: Profile) -> DataFrame:
    """Indexed parcels with the profile's ``computed_acres`` and ``street``."""
    kind, on = "net" if profile.net_of_holes else "gross", "_wgs84" if profile.earth == "wgs84" else ""
    return attributes_of(parcels).withColumns(
        {
            "computed_acres": F.col(f"{kind}_acres{on}"),
            "street": F.col("street_unicode" if profile.unicode_words else "street_ascii"),
        }
    )


def eligible_listings(listings: DataFrame) -> DataFrame:
    return listings.where(F.col("property_type").isin(fixed.LISTING_TYPES))


def _with_point_box(points: DataFrame, profile: Profile) -> DataFrame:
    # The tolerance is in plain degrees on both axes, so a box of it is exact.
    tol = F.lit(profile.contain_tol_deg * (1 + 1e-9))
    lon, lat = F.col("_lon"), F.col("_lat")
    return points.withColumn("_point_box", grid.box(lon - tol, lat - tol, lon + tol, lat + tol))


def _points_in_boxes(
    points: DataFrame, key: str | list[str], parcels: Parcels, profile: Profile
) -> tuple[DataFrame, DataFrame]:
    """Pairs of points (``_lon``, ``_lat``) and parcels whose box has them, and the shapes to test them with."""
    points = _with_point_box(points, profile)
    parcels = _near(parcels, points, "_point_box")
    boxes = (
        _indexed(parcels, profile)
        .where("box is not null")
        .select("property_id", "shape_id", "box", "computed_acres")
    )
    pairs = grid.box_join(
        points, boxes, "_point_box", "box", key, "property_id",
        cell_deg=_POINT_CELL_DEG, left_is_small=True,
    )
    return pairs, shapes_of(parcels)


def _contained(pairs: DataFrame, shapes: DataFrame, profile: Profile) -> DataFrame:
    placed = with_shape(pairs, shapes, "shape_id", "geometry")
    return placed.where(contains_point("geometry", "_lon", "_lat", profile.contain_tol_deg))


def _search_tasks(df: DataFrame) -> int:
    """Tasks for a spatial search over few, small rows.

    Each row means much work but few bytes. Without a fixed number AQE would merge the
    rows into a handful of tasks and leave the whole search to them.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _points(listings: DataFrame, *columns: str) -> DataFrame:
    return listings.where("longitude is not null and latitude is not null").select(
        *columns, F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat")
    )


def point_boxes(listings: DataFrame, profile: Profile, *columns: str) -> DataFrame:
    """``columns`` and ``_point_box``: the listing's point, as wide as the profile's tolerance."""
    return _with_point_box(_points(listings, *columns), profile).drop("_lon", "_lat")


def containing_parcels(
    listings: DataFrame, parcels: Parcels, profile: str | Profile = "service"
) -> DataFrame:
    """Every (``listing_id``, ``property_id``) whose parcel contains the listing's point."""
    points = _points(listings, "listing_id")
    pairs, shapes = _points_in_boxes(points, "listing_id", parcels, get_profile(profile))
    found = _contained(pairs, shapes, get_profile(profile))
    return found.select("listing_id", "property_id", "computed_acres")


def resolve_parcel(
    listings: DataFrame, parcels: Parcels, profile: str | Profile = "service"
) -> DataFrame:
    """Each listing with its own parcel: ``target_id`` and ``resolve_method``.

    The smallest parcel containing the point is taken, and rejected if its size does
    not fit the listing's lot size. Listings of one place share one search, and move once, to their place's parcel.
    ``resolve_method`` is point_in_polygon, address, unresolved_suspect_parcel (a parcel was rejected) or unresolved.
    """
    p = get_profile(profile)
    if p.eligible_listings_only:
        listings = eligible_listings(listings)
    keys = place_columns(p)
    places = materialize(count_places(listings, keys))
    found = skew_join(listings, resolve_places(places.drop("_n"), parcels, p), keys, ["listing_id"], null_safe=True, counts=places)
    return found.select(*listings.columns, "target_id", "resolve_method")


def place_columns(profile: Profile) -> list[str]:
    """What decides a listing's parcel."""
    return ["longitude", "latitude", "lot_size", *(["address_line_1"] if profile.address_fallback else [])]


def count_places(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Each place once, with the number ``_n`` of its listings."""
    return listings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def resolve_places(listings: DataFrame, parcels: Parcels, p: Profile) -> DataFrame:
    """Add ``target_id`` and ``resolve_method`` to rows with ``place_columns``. Rows at one point share one search."""
    spread = place_columns(p)
    spot = ["_lon", "_lat"]
    spots = _points(listings).distinct().repartition(_search_tasks(listings), *spot)
    pairs, shapes = _points_in_boxes(spots, spot, parcels, p)
    # Parcels with one polygon (condos) are one candidate, and one test.
    best = F.min(F.struct("computed_acres", "property_id")).alias("_best")
    candidates = pairs.groupBy(*spot, "shape_id").agg(best)
    smallest = _contained(candidates, shapes, p).groupBy(*spot).agg(F.min("_best").alias("_best"))
    fits = S.plausible_size(F.col("_best.computed_acres"), "lot_size", p.zero_lot_is_missing)
    placed = listings.withColumns({"_lon": F.col("longitude"), "_lat": F.col("latitude")})
    found = skew_join(placed, smallest, spot, spread).withColumn(
        "target_id", F.when(fits, F.col("_best.property_id"))
    )
    method = F.when(F.col("target_id").isNotNull(), "point_in_polygon").when(
        F.col("_best").isNotNull(), "unresolved_suspect_parcel"
    )
    found = found.withColumn("resolve_method", F.coalesce(method, F.lit("unresolved")))
    if p.address_fallback:
        index = unique_index(
            attributes_of(parcels).select(F.col("property_id").alias("_by_address"), "address"),
            normalize_address("address", p.unicode_words),
            "_address",
        ).select("_address", "_by_address")
        line = S.empty_to_null(normalize_address("address_line_1", p.unicode_words))
        found = found.withColumn("_address", F.when(F.col("target_id").isNull(), line))
        every_line = listings.select(line.alias("_address"))
        found = skew_join(found, index, ["_address"], spread, count_on=every_line)
        found = found.withColumn(
            "resolve_method",
            F.when(F.col("_by_address").isNotNull(), "address").otherwise(F.col("resolve_method")),
        ).withColumn("target_id", F.coalesce("target_id", "_by_address"))
    return found.select(*listings.columns, "target_id", "resolve_method")


def unresolved_listings(resolved: DataFrame) -> DataFrame:
    return resolved.where("target_id is null")


def _acres(profile: Profile, side: str) -> Column:
    """Lot size used for comparisons: stored, with the target's own measured if missing."""
    if profile.acres_source == "computed":
        return F.col("computed_acres")
    if side == "target":
        return F.coalesce("acreage", "computed_acres")
    return F.col("acreage")


def target_parcels(
    resolved: DataFrame, parcels: Parcels, profile: str | Profile = "service"
) -> DataFrame:
    """The distinct parcels that listings resolved to, ready for ``find_comps``.

    Many listings share a parcel; its comps are searched once. In the batch rules
    Land listings have their own comps, so the key is (``target_id``, ``is_land``). Places with ``is_land`` may be given too.
    """
    p = get_profile(profile)
    land = F.col("property_type") == "Land" if p.skip_size_for_land else F.lit(False)
    if "is_land" in resolved.columns:
        land = F.col("is_land")
    wanted = (
        resolved.where("target_id is not null")
        .select("target_id", F.coalesce(land, F.lit(False)).alias("is_land"))
        .distinct()
        .repartition(_search_tasks(resolved), "target_id")
    )
    if isinstance(parcels, ParcelTiles) and not p.address_fallback:
        # Without a match by address every target holds its listing's point.
        parcels = _near(parcels, _with_point_box(_points(resolved.where("target_id is not null")), p), "_point_box")
    measured = _indexed(parcels, p).select(
        F.col("property_id").alias("target_id"),
        F.col("shape_id").alias("t_shape"),
        F.col("box").alias("t_box"),
        F.col("center").alias("t_center"),
        F.col("street").alias("t_street"),
        _acres(p, "target").alias("t_acres"),
        F.col("assessed_value").alias("t_assessed_value"),
    )
    return wanted.join(measured, "target_id")


def candidate_pairs(
    targets: DataFrame,
    parcels: Parcels,
    profile: str | Profile = "service",
    far_m: float = fixed.FAR_RADIUS_M,
    close_m: float = fixed.CLOSE_RADIUS_M,
    tol: float = fixed.SIZE_RATIO,
    keep_rejected: bool = False,
) -> DataFrame:
    """(target, neighbour) pairs within reach, with exact distance and shape measures.

    Unless ``keep_rejected``, everything that needs no exact distance is tested
    first: rows that cannot become comps are dropped before the join, and pairs that
    cannot satisfy any rule never reach the polygon distance.
    """
    p = get_profile(profile)
    touch_m = p.touch_tol if p.touch_unit == "metres" else p.touch_tol * fixed.METRES_PER_DEGREE
    # Boxes are compared on the flat earth, which may show a little more than the ellipsoid's metres.
    excess = FLAT_EXCESS if p.earth == "wgs84" else 1.0
    reach = max(far_m, touch_m) * excess
    center = F.col("t_center")
    search = grid.widen(F.col("t_box"), reach, center["lat"])
    if p.shape_screen and not keep_rejected:
        # Nothing with a vertex beyond this distance of the centroid can pass.
        near = grid.widen(
            grid.point_box(center["lon"], center["lat"]), fixed.MAX_VERTEX_M, center["lat"]
        )
        search = grid.box(
            F.greatest(search["xmin"], near["xmin"]), F.greatest(search["ymin"], near["ymin"]),
            F.least(search["xmax"], near["xmax"]), F.least(search["ymax"], near["ymax"]),
        )
    targets = targets.withColumn("_search", search).withColumn(
        "_east", grid.metres_east(center["lat"])
    )
    # The own polygons of the targets lie near them too.
    parcels = _near(parcels, targets.select(F.explode(F.array("_search", "t_box")).alias("_box")), "_box")
    neighbours = _indexed(parcels, p).where("box is not null").select(
        "property_id", "address", "city", "property_type", "assessed_value", "latitude",
        "longitude", "shape_id", "marker", "box", "street", "parts", "holes", "computed_acres",
        F.col("center").alias("n_center"),
        _acres(p, "neighbour").alias("acres"),
    )
    similar = S.lot_size_similar("t_acres", "acres", tol)
    if not keep_rejected:
        neighbours = neighbours.where(_reject_neighbour(p).isNull())
        # Sizes are similar only where both are known.
        sized = F.col("t_acres") > 0
        if p.skip_size_for_land:
            sized = sized | F.col("is_land")
        else:
            neighbours = neighbours.where(F.col("acres") > 0)
        targets = targets.where(sized)
    if p.skip_size_for_land:
        # A parcel of land and other listings is searched and measured once.
        same = [c for c in targets.columns if c not in ("target_id", "is_land")]
        targets = targets.groupBy("target_id").agg(*[F.first(c).alias(c) for c in same], F.collect_set(F.coalesce("is_land", F.lit(False))).alias("_lands"))
    gap = grid.box_gap_m(F.col("t_box"), F.col("box"), F.col("_east"))
    keep = (F.col("target_id") != F.col("property_id")) & (gap <= reach)
    same_street = (F.col("street") != "") & (F.col("street") == F.col("t_street"))
    if not keep_rejected:
        fits = similar | F.array_contains("_lands", True) if p.skip_size_for_land else similar
        keep = keep & fits & (same_street | (gap <= max(close_m, touch_m) * excess))
    pairs = _shaped_pairs(targets, neighbours, parcels, keep)
    if p.shape_screen:
        # Corners of the box bound the farthest vertex; most pairs need no vertex walk.
        dx = F.greatest(
            F.abs(F.col("box.xmin") - center["lon"]), F.abs(F.col("box.xmax") - center["lon"])
        ) * F.col("_east")
        dy = F.greatest(
            F.abs(F.col("box.ymin") - center["lat"]), F.abs(F.col("box.ymax") - center["lat"])
        ) * fixed.METRES_PER_DEGREE
        far = F.when(
            F.sqrt(dx * dx + dy * dy) > fixed.MAX_VERTEX_M,
            farthest_vertex_m("geometry", center["lat"], center["lon"]) > fixed.MAX_VERTEX_M,
        ).otherwise(F.lit(False))
        pairs = pairs.withColumn("too_far", far)
        if not keep_rejected:
            pairs = pairs.where(~F.col("too_far"))
    else:
        pairs = pairs.withColumn("too_far", F.lit(False))
    if p.touch_unit == "metres":
        pairs = pairs.withColumn(
            "distance_m", boundary_distance_m("t_geometry", "geometry", center["lat"], p.earth)
        )
        touch = F.col("distance_m") <= p.touch_tol
    else:
        # Boxes further apart than the tolerance need no measurement in degrees.
        close = grid.box_gap_deg(F.col("t_box"), F.col("box")) <= p.touch_tol
        pairs = pairs.withColumn(
            "_d", boundary_distances("t_geometry", "geometry", center["lat"], close, p.earth)
        ).withColumn("distance_m", F.col("_d.metres"))
        touch = F.coalesce(F.col("_d.degrees") <= p.touch_tol, F.lit(False))
    pairs = pairs.withColumn("touches", touch).where((F.col("distance_m") <= far_m) | F.col("touches"))
    if p.skip_size_for_land:
        pairs = pairs.withColumn("is_land", F.explode("_lands")).drop("_lands")
        if not keep_rejected:
            pairs = pairs.where(similar | F.col("is_land"))
    return (
        pairs.drop("_search", "_east", "_d", "t_geometry", "geometry", "t_shape", "t_box", "t_center", "box", "computed_acres")
    )


def _reject_neighbour(profile: Profile) -> Column:
    """Why a neighbour can never be a comp, whatever the target; NULL if it may be."""
    raw = F.col("property_type")
    kind = raw if profile.exact_types else S.parse_known_type(raw)
    bad_type = raw.isNotNull() & ~F.coalesce(kind.isin(fixed.COMP_ELIGIBLE_TYPES), F.lit(False))
    shape = F.lit(False)
    if profile.shape_screen:
        shape = F.coalesce(
            (F.col("parts") == 0)
            | (F.col("parts") > fixed.MAX_PARTS)
            | (F.col("holes") > fixed.MAX_HOLES),
            F.lit(False),
        )
    return (
        F.when(shape, "shape").when(S.is_blank("address"), "blank_address").when(bad_type, "type")
    )


def classify_comps(
    pairs: DataFrame,
    profile: str | Profile = "service",
    close_m: float = fixed.CLOSE_RADIUS_M,
    far_m: float = fixed.FAR_RADIUS_M,
    tol: float = fixed.SIZE_RATIO,
) -> DataFrame:
    """Add ``found_via``, ``reject_reason`` and ``comp_eligible`` to measured pairs.

    Reasons to keep are geometric, near_similar_size and near_same_street; reasons to
    reject, in the order tested, shape, no_reason, blank_address, size and type. A
    neighbour without a type stays, with ``comp_eligible`` NULL for unverified.
    """
    p = get_profile(profile)
    raw = F.col("property_type")
    kind = raw if p.exact_types else S.parse_known_type(raw)
    similar = S.lot_size_similar("t_acres", "acres", tol)
    near_size = (F.col("distance_m") <= close_m) & similar
    same_street = (
        (F.col("distance_m") <= far_m)
        & (F.coalesce("t_street", F.lit("")) != "")
        & F.coalesce(F.col("street") == F.col("t_street"), F.lit(False))
    )
    if p.exclusive_reasons:
        same_street = same_street & ~near_size
    found_via = F.array_compact(
        F.array(
            F.when(F.col("touches"), "geometric"),
            F.when(near_size, "near_similar_size"),
            F.when(same_street, "near_same_street"),
        )
    )
    size_ok = similar | F.col("is_land") if p.skip_size_for_land else similar
    never = _reject_neighbour(p)
    reject = (
        F.when((never == "shape") | F.col("too_far"), "shape")
        .when(F.size(found_via) == 0, "no_reason")
        .when(S.is_blank("address"), "blank_address")
        .when(~size_ok, "size")
        .when(never == "type", "type")
    )
    return (
        pairs.withColumn("found_via", found_via)
        .withColumn("reject_reason", reject)
        .withColumn(
            "comp_eligible",
            F.when(
                raw.isNotNull(), F.coalesce(kind.isin(fixed.COMP_ELIGIBLE_TYPES), F.lit(False))
            ),
        )
        .withColumn("raw_type", raw)
        .withColumn("property_type", kind)
    )


def find_comps(
    targets: DataFrame,
    parcels: Parcels,
    profile: str | Profile = "service",
    close_m: float = fixed.CLOSE_RADIUS_M,
    far_m: float = fixed.FAR_RADIUS_M,
    tol: float = fixed.SIZE_RATIO,
    keep_rejected: bool = False,
) -> DataFrame:
    """Comparable neighbours of each target parcel (see ``target_parcels``).

    With ``keep_rejected`` every neighbour in reach comes back with its
    ``reject_reason``; otherwise only comps do.
    """
    pairs = candidate_pairs(targets, parcels, profile, far_m, close_m, tol, keep_rejected)
    comps = classify_comps(pairs, profile, close_m, far_m, tol)
    if not keep_rejected:
        comps = comps.where("reject_reason is null").drop("reject_reason")
    return comps.drop("street", "t_street", "parts", "holes", "too_far")


def nearby(
    parcels: Parcels,
    points: DataFrame,
    radius_m: float | None = None,
    types: list[str] | None = None,
    max_radius_m: float = fixed.MAX_NEARBY_M,
    earth: str = "flat",
) -> DataFrame:
    """Parcels within a radius of each point (``query_id``, ``lat``, ``lon``), nearest first.

    No or a non-positive radius means 300 m; more than ``max_radius_m`` is clamped, and
    ``radius_used_m`` says what was searched. All points are one job. Rows come ordered
    within a query, which stays in one task; there is no order across queries.
    """
    radius = radius_m if radius_m is not None and radius_m > 0 else fixed.DEFAULT_NEARBY_M
    radius = min(float(radius), max_radius_m)
    lat, lon = F.col("lat"), F.col("lon")
    reach = radius * FLAT_EXCESS if earth == "wgs84" else radius
    search = points.where("lat is not null and lon is not null").withColumn(
        "_search", grid.widen(grid.point_box(lon, lat), reach, lat)
    ).withColumn("_east", grid.metres_east(lat)).withColumn("_point", grid.point_box(lon, lat))
    parcels = _near(parcels, search, "_search")
    indexed = attributes_of(parcels)
    if types:
        indexed = indexed.where(F.col("property_type").isin(types))
    within = grid.box_gap_m(F.col("_point"), F.col("box"), F.col("_east")) <= reach
    pairs = grid.box_join(
        search,
        indexed.where("box is not null"),
        "_search",
        "box",
        "query_id",
        "property_id",
        condition=within,
        cell_deg=max(grid.CELL_DEG, 2 * reach / fixed.METRES_PER_DEGREE),
    )
    return (
        with_shape(pairs, shapes_of(parcels), "shape_id", "geometry")
        .withColumn("distance_meters", point_distance_m("geometry", "lat", "lon", earth))
        .where(F.col("distance_meters") <= radius)
        .drop("_search", "_east", "_point")
        .withColumn("radius_used_m", F.lit(radius))
        .repartition("query_id")
        .sortWithinPartitions("query_id", "distance_meters")
    )


def endpoint_nearby(
    parcels: Parcels,
    points: DataFrame,
    radius_m: float | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    """``nearby`` with the public limits: 1,000 m, and homes and vacant land by default."""
    return nearby(
        parcels, points, radius_m, types or fixed.COMP_ELIGIBLE_TYPES, fixed.ENDPOINT_MAX_NEARBY_M
    )
