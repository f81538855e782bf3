"""Bounding-box join: all pairs of rows whose boxes overlap, as an equi-join on grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_comps import fixed_values as fixed

# About 500 m: a parcel covers one to four cells, a search radius of 250 m few more.
CELL_DEG = 0.005
# A box over more cells than this moves to a grid 64 times coarser (32 km), and from
# there to one 64 times coarser again, so no row is ever repeated more often.
MAX_CELLS = 4096
_COARSER = 64
_TOP = 2
# Rows of one cell, per side, that a single task joins before the cell is split.
BLOCK_ROWS = 20_000
# A cell is split only above this share of all rows, so the broadcast list of crowded
# cells never has more than 200,000 entries, and no cell above it stays whole.
HOT_SHARE = 100_000
# Cells exist for valid degrees only; what lies beyond counts for the cells at the edge.
_MAX_DEG = 180.0
# Towards the poles cells get wider by powers of two, up to this one.
_WIDEST = 12
# How a pair meets in a cell: both rows on their own level, or one of them on a level coarser than its own. Two rows that
# are both on a coarser level than their own have met, or missed each other, on a finer one.
_BOTH_OWN, _LEFT_OWN, _RIGHT_OWN = 0, 1, 2


def _cell_index(value: Column, size: Column) -> Column:
    inside = F.greatest(F.least(value, F.lit(_MAX_DEG)), F.lit(-_MAX_DEG))
    return F.floor(inside / size).cast("bigint")


def _width(size: Column, iy: Column) -> Column:
    """Degrees across a cell of row ``iy``. Cells widen towards the poles as degrees shrink, so a search covers equally many anywhere."""
    from_pole = F.greatest(F.abs(F.lit(90.0) - F.abs((iy + F.lit(0.5)) * size)), F.lit(0.01))
    doubled = F.floor(F.log2(F.lit(math.degrees(1.0)) / from_pole))
    return size * F.pow(F.lit(2.0), F.greatest(F.least(doubled, F.lit(_WIDEST)), F.lit(0)))


def _size(level: Column, cell_deg: float) -> Column:
    return F.element_at(
        F.array(*[F.lit(cell_deg * _COARSER**n) for n in range(_TOP + 1)]), level + 1
    )


def _cell_key(way: Column, level: Column, ix: Column, iy: Column) -> Column:
    """One long per cell and way to meet: 2 bits each for way and level, and 28 bits per axis."""
    half = 1 << 27
    top = F.shiftleft(way.cast("bigint"), 2) + level
    return F.shiftleft(F.shiftleft(top, 28) + ix + half, 28) + iy + half


def _own_level(box: Column, cell_deg: float, max_cells: int) -> Column:
    def cells(level: int) -> Column:
        size = F.lit(cell_deg * _COARSER**level)
        low, high = _cell_index(box["ymin"], size), _cell_index(box["ymax"], size)
        # The narrowest cells are at one end, or at the equator.
        width = F.when((low < 0) & (high >= 0), size).otherwise(F.least(_width(size, low), _width(size, high)))
        across = _cell_index(box["xmax"], width) - _cell_index(box["xmin"], width) + 1
        return across * (high - low + 1)

    return F.when(cells(0) <= max_cells, 0).when(cells(1) <= max_cells, 1).otherwise(_TOP)


def _levelled(df: DataFrame, box: str, side: str, cell_deg: float, max_cells: int) -> DataFrame:
    b = F.col(box)
    return df.where(b["xmin"].isNotNull()).withColumn(
        f"_{side}own", _own_level(b, cell_deg, max_cells)
    )


def _to_cells(
    df: DataFrame, other: DataFrame | None, box: str, side: str, oside: str, cell_deg: float
) -> DataFrame:
    """One row per covered cell, on the row's own level and the coarser ones in use there.

    ``other`` is None where the other side is known to use only the finest level.
    """
    b, own = F.col(box), F.col(f"_{side}own")
    mine, theirs = (_LEFT_OWN, _RIGHT_OWN) if side == "l" else (_RIGHT_OWN, _LEFT_OWN)

    def meeting(way: int, level: Column) -> Column:
        return F.struct(F.lit(way).alias("way"), level.alias("level"))

    # Finer rows of the other side come up to this row's level.
    ways = F.when(own == 0, F.array(meeting(_BOTH_OWN, own))).otherwise(F.array(meeting(_BOTH_OWN, own), meeting(mine, own)))
    if other is not None:
        coarsest = F.coalesce(other.agg(F.max(f"_{oside}own")).scalar(), F.lit(0))
        coarser = F.array(*[meeting(theirs, F.lit(n)) for n in range(1, _TOP + 1)])
        ways = F.concat(ways, F.slice(coarser, own + 1, F.greatest(coarsest - own, F.lit(0))))
    df = df.withColumn("_at", F.explode(ways))
    df = df.withColumns({"_way": F.col("_at.way"), "_level": F.col("_at.level")}).withColumn("_size", _size(F.col("_level"), cell_deg))
    size = F.col("_size")
    ys = F.sequence(_cell_index(b["ymin"], size), _cell_index(b["ymax"], size))

    def row(y: Column) -> Column:
        width = _width(size, y)
        xs = F.sequence(_cell_index(b["xmin"], width), _cell_index(b["xmax"], width))
        return F.transform(xs, lambda x: _cell_key(F.col("_way"), F.col("_level"), x, y))

    return df.withColumn("_cell", F.explode(F.flatten(F.transform(ys, row)))).drop("_at")


def _only_met(df: DataFrame, other: DataFrame, other_box: str, oside: str, cell_deg: float) -> DataFrame:
    """``df`` without those copies on a coarser level that meet no row there.

    The broadcast list of the other side's coarse cells has at most one entry for each such cell of the earth.
    """
    way = _LEFT_OWN if oside == "l" else _RIGHT_OWN
    large = other.where(F.col(f"_{oside}own") > 0).select(other_box, f"_{oside}own")
    met = _to_cells(large, None, other_box, oside, "", cell_deg).where(F.col("_way") == way)
    met = F.broadcast(met.select(F.col("_cell").alias("_met"), F.lit(True).alias("_is_met")).distinct())
    # Rows on their own level have no key here and stay.
    joined = df.join(met, F.when(F.col("_way") == way, F.col("_cell")) == F.col("_met"), "left")
    return joined.where((F.col("_way") != way) | F.col("_is_met")).drop("_met", "_is_met")


def _hot_cells(left: DataFrame, right: DataFrame, block_rows: int) -> DataFrame:
    """Cells to split, with the number of blocks per side."""
    sides = left.select("_cell", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select("_cell", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = sides.groupBy("_cell").agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    share = F.coalesce(sides.agg(F.count(F.lit(1))).scalar(), F.lit(0)) / HOT_SHARE
    most = F.greatest(F.lit(float(block_rows)), share)
    crowded = (F.col("_nl") > most) | (F.col("_nr") > most)
    blocks = [
        F.greatest(F.ceil(F.col(n) / most), F.lit(1)).cast("int").alias(name)
        for n, name in (("_nl", "_lblocks"), ("_nr", "_rblocks"))
    ]
    both = (F.col("_nl") > 0) & (F.col("_nr") > 0)
    return F.broadcast(counts.where(crowded & both).select("_cell", *blocks))


def _blocked(
    df: DataFrame, hot: DataFrame, key: str | list[str], mine: str, other: str
) -> DataFrame:
    """Give each row of a crowded cell one block of its own side and repeat it per other block."""
    keys = [key] if isinstance(key, str) else key
    own = F.pmod(F.xxhash64(*keys), F.coalesce(mine, F.lit(1))).cast("int")
    across = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
    return (
        df.join(hot, "_cell", "left")
        .withColumn(f"{mine}_i", own)
        .withColumn(f"{other}_i", across)
        .drop("_lblocks", "_rblocks")
    )


def box_join(
    left: DataFrame,
    right: DataFrame,
    left_box: str,
    right_box: str,
    left_key: str | list[str],
    right_key: str | list[str],
    condition: Column | None = None,
    cell_deg: float = CELL_DEG,
    max_cells: int = MAX_CELLS,
    block_rows: int | None = BLOCK_ROWS,
    left_is_small: bool = False,
) -> DataFrame:
    """Inner join of all pairs with overlapping boxes that also meet ``condition``.

    Column names of the two sides must differ. Both sides are expanded to the grid
    cells their boxes cover and meet by equality of the cell; a pair that shares
    several cells is kept only in the cell of its overlap's lower-left corner, so no
    ``distinct`` is needed. Boxes spanning very many cells live on a coarser grid.
    Cells crowded on either side are split into blocks (``left_key`` and
    ``right_key`` decide a row's block), so the pairs of one cell spread over tasks;
    ``block_rows=None`` leaves the split out. A coordinate beyond valid degrees is placed in
    the cells at the edge: it cannot multiply a row, and its pairs are still found. ``left_is_small`` promises that no left
    box covers more than ``max_cells`` cells, as with points and fixed search radii,
    and saves a pass over the left side.
    """
    left = _levelled(left, left_box, "l", cell_deg, max_cells)
    right = _levelled(right, right_box, "r", cell_deg, max_cells)
    left_cells = _to_cells(left, right, left_box, "l", "r", cell_deg).drop("_lown")
    finer = None if left_is_small else left
    right_cells = _to_cells(right, finer, right_box, "r", "l", cell_deg).drop("_rown", "_level", "_size")
    hot = None if block_rows is None else _hot_cells(left_cells, right_cells, block_rows)
    left_cells = _only_met(left_cells, right, right_box, "r", cell_deg)
    if finer is not None:
        right_cells = _only_met(right_cells, left, left_box, "l", cell_deg)
    right_cells = right_cells.drop("_way")
    keys = ["_cell"]
    if hot is not None:
        left_cells = _blocked(left_cells, hot, left_key, "_lblocks", "_rblocks")
        right_cells = _blocked(right_cells, hot, right_key, "_rblocks", "_lblocks")
        keys += ["_lblocks_i", "_rblocks_i"]
    a, b = F.col(left_box), F.col(right_box)
    overlap = (
        (a["xmin"] <= b["xmax"])
        & (b["xmin"] <= a["xmax"])
        & (a["ymin"] <= b["ymax"])
        & (b["ymin"] <= a["ymax"])
    )
    down = _cell_index(F.greatest(a["ymin"], b["ymin"]), F.col("_size"))
    across = _cell_index(F.greatest(a["xmin"], b["xmin"]), _width(F.col("_size"), down))
    once = F.col("_cell") == _cell_key(F.col("_way"), F.col("_level"), across, down)
    pairs = left_cells.join(right_cells, keys).where(overlap & once)
    if condition is not None:
        pairs = pairs.where(condition)
    return pairs.drop("_cell", "_way", "_level", "_size", "_lblocks_i", "_rblocks_i")


def point_box(lon: Column, lat: Column) -> Column:
    return box(lon, lat, lon, lat)


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(
        xmin.alias("xmin"), ymin.alias("ymin"), xmax.alias("xmax"), ymax.alias("ymax")
    )


def widen(b: Column, metres: float, ref_lat: Column) -> Column:
    """A box grown by ``metres``, measured at ``ref_lat`` and rounded outwards."""
    north = F.lit(metres / fixed.METRES_PER_DEGREE * (1 + 1e-9) + 1e-12)
    # Latitudes above 90 have a cosine below 0; its size is what a degree of longitude has there.
    east = north / F.greatest(F.abs(F.cos(F.radians(ref_lat))), F.lit(1e-6))
    return box(b["xmin"] - east, b["ymin"] - north, b["xmax"] + east, b["ymax"] + north)


def metres_east(ref_lat: Column) -> Column:
    """Metres per degree of longitude."""
    return F.cos(F.radians(ref_lat)) * fixed.METRES_PER_DEGREE


def _gaps(a: Column, b: Column) -> tuple[Column, Column]:
    zero = F.lit(0.0)
    return (
        F.greatest(zero, a["xmin"] - b["xmax"], b["xmin"] - a["xmax"]),
        F.greatest(zero, a["ymin"] - b["ymax"], b["ymin"] - a["ymax"]),
    )


def box_gap_m(a: Column, b: Column, east: Column) -> Column:
    """Metres between two boxes: a lower bound of the distance of their contents."""
    x, y = _gaps(a, b)
    return F.sqrt(F.pow(x * east, 2) + F.pow(y * fixed.METRES_PER_DEGREE, 2))


def box_gap_deg(a: Column, b: Column) -> Column:
    """The larger side of the gap of two boxes in degrees, again a lower bound."""
    return F.greatest(*_gaps(a, b))
