"""Parcels stored by place: a tile for each, files sorted along a space-filling curve, polygons in a table of their own.

A parcel lives in the tile of its box's centre, on the finest level whose tiles are at least as large as the box. So a box
meets only parcels of tiles that it reaches when widened by half a tile, on each level, and nobody is stored twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: About 28 km; each level is 16 times coarser, the last one holds the whole earth.
TILE_DEG = 0.25
_COARSER, _LEVELS = 16, 4
#: Tiles named one by one in a scan's partition filter; more are matched by a join.
MOST_NAMED = 1000
#: The curve's step, about 100 m, so that row groups cover small areas.
_CURVE_DEG = 0.001


def _number(level: int, ix: Column, iy: Column) -> Column:
    return F.lit(level << 40) + (ix + (1 << 19)) * (1 << 20) + iy + (1 << 19)


def _step(value: Column, size: float) -> Column:
    """The cell of a coordinate; what lies beyond valid degrees counts for the cell at the edge."""
    return F.floor(F.greatest(F.least(value, F.lit(180.0)), F.lit(-180.0)) / size).cast("bigint")


def tile_of(box: Column) -> Column:
    """The tile that stores a box; NULL for none."""
    x, y = (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2
    size = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    tile = F.when(box["xmin"].isNull(), F.lit(None).cast("bigint"))
    for level in range(_LEVELS - 1):
        deg = TILE_DEG * _COARSER**level
        tile = tile.when(size <= deg, _number(level, _step(x, deg), _step(y, deg)))
    return tile.otherwise(F.lit(_LEVELS << 40))


def _tiles_on(level: int, box: Column) -> Column:
    deg = TILE_DEG * _COARSER**level
    xs = F.sequence(_step(box["xmin"] - deg / 2, deg), _step(box["xmax"] + deg / 2, deg))
    ys = F.sequence(_step(box["ymin"] - deg / 2, deg), _step(box["ymax"] + deg / 2, deg))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: _number(level, x, y))))


def tiles_near(box: Column) -> Column:
    """All tiles that can store a box that overlaps this one."""
    top = F.array(F.lit(_LEVELS << 40).cast("bigint"))
    return F.flatten(F.array(top, *[_tiles_on(level, box) for level in range(_LEVELS - 1)]))


def _spread_bits(value: Column) -> Column:
    """The low 20 bits of a number with a gap after each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def curve_of(box: Column) -> Column:
    """Place of a box's centre on the curve that takes the bits of both axes in turn."""
    ix = _step((box["xmin"] + box["xmax"]) / 2, _CURVE_DEG) + (1 << 19)
    iy = _step((box["ymin"] + box["ymax"]) / 2, _CURVE_DEG) + (1 << 19)
    return F.shiftleft(_spread_bits(ix), 1).bitwiseOR(_spread_bits(iy))


def write_tiles(indexed: DataFrame, path: str) -> None:
    """Store ``index_parcels`` rows as ``path/attributes`` and ``path/shapes``, both partitioned by tile.

    Rows are range-partitioned by tile and curve, so a tile with very many parcels is written by many tasks.
    """
    placed = indexed.withColumns({"tile": tile_of(F.col("box")), "_curve": curve_of(F.col("box"))})
    rows = placed.drop("geometry").repartitionByRange("tile", "_curve").sortWithinPartitions("tile", "_curve")
    rows.drop("_curve").write.partitionBy("tile").parquet(f"{path}/attributes")
    shapes = placed.where("shape_id is not null").select("tile", "_curve", "shape_id", "geometry").dropDuplicates(["shape_id"])
    shapes = shapes.repartitionByRange("tile", "_curve", "shape_id").sortWithinPartitions("tile", "_curve", "shape_id")
    shapes.drop("_curve").write.partitionBy("tile").parquet(f"{path}/shapes")


@dataclass(frozen=True)
class ParcelTiles:
    """A stored table: the operators take it in place of a frame of parcels and read only tiles in use."""

    attributes: DataFrame
    shapes: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ParcelTiles:
        return cls(spark.read.parquet(f"{path}/attributes"), spark.read.parquet(f"{path}/shapes"))

    def near(self, search: DataFrame, box: str) -> ParcelTiles:
        """The table without tiles that no box of ``search`` can meet.

        Up to ``MOST_NAMED`` tiles become a partition filter, with the hull of all boxes for row groups; more are joined
        by the broadcast list of their numbers (at most one for each tile of the earth, about a million).
        """
        b = F.col(box)
        wanted = search.where(b["xmin"].isNotNull()).select(F.explode(tiles_near(b)).alias("tile"), b.alias("_b")).groupBy("tile").agg(
            F.min("_b.xmin").alias("x0"), F.min("_b.ymin").alias("y0"), F.max("_b.xmax").alias("x1"), F.max("_b.ymax").alias("y1")
        )
        named = wanted.limit(MOST_NAMED + 1).collect()
        if len(named) > MOST_NAMED:
            tiles = F.broadcast(wanted.select("tile"))
            return ParcelTiles(self.attributes.join(tiles, "tile", "left_semi"), self.shapes.join(tiles, "tile", "left_semi"))
        here = F.col("tile").isin([r["tile"] for r in named])
        attributes = self.attributes.where(here)
        if named:
            x0, y0, x1, y1 = (f(r[c] for r in named) for f, c in ((min, "x0"), (min, "y0"), (max, "x1"), (max, "y1")))
            own = F.col("box")
            attributes = attributes.where((own["xmin"] <= x1) & (own["xmax"] >= x0) & (own["ymin"] <= y1) & (own["ymax"] >= y0))
        return ParcelTiles(attributes, self.shapes.where(here))
