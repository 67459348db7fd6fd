"""Weights arranged for gathering: which source points a tile needs, at which place of its array.

Two arrangements. Grids with few points in use have tiles of neighbouring cells, and a lookup from source point to the
tiles and places that need it, small enough to be broadcast. Grids with many points have tiles of neighbouring source
points, which a point finds by arithmetic; a cell belongs to the tile of its first vertex, and only points that cells of
another tile use as well, a few in a hundred along the edges, are in a lookup. Either way the cube meets broadcast tables
only, and its one exchange is that by step and tile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.session import scratch_path

# 12 * 4**zoom bounds the cells, so the zoom alone decides whether weights may be broadcast:
# zoom 9 has 3.1 million cells of about 60 bytes.
BROADCAST_CELLS = 4_000_000
# rows of the source lookup that may be broadcast; checked by a count where the zoom cannot tell
BROADCAST_LOOKUP = 3_000_000
TILE_LEVELS = 6
#: points along one side of a tile of source points
SIDE = 64


@dataclass(frozen=True)
class Numbering:
    """How source points are numbered: row by row with ``stride`` points to a row, or (0) along some order of places."""

    stride: int
    start: int
    side: int = SIDE

    def place(self, src_idx: Column) -> tuple[Column, Column]:
        """Tile of a source point and its place in there."""
        number = (src_idx - F.lit(self.start)).cast("bigint")
        if not self.stride:
            size = F.lit(self.side * self.side)
            return F.floor(number / size), F.pmod(number, size).cast("int")
        side, across = F.lit(self.side), -(-self.stride // self.side)
        iy, ix = F.floor(number / F.lit(self.stride)), F.pmod(number, F.lit(self.stride))
        column = F.floor(ix / side)
        width = F.least(side, F.lit(self.stride) - column * side)
        return F.floor(iy / side) * across + column, (F.pmod(iy, side) * width + ix % side).cast("int")


@dataclass(frozen=True)
class Layout:
    """Weights of one grid and zoom arranged by tiles.

    ``cells``: tile, cell, places p0..p2, weights w0..w2. ``lookup``: (src_idx, tile, pos, n) for tiles of cells; with a
    ``numbering`` (src_idx, places) of the uses in other tiles only, and ``sizes`` (tile, n_home, n).
    """

    zoom: int
    cells: DataFrame
    lookup: DataFrame
    lookup_is_small: bool
    numbering: Numbering | None = None
    sizes: DataFrame | None = None
    tile_levels: int = TILE_LEVELS
    broadcast_cells: int = BROADCAST_CELLS

    def outside(self) -> tuple[DataFrame, DataFrame]:
        """Cells that no weights belong to, with a tile but no places, and all tiles (tile, n)."""
        every = healpix.all_cells(self.cells.sparkSession, self.zoom)
        outside = every.join(self.cells.select("cell"), "cell", "left_anti")
        tile = F.shiftright("cell", 2 * self.tile_levels)
        # tiles of source points have numbers from 0 on, so those of cells beside them count down
        outside = outside.select((-1 - tile if self.numbering is not None else tile).alias("tile"), "cell")
        sizes = (self.lookup if self.numbering is None else self.sizes).select("tile", "n")
        tiles = sizes.unionByName(outside.select("tile", F.lit(0).alias("n"))).groupBy("tile").agg(F.max("n").cast("int").alias("n"))
        return outside, tiles


def tiles_of_cells(weights: DataFrame, zoom: int, tile_levels: int = TILE_LEVELS) -> Layout:
    """Tiles of ``4**tile_levels`` neighbouring cells. A tile's cells are bounded, and so is the window that numbers its points."""
    tiled = weights.select(F.shiftright("cell", 2 * tile_levels).alias("tile"), "cell", "k", "src_idx", "w")
    rank = F.dense_rank().over(Window.partitionBy("tile").orderBy("src_idx"))
    placed = tiled.withColumn("pos", rank - 1)
    placed = placed.withColumn("n", F.max("pos").over(Window.partitionBy("tile")) + 1)
    lookup = placed.select("tile", "src_idx", "pos", "n").distinct()
    return Layout(zoom, _by_cell(placed), lookup, 3 * healpix.npix(zoom) <= BROADCAST_LOOKUP, tile_levels=tile_levels)


def _by_cell(placed: DataFrame) -> DataFrame:
    per_vertex = {"p": "pos", "w": "w"}
    return placed.groupBy("tile", "cell").agg(
        *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{name}{k}") for name, c in per_vertex.items() for k in range(3)]
    )


def tiles_of_points(weights: DataFrame, zoom: int, numbering: Numbering, lookup_limit: int = BROADCAST_LOOKUP) -> Layout:
    """Tiles of source points, with the points that cells of other tiles use beside them."""
    tile, pos = numbering.place(F.col("src_idx"))
    vertices = weights.select("cell", "k", "src_idx", "w", tile.alias("own"), pos.alias("at"))
    home = vertices.groupBy("cell").agg(F.min_by("own", "k").alias("tile"))
    vertices = _kept(vertices.join(home, "cell"), "vertices")
    inside = F.col("own") == F.col("tile")
    n_home = vertices.groupBy("tile").agg((F.coalesce(F.max(F.when(inside, F.col("at"))), F.lit(-1)) + 1).alias("n_home"))
    uses = vertices.filter(~inside).select("tile", "src_idx").distinct()
    rank = F.row_number().over(Window.partitionBy("tile").orderBy("src_idx"))
    uses = _kept(uses.withColumn("rank", rank).join(n_home, "tile").select("tile", "src_idx", (F.col("n_home") + F.col("rank") - 1).alias("pos")), "uses")
    sizes = n_home.join(uses.groupBy("tile").agg((F.max("pos") + 1).alias("n")), "tile", "left")
    sizes = sizes.select("tile", "n_home", F.coalesce("n", "n_home").alias("n"))
    away = uses.withColumnRenamed("pos", "away")
    placed = vertices.join(away, ["tile", "src_idx"], "left").withColumn("pos", F.when(inside, F.col("at")).otherwise(F.col("away")))
    places = uses.groupBy("src_idx").agg(F.collect_list(F.struct("tile", "pos", F.lit(False).alias("home"))).alias("places"))
    return Layout(zoom, _by_cell(placed), places, uses.count() <= lookup_limit, numbering, sizes)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, since several tables are made from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gather_layout(weights: DataFrame, zoom: int, tile_levels: int | None = None, numbering: Numbering | None = None,
                  lookup_limit: int = BROADCAST_LOOKUP) -> Layout:
    """The arrangement whose lookup may be broadcast: tiles of cells while their lookup is small, else tiles of points."""
    cells_first = tiles_of_cells(weights, zoom, min(TILE_LEVELS if tile_levels is None else tile_levels, zoom))
    if 3 * healpix.npix(zoom) <= lookup_limit or cells_first.lookup.count() <= lookup_limit:
        return Layout(zoom, cells_first.cells, cells_first.lookup, True, tile_levels=cells_first.tile_levels)
    return tiles_of_points(weights, zoom, numbering or Numbering(0, 0), lookup_limit)
