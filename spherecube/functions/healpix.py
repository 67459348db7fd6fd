"""HEALPix NESTED pixel maths as integer Column expressions (Gorski et al. 2005)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def nside(zoom: int) -> int:
    return 1 << zoom


def npix(zoom: int) -> int:
    return 12 << (2 * zoom)


def resolution_deg(zoom: int) -> float:
    """Edge of a square with the area of one cell, in degrees."""
    return math.degrees(math.sqrt(4.0 * math.pi / npix(zoom)))


def parent_cell(cell: Column, levels: int) -> Column:
    """Cell ``levels`` zooms up: four children are consecutive in NESTED order."""
    return F.shiftright(cell, 2 * levels)


def chunk_cells(zoom: int) -> int:
    """Cells per spatial chunk: the whole sphere below zoom 8, 4**9 from there on."""
    return npix(zoom) if zoom < 8 else 4**9


def tile(cell: Column, zoom: int) -> Column:
    """Storage tile of a cell. A chunk of 4**9 cells is a plain shift by 18 bits."""
    return F.shiftright(cell, 18) if zoom >= 8 else F.lit(0).cast("bigint")


def grid_facts(zooms: DataFrame, zoom: str = "zoom") -> DataFrame:
    """nside, npix, resolution and chunk size for a table of zoom levels."""
    z = F.col(zoom)
    side = F.pow(F.lit(2.0), z).cast("bigint")
    cells = F.lit(12) * side * side
    return zooms.withColumns(
        {
            "nside": side,
            "npix": cells,
            "resolution_deg": F.degrees(F.sqrt(F.lit(4.0 * math.pi) / cells)),
            "chunk_cells": F.when(z < 8, cells).otherwise(F.lit(4**9).cast("bigint")),
        }
    )


def all_cells(spark: SparkSession, zoom: int) -> DataFrame:
    return spark.range(npix(zoom)).withColumnRenamed("id", "cell")


def _every_other_bit(value: Column, start: int, bits: int) -> Column:
    total = None
    for b in range(bits):
        bit = F.shiftleft(F.shiftright(value, 2 * b + start).bitwiseAND(F.lit(1)), b)
        total = bit if total is None else total + bit
    return F.lit(0).cast("bigint") if total is None else total


def with_cell_centers(
    df: DataFrame, zoom: int, cell: str = "cell", lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Add centre longitude [0, 360) and latitude in degrees.

    Written as a few small projections: each names a value used more than once by the next, so
    the expression stays linear in size and all of it runs in one generated stage.
    """
    n = nside(zoom)
    keep = df.columns
    c = F.col(cell).cast("bigint")
    step = df.select(
        *keep,
        F.shiftright(c, 2 * zoom).alias("_face"),
        _every_other_bit(c, 0, zoom).alias("_x"),
        _every_other_bit(c, 1, zoom).alias("_y"),
    )
    ring_of_face = F.lit(2) + F.floor(F.col("_face") / 4)
    in_row = F.col("_face") % 4
    lon_of_face = F.when(
        F.col("_face").between(4, 7), in_row * 2
    ).otherwise(in_row * 2 + 1)
    step = step.select(
        *keep,
        (F.col("_x") - F.col("_y")).alias("_dxy"),
        lon_of_face.alias("_jp0"),
        (ring_of_face * n - F.col("_x") - F.col("_y") - 1).alias("_ring"),
    )
    north, south = F.col("_ring") < n, F.col("_ring") > 3 * n
    step = step.select(
        *keep,
        "_dxy",
        "_jp0",
        F.when(north, F.col("_ring")).when(south, 4 * n - F.col("_ring")).otherwise(n).alias("_nr"),
        F.when(north | south, 0)
        .otherwise((F.col("_ring") - n).bitwiseAND(F.lit(1)))
        .alias("_shift"),
        F.when(north, 1).when(south, -1).otherwise(0).alias("_cap"),
        ((2 * n - F.col("_ring")) * 2.0 / (3.0 * n)).alias("_belt_z"),
    )
    nr = F.col("_nr")
    step = step.select(
        *keep,
        "_nr",
        "_shift",
        F.floor((F.col("_jp0") * nr + F.col("_dxy") + 1 + F.col("_shift")) / 2).alias("_jp"),
        F.when(F.col("_cap") == 0, F.col("_belt_z"))
        .otherwise(F.col("_cap") * (1.0 - nr * nr / (3.0 * n * n)))
        .alias("_z"),
    )
    jp = F.col("_jp")
    around = F.when(jp > 4 * n, jp - 4 * n).when(jp < 1, jp + 4 * n).otherwise(jp)
    centre = F.struct(
        ((around - (F.col("_shift") + 1) / 2.0) * 90.0 / nr).alias(lon),
        F.degrees(F.asin("_z")).alias(lat),
    )
    # a one-row generator: filters on lon/lat stay above it instead of repeating the maths
    return step.select(*keep, F.inline(F.array(centre)))
