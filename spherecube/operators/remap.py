"""Applying weights: source values to cell values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.functions.fields import value_columns
from spherecube.operators.gather import Layout, gather_layout


def step_keys(cube: DataFrame) -> list[str]:
    """What identifies one field on the sphere: time, level and, where steps repeat, step_id."""
    return [c for c in ("time", "level", "level_order", "step_id") if c in cube.columns]


def repeated_points(cube: DataFrame) -> DataFrame:
    """Points given more than once for a step; a remap refuses them."""
    keys = [*step_keys(cube), "src_idx"]
    return cube.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def with_step_id(cube: DataFrame, file: str = "source_file") -> DataFrame:
    """Tell repeated steps apart by the file they came from."""
    return cube.withColumn("step_id", F.xxhash64(file, "time"))


def _tasks(cube: DataFrame) -> int:
    """Partitions for the arrays: a fixed number, because each small array turns into thousands of
    rows and adaptive execution, judging by bytes, would merge them into too few tasks."""
    spark = cube.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _slices(tiled: DataFrame, keys: list[str], values: list[str], marked: bool = False) -> DataFrame:
    """One array per step and tile whose element ``pos`` holds the values of that source point.

    A complete slice only needs sorting. One with missing points is filled up in one pass: before each entry
    come as many NULLs as positions lie between it and the one before. Points given twice are an error. ``marked`` rows
    with a NULL position only make sure that their step and tile has an array.
    """
    entry = F.struct("pos", *values)
    if marked:
        entry = F.when(F.col("pos").isNotNull(), entry)
    packed = tiled.groupBy(*keys, "tile").agg(
        F.sort_array(F.collect_list(entry)).alias("_found"), F.max("n").alias("_n")
    )
    found, nothing = F.col("_found"), F.get("_found", F.lit(-1))

    def with_gap(e: Column, i: Column) -> Column:
        gap = e["pos"] - F.coalesce(F.get(found, i - 1)["pos"], F.lit(-1)) - 1
        twice = F.raise_error(F.lit("a source point is given twice for a step")).cast("int")
        return F.concat(F.array_repeat(nothing, F.when(gap < 0, twice).otherwise(gap).cast("int")), F.array(e))

    last = F.coalesce(F.get(found, F.size(found) - 1)["pos"], F.lit(-1))
    tail = F.array_repeat(nothing, (F.col("_n") - 1 - last).cast("int"))
    filled = F.concat(F.flatten(F.transform(found, with_gap)), tail)
    whole = found["pos"] == F.sequence(F.lit(0), F.col("_n") - 1)
    return packed.select(*keys, "tile", F.when(whole, found).otherwise(filled).alias("_s"))


def _routed(cube: DataFrame, layout: Layout, keys: list[str], values: list[str]) -> DataFrame:
    """A row per source value and tile that needs it, with its position there and the tile's number of positions."""
    rows = cube.select(*keys, "src_idx", *values)
    extra = F.broadcast(layout.lookup) if layout.lookup_is_small else layout.lookup
    if layout.numbering is None:
        return rows.join(extra, "src_idx").select(*keys, "tile", "pos", "n", *values)
    tile, pos = layout.numbering.place(F.col("src_idx"))
    used = F.inline(F.coalesce("places", F.array().cast("array<struct<tile:bigint,pos:int,home:boolean>>")))
    away = cube.select(*keys, "src_idx", *values).join(extra, "src_idx").select(*keys, *values, used)
    rows = rows.select(*keys, *values, tile.alias("tile"), pos.alias("pos"), F.lit(True).alias("home")).unionByName(away)
    sized = rows.join(F.broadcast(layout.sizes), "tile").filter(~F.col("home") | (F.col("pos") < F.col("n_home")))
    return sized.select(*keys, "tile", "pos", "n", *values)


def apply_weights(
    cube: DataFrame,
    weights: DataFrame | Layout,
    zoom: int,
    values: list[str] | None = None,
    tile_levels: int | None = None,
    time_groups: int = 16,
    broadcast: bool | None = None,
    dense: bool = False,
) -> DataFrame:
    """Interpolate every field of ``cube`` (time[, level], src_idx, values) to cells.

    The cube is shuffled once, by step and tile, into arrays of the source values each tile needs; cells then read
    their three vertices from the array by position. The many output rows are made by a hash join on the tile and are
    neither grouped nor shuffled. A missing vertex makes the cell NULL; a cell has a row when at least one vertex has
    one. With ``dense`` every step of the cube has a row for every cell of the sphere, out of the same join: the cell
    table then carries the cells outside the grid without positions.

    ``weights`` is a weights table or its stored gather layout (:func:`stores.cached_layout`), which saves arranging
    the weights again. Cell tables are broadcast up to ``gather.BROADCAST_CELLS`` rows. Beyond that they are repeated for
    ``time_groups`` groups of steps and meet the arrays per (group, tile), where those already lie.
    """
    keys = step_keys(cube)
    values = values or value_columns(cube)
    layout = weights if isinstance(weights, Layout) else gather_layout(weights, zoom, tile_levels)
    tiled = _routed(cube, layout, keys, values)
    cells = layout.cells
    if dense:
        outside, tiles = layout.outside()
        cells = cells.unionByName(outside, allowMissingColumns=True)
        # steps times tiles: one row for each array to come
        marks = cube.select(*keys).distinct().crossJoin(F.broadcast(tiles))
        tiled = tiled.unionByName(marks, allowMissingColumns=True)
    if broadcast is None:
        broadcast = healpix.npix(zoom) <= layout.broadcast_cells
    tasks = _tasks(cube)
    if broadcast:
        slices = _slices(tiled.repartition(tasks, *keys, "tile"), keys, values, dense)
        met = slices.join(F.broadcast(cells), "tile")
    else:
        tiled = tiled.withColumn("_group", F.pmod(F.xxhash64("time"), F.lit(time_groups)).cast("int"))
        cells = cells.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(time_groups - 1))))
        slices = _slices(tiled.repartition(tasks, "_group", "tile"), [*keys, "_group"], values, dense)
        met = slices.join(cells.repartition(tasks, "_group", "tile").hint("shuffle_hash"), ["_group", "tile"])
    vertices = [F.get("_s", F.col(f"p{k}")) for k in range(3)]
    present = vertices[0].isNotNull() | vertices[1].isNotNull() | vertices[2].isNotNull()

    def weighted(v: str) -> Column:
        return vertices[0][v] * F.col("w0") + vertices[1][v] * F.col("w1") + vertices[2][v] * F.col("w2")

    return (met if dense else met.filter(present)).select(*keys, "cell", *[weighted(v).alias(v) for v in values])


def invalid_cells(weights: DataFrame, zoom: int) -> DataFrame:
    """Cells outside the source grid."""
    return healpix.all_cells(weights.sparkSession, zoom).join(
        weights.select("cell").distinct(), "cell", "left_anti"
    )
