"""Coarser zooms by averaging nested cells."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.functions.fields import to_storage_types, value_columns
from spherecube.operators import timeops
from spherecube.operators.remap import step_keys
from spherecube.sources.catalog import glob_paths, remove_path, touch

log = logging.getLogger(__name__)

#: levels made from one shuffle: a task's coarsest cell then has 4096 cells of the level above the first
LEVELS_AT_ONCE = 6


def coarsen(
    cube: DataFrame, from_zoom: int, to_zoom: int, values: list[str] | None = None
) -> DataFrame:
    """Mean of the ``4**(from - to)`` descendants of each cell; missing values are skipped.

    Descendants are consecutive in NESTED order, so the parent is a bit shift and partial
    aggregation folds most siblings before the shuffle when the input is stored by tile.
    """
    if from_zoom <= to_zoom:
        raise ValueError(f"zoom {to_zoom} is not coarser than {from_zoom}")
    values = values or value_columns(cube)
    parent = healpix.parent_cell(F.col("cell"), from_zoom - to_zoom)
    return cube.groupBy(*step_keys(cube), parent.alias("cell")).agg(*[F.avg(v).alias(v) for v in values])


def pyramid(cube: DataFrame, from_zoom: int, to_zoom: int) -> dict[int, DataFrame]:
    """Every level down to ``to_zoom``, each the mean of the level above it.

    With missing values this is a mean of means and differs from :func:`coarsen`. The returned
    plans are nested; use :func:`all_levels` for several at once, :func:`write_pyramid` to keep them.
    """
    if from_zoom <= to_zoom:
        log.warning("start zoom %s must be finer than target zoom %s", from_zoom, to_zoom)
        return {}
    levels, current = {}, cube
    for z in range(from_zoom - 1, to_zoom - 1, -1):
        current = coarsen(current, z + 1, z)
        levels[z] = current
    return levels


def all_levels(cube: DataFrame, from_zoom: int, to_zoom: int, values: list[str] | None = None, as_stored: bool = False) -> DataFrame:
    """Every level below ``from_zoom`` down to ``to_zoom`` with its ``zoom``, each the mean of the level above it.

    One scan and one exchange, by day and cell of the coarsest level: all descendants of such a cell lie in one task, which
    aggregates level by level and carries the levels above along in an array. ``as_stored`` gives each level the storage
    types before the next is made from it. A row holds at most ``4 ** (from_zoom - to_zoom)`` rows of the levels above.
    """
    keys = step_keys(cube)
    values = values or value_columns(cube)
    tile = healpix.parent_cell(F.col("cell"), from_zoom - to_zoom)
    dealt = cube.select(F.to_date("time").alias("_day"), tile.alias("_tile"), *keys, "cell", *values).repartition("_day", "_tile")
    lane = ["_day", "_tile", *keys]
    means = [F.avg(v).alias(v) for v in values]
    up = healpix.parent_cell(F.col("cell"), 1).alias("cell")

    def typed(level: DataFrame) -> DataFrame:
        return to_storage_types(level) if as_stored else level

    level = typed(dealt.groupBy(*lane, up).agg(*means))
    row = lambda z: F.struct(F.lit(z).alias("zoom"), "cell", *values)
    for z in range(from_zoom - 2, to_zoom - 1, -1):
        below = F.array(row(z + 1)) if z == from_zoom - 2 else F.concat(F.array(row(z + 1)), "_above")
        level = typed(level.groupBy(*lane, up).agg(*means, F.flatten(F.collect_list(below)).alias("_above")))
    rows = F.array(row(to_zoom)) if to_zoom == from_zoom - 1 else F.concat(F.array(row(to_zoom)), "_above")
    return level.select(*keys, F.inline(rows)).select("zoom", *keys, "cell", *values)


def existing_zooms(spark: SparkSession, root: str) -> list[int]:
    """Levels that have been written in full (each has its own success marker)."""
    marks = glob_paths(spark, f"{root}/zoom=*/_SUCCESS")
    return sorted(int(m.rsplit("/zoom=", 1)[1].split("/")[0]) for m in marks)


def stored_levels(spark: SparkSession, root: str) -> DataFrame:
    """:func:`existing_zooms` as a table, one row a level."""
    return spark.createDataFrame([(z,) for z in existing_zooms(spark, root)], "zoom int")


def wanted_levels(zooms: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested zooms that no store has yet."""
    return zooms.join(existing, "zoom", "left_anti")


def _runs(from_zoom: int, to_zoom: int, done: set[int]) -> list[list[int]]:
    """Levels to write, in runs that are made together: neighbours, and not more than a task's cell can hold."""
    runs: list[list[int]] = []
    for z in range(from_zoom - 1, to_zoom - 1, -1):
        if z in done:
            log.warning("zoom %s exists and is kept", z)
        elif runs and runs[-1][-1] == z + 1 and len(runs[-1]) < LEVELS_AT_ONCE:
            runs[-1].append(z)
        else:
            runs.append([z])
    return runs


def write_pyramid(
    cube: DataFrame,
    from_zoom: int,
    to_zoom: int,
    root: str,
    direct: bool = False,
    overwrite: bool = False,
) -> list[int]:
    """Write levels to ``root/zoom=Z``; returns the levels written.

    Up to :data:`LEVELS_AT_ONCE` levels come from one shuffle of the level above them and are written by the same tasks,
    at most one file for each day, level and cell of the coarsest of them. A level counts as written once it has its
    own success marker; what an earlier run left without one is replaced. Existing levels are kept unless
    ``overwrite``, and they still serve as input of the next one.
    """
    spark = cube.sparkSession
    if from_zoom <= to_zoom:
        log.warning("start zoom %s must be finer than target zoom %s", from_zoom, to_zoom)
        return []
    done = set() if overwrite else set(existing_zooms(spark, root))
    if direct:
        runs = [] if to_zoom in done else [[to_zoom]]
    else:
        runs = _runs(from_zoom, to_zoom, done)
    for run in runs:
        above = from_zoom if direct else run[0] + 1
        source = cube if above == from_zoom else spark.read.parquet(f"{root}/zoom={above}").drop("day")
        if direct:
            levels = to_storage_types(coarsen(source, above, to_zoom)).withColumn("zoom", F.lit(to_zoom))
        else:
            levels = all_levels(source, above, run[-1], as_stored=True)
        for z in run:
            remove_path(spark, f"{root}/zoom={z}")
        dated = levels.withColumn("day", F.to_date("time"))
        dated.sortWithinPartitions("zoom", "day", "time", "cell").write.mode("append").option("compression", "zstd").partitionBy("zoom", "day").parquet(root)
        for z in run:
            touch(spark, f"{root}/zoom={z}/_SUCCESS")
    return [z for run in runs for z in run]


def coarsen_time(
    cube: DataFrame,
    target_hours: list[int] | None = None,
    subsample: int = 1,
    temporal_factor: int = 1,
) -> DataFrame:
    """One temporal reduction, in this order of precedence: hours, every Nth step, blocks."""
    keys = [c for c in ("level", "cell") if c in cube.columns]
    if target_hours is not None:
        return timeops.target_hours_mean(cube, target_hours, keys)
    if subsample > 1:
        return timeops.every_nth(cube, subsample)
    return timeops.block_mean(cube, temporal_factor, keys)


def coarsen_time_and_space(
    cube: DataFrame,
    from_zoom: int,
    to_zoom: int,
    target_hours: list[int] | None = None,
    subsample: int = 1,
    temporal_factor: int = 1,
) -> DataFrame:
    """Temporal reduction first, then cells: two aggregations, since a mean of means with missing
    values is not the mean of all."""
    return coarsen(coarsen_time(cube, target_hours, subsample, temporal_factor), from_zoom, to_zoom)
