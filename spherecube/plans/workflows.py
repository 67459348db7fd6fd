"""Whole jobs composed from the operators: remap, coarsen, combine, merge.

Each job builds one lazy plan and ends in a write. The only values that reach the driver on the
way are single-row facts (axis extents, the first two time steps, check results).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.functions.times import parse_date_value
from spherecube.operators import coarsen as co
from spherecube.operators import combine, gather, grids, levels, quality, remap, timeops, variables
from spherecube.operators.triangulation import triangulated_weights
from spherecube.operators.weights import grid_fingerprint, linear_index, regular_weights, require_fit
from spherecube.sources import catalog, cubes, stores

log = logging.getLogger(__name__)

Step = Callable[..., DataFrame]


def apply_steps(
    cube: DataFrame, funcs: Step | list[Step] | None, kwargs: dict | list[dict] | None = None
) -> DataFrame:
    """Run user callables ``f(cube, **kwargs)`` in order.

    One kwargs dict serves a single function or all of them; otherwise give one per function.
    """
    if funcs is None:
        return cube
    funcs = funcs if isinstance(funcs, list) else [funcs]
    given = kwargs if isinstance(kwargs, list) else [kwargs or {}]
    if len(given) == 1:
        given = given * len(funcs)
    if len(given) != len(funcs):
        raise ValueError(f"{len(given)} sets of arguments for {len(funcs)} functions")
    for func, kw in zip(funcs, given):
        cube = cube.transform(func, **(kw or {}))
    return cube


def build_weights(points: DataFrame, zoom: int, grid_type: str, grid_id: str) -> DataFrame:
    """Weights by grid type; ``auto`` finds the type from the points."""
    if grid_type == "auto":
        grid_type = grids.detect_kind(points)
    if grid_type == grids.LATLON_1D:
        return regular_weights(points, zoom, grid_id)
    if grid_type in (grids.LATLON_2D, grids.UNSTRUCTURED):
        return triangulated_weights(points, zoom, grid_id)
    raise ValueError(f"unknown grid type {grid_type!r}")


def weights_for(
    points: DataFrame, zoom: int, grid_type: str = "auto", cache: str | None = None, force: bool = False
) -> DataFrame:
    grid_id = grid_fingerprint(points)

    def build() -> DataFrame:
        return build_weights(points, zoom, grid_type, grid_id)

    if cache is None:
        return build()
    return stores.cached_weights(points.sparkSession, cache, grid_id, zoom, build, force)


def remap_cube(
    cube: DataFrame,
    weights: DataFrame | gather.Layout,
    zoom: int,
    config: dict | None = None,
    funcs: Step | list[Step] | None = None,
    kwargs: dict | list[dict] | None = None,
) -> DataFrame:
    """From a gridded cube to a cell cube: steps, time average, remap, selection and renaming.

    Selections come before the remap so Catalyst pushes them into the scan, and variables that
    are not asked for are dropped before any join.
    """
    config = config or {}
    cube = apply_steps(cube, funcs, kwargs)
    cube = variables.drop_skipped_columns(cube, config.get("skip_variables"))
    renames = config.get("remap_variables")
    through = [v for v in config.get("passthrough_variables") or [] if v in cube.columns and v != "level"]
    axis = "level" if "level" in cube.columns else "time"
    side = variables.passthrough_table(cube, through, axis) if through else None
    if side is not None and axis == "time":
        side = timeops.temporal_average(side, config.get("time_average"), [], fill=config.get("fill", True))
    if renames:
        cube = variables.select_rename(cube, renames)
    if side is not None:
        cube = cube.drop(*through)
    keys = [c for c in ("level", "level_order", "src_idx") if c in cube.columns]
    cube = timeops.temporal_average(cube, config.get("time_average"), keys, fill=config.get("fill", True))
    out = remap.apply_weights(cube, weights, zoom, dense=bool(config.get("dense")))
    if side is not None:
        out = variables.attach_passthrough(out, side, axis)
    return out


def preset_steps(config: dict) -> tuple[list[Step], list[dict]]:
    """Selection steps that a preset asks for."""
    funcs, kwargs = [], []
    subset = config.get("time_subset")
    if subset in ("00min", "30min"):
        funcs.append(timeops.keep_minute)
        kwargs.append({"time_subset": subset})
    elif subset:
        funcs.append(timeops.every_interval)
        kwargs.append({"time_subset": subset})
    if config.get("level_subset"):
        funcs.append(levels.keep_levels_checked)
        kwargs.append({"wanted": config["level_subset"]})
    return funcs, kwargs


def open_source(
    spark: SparkSession, config: dict, start: dt.datetime, end: dt.datetime,
    funcs: Step | list[Step] | None = None, kwargs: dict | list[dict] | None = None,
) -> DataFrame:
    """Find and read the source files of a preset, and run ``funcs``, which select rows, on what was read.

    With several variables the selection comes before their merge.
    Give ``input_files`` (list, or dict of lists per variable) to skip discovery.
    """
    files = config.get("input_files")
    if files is None and "file_template" in config:
        found = catalog.find_variable_files(
            spark, config["input_base_dir"], config["variables"], config["file_template"], start, end,
            config.get("monthly_files", False),
        )
        files = {v["var_name"]: [] for v in config["variables"]}
        for row in found.select("var", "path").orderBy("var", "path").toLocalIterator():
            files[row["var"]].append(row["path"])
    elif files is None:
        found = catalog.find_files(
            spark, start, end, config["input_base_dir"],
            config.get("date_pattern", r"\.(\d{8})-"), config.get("date_format", "%Y%m%d"),
            config.get("year_subdirs", True), config.get("file_glob", "*"),
        )
        files = catalog.path_list(found)
    if config.get("check_load", True):
        for paths in files.values() if isinstance(files, dict) else [files]:
            if paths:
                cubes.require_complete_files(spark, paths)
    def selected(cube: DataFrame) -> DataFrame:
        if config.get("clip_rows"):
            cube = timeops.keep_period(cube, start, end)
        return apply_steps(cube, funcs, kwargs)

    if isinstance(files, dict):
        keys = ["time", "src_idx"] + (["level"] if config.get("level_subset") else [])
        return cubes.read_variables(spark, files, keys, select=selected)
    return selected(cubes.read_cube(spark, files))


def process_to_cells(
    spark: SparkSession,
    start: str,
    end: str,
    zoom: int,
    output: str,
    points: DataFrame,
    config: dict,
    weights_cache: str | None = None,
    overwrite: bool = False,
    funcs: Step | list[Step] | None = None,
    kwargs: dict | list[dict] | None = None,
) -> DataFrame:
    """The full job: discover, read, select, average, remap, rename, write. Returns the store."""
    begin, finish = parse_date_value(start), parse_date_value(end, end_of_period=True)
    chosen, chosen_kwargs = preset_steps(config) if funcs is None else ([], [])
    cube = open_source(spark, config, begin, finish, chosen or None, chosen_kwargs)
    weights = weights_for(points, zoom, config.get("grid_type", "auto"), weights_cache, config.get("force_recompute", False))
    require_fit(weights, points)
    if weights_cache is not None:
        linear = linear_index(points) if {"iy", "ix"} <= set(points.columns) else None
        weights = stores.cached_layout(
            spark, f"{weights_cache.rstrip('/')}-layouts", grid_fingerprint(points), zoom, weights,
            gather.Numbering(*linear) if linear else None, config.get("force_recompute", False),
        )
    out = remap_cube(cube, weights, zoom, config, funcs or None, kwargs)
    stores.write_store(out, output, zoom, config.get("time_chunk", 48), "overwrite" if overwrite else "error")
    stores.save_attributes(spark, output, stores.attributes(
        zoom, config.get("grid_type", "auto"), grid_id=grid_fingerprint(points), time_average=config.get("time_average"),
        time_subset=config.get("time_subset"), start=begin.isoformat(), end=finish.isoformat(),
    ))
    return stores.read_store(spark, output)


def coarsen_store(
    spark: SparkSession,
    source: str,
    target_zoom: int,
    root: str,
    start_zoom: int | None = None,
    target_hours: list[int] | None = None,
    subsample: int = 1,
    temporal_factor: int = 1,
    direct: bool = False,
    overwrite: bool = False,
    start_date: str | None = None,
    end_date: str | None = None,
) -> list[int]:
    """Coarsen a stored cell cube in time and space; returns the zooms written."""
    if start_zoom is None:
        start_zoom = catalog.names.parse_store_name(source.rstrip("/").rsplit("/", 1)[-1])["zoom"]
    cube = stores.read_store(spark, source).drop("day", "tile")
    cube = _in_period(cube, start_date, end_date)
    cube = co.coarsen_time(cube, target_hours, subsample, temporal_factor)
    written = co.write_pyramid(cube, start_zoom, target_zoom, root, direct, overwrite)
    before = stores.stored_attributes(spark, source)
    temporal = _temporal_text(target_hours, subsample, temporal_factor)
    for z in written:
        done = {"coarsened_from": start_zoom if direct else z + 1, "source": source, "temporal_coarsening": temporal}
        kept = {k: v for k, v in before.items() if k not in stores.attributes(z, "")}
        stores.save_attributes(spark, f"{root}/zoom={z}", stores.attributes(z, before.get("original_grid", "healpix"), **kept, **done))
    return written


def coarsen_catalog(
    spark: SparkSession,
    catalog_root: str,
    dataset: str,
    time_res: str,
    start_zoom: int,
    target_zoom: int,
    root: str,
    names: dict[str, str],
    target_hours: list[int] | None = None,
    subsample: int = 1,
    temporal_factor: int = 1,
    overwrite: bool = False,
    start_date: str | None = None,
    end_date: str | None = None,
) -> list[int]:
    """Coarsen one source of a catalog, found by data set, resolution and zoom; returns the zooms written.

    ``names`` says which variables are taken and what they are called in the output; every one of them must be there.
    Only the partitions of that source and the columns of those variables are read.
    """
    cube = cubes.scan_catalog(spark, catalog_root, dataset, start_zoom, time_res)
    keys = [c for c in ("time", "level", "cell") if c in cube.columns]
    cube = cube.select(*keys, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])
    cube = _in_period(cube, start_date, end_date)
    cube = co.coarsen_time(cube, target_hours, subsample, temporal_factor)
    written = co.write_pyramid(cube, start_zoom, target_zoom, root, overwrite=overwrite)
    for z in written:
        stores.save_attributes(spark, f"{root}/zoom={z}", stores.attributes(
            z, "healpix", source=f"{dataset} {time_res} zoom {start_zoom}", coarsened_from=z + 1,
            temporal_coarsening=_temporal_text(target_hours, subsample, temporal_factor),
        ))
    return written


def _in_period(cube: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    kept = timeops.keep_dates(cube, start_date, end_date)
    if (start_date or end_date) and kept.isEmpty():
        raise ValueError(f"no data between {start_date} and {end_date}")
    return kept


def _temporal_text(target_hours: list[int] | None, subsample: int, temporal_factor: int) -> str | None:
    if target_hours:
        return f"hours {target_hours}"
    if subsample > 1:
        return f"every {subsample} steps"
    return f"means of {temporal_factor} steps" if temporal_factor > 1 else None


def combine_days(
    spark: SparkSession, folder: str, output: str, zoom: int, start: dt.datetime | None = None,
    end: dt.datetime | None = None, overwrite: bool = False,
) -> DataFrame:
    """Concatenate daily stores into one, all rows kept."""
    files = catalog.list_files(spark, [folder], "*.parquet", recursive=True)
    store = F.regexp_extract("path", rf"/([^/]*_\d{{8}}_\d{{8}}[^/]*)/", 1)
    named = files.select(F.regexp_extract("path", r"^(.*/[^/]*_\d{8}_\d{8}[^/]*)/", 1).alias("path"), store.alias("name"))
    found = catalog.daily_stores(named.filter("name <> ''").distinct(), start, end)
    paths = catalog.path_list(found)
    if not paths:
        raise FileNotFoundError(f"no daily stores in {folder}")
    days = cubes.read_cube(spark, paths, recursive=True).drop("tile")
    stores.write_store(days, output, zoom, mode="overwrite" if overwrite else "error")
    order = stored_order(spark, paths).first()
    if order.backward_steps or order.repeated_steps:
        log.warning("%s: %d steps go backwards, %d repeat an earlier one", output, order.backward_steps, order.repeated_steps)
    first = stores.stored_attributes(spark, paths[0])
    stores.save_attributes(spark, output, {**stores.attributes(zoom, "healpix"), **first, "combined_from": str(len(paths))})
    return stores.read_store(spark, output)


def stored_order(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Order of the steps over a sequence of stores, taken by name: how many go backwards, how many are repeated."""
    steps = cubes.steps_of_files(spark, paths, recursive=True)
    store = F.regexp_extract("source_file", r"([^/]*_\d{8}_\d{8}[^/]*)/", 1)
    return quality.time_order_report(steps.select(store.alias("store"), "time").distinct(), ["store", "time"])


def merge_stores(
    spark: SparkSession, surface: str, level: str, output: str, zoom: int, validate: bool = True,
    overwrite: bool = False, partition_by: tuple[str, ...] = ("day",),
) -> DataFrame:
    """Merge a surface and a level store (named arguments: the order cannot be mixed up)."""
    sfc, lev = [stores.read_store(spark, p).drop("day", "tile") for p in (surface, level)]
    if validate:
        combine.require_mergeable(sfc, lev)
    merged = combine.merge_surface_levels(sfc, lev)
    stores.write_store(merged, output, zoom, mode="overwrite" if overwrite else "error", partition_by=partition_by)
    kept = {**stores.stored_attributes(spark, level), **stores.stored_attributes(spark, surface)}
    stores.save_attributes(spark, output, {**stores.attributes(zoom, "healpix"), **kept, "merged_from": f"{surface}, {level}"})
    return stores.read_store(spark, output)


def write_by_month(cube: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Month folders for long records. Partitions are balanced by size: a month with much data is written by several tasks,
    months with little share one."""
    dated = cube.withColumns({"year": F.year("time"), "month": F.month("time")})
    dated.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").parquet(path)
