"""Parquet stores of cell cubes, weights and attributes."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.functions.fields import to_storage_types, value_columns
from spherecube.operators import gather

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(hadoop_path.getFileSystem(conf).exists(hadoop_path))


def store_layout(cube: DataFrame, zoom: int, time_chunk: int = 48) -> DataFrame:
    """Add the storage keys: day, spatial tile and the block of time steps within the day."""
    if "cell" not in cube.columns or "time" not in cube.columns:
        raise ValueError("a store needs time and cell columns")
    seconds = F.unix_micros(F.col("time").cast("timestamp")) / F.lit(1e6)
    return cube.withColumns(
        {
            "day": F.to_date("time"),
            "tile": healpix.tile(F.col("cell"), zoom),
            "_slot": F.floor(seconds % 86400 / (86400.0 / max(1, 24 // min(time_chunk, 24)))),
        }
    )


def write_store(
    cube: DataFrame,
    path: str,
    zoom: int,
    time_chunk: int = 48,
    mode: str = "error",
    partition_by: tuple[str, ...] = ("day",),
) -> None:
    """Write a cell cube as zstd Parquet, one folder per day.

    ``mode``: ``error`` (fail if the store exists), ``overwrite`` (replace it) or
    ``overwrite_days`` (replace only the days present in ``cube``). Rows of one day are shuffled by
    (day, slot, tile), so one day may use as many tasks as it has tiles and slots, and sorted by
    (time, cell) inside a file, so Parquet statistics prune both.
    """
    modes = {"error": "errorifexists", "overwrite": "overwrite", "overwrite_days": "overwrite"}
    if mode not in modes:
        raise ValueError(f"unknown mode {mode!r}")
    laid_out = to_storage_types(store_layout(cube, zoom, time_chunk))
    order = [c for c in ("time", "level", "cell") if c in cube.columns]
    rows = laid_out.repartition("day", "_slot", "tile").sortWithinPartitions("day", "tile", *order)
    (
        rows.drop("_slot")
        .write.mode(modes[mode])
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic" if mode == "overwrite_days" else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_catalog(cube: DataFrame, root: str, dataset: str | Column, time_res: str, zoom: int, time_chunk: int = 48) -> None:
    """Add a cell cube to a catalog: folders dataset/time_res/zoom/day, of which only those written are replaced."""
    named = cube.withColumn("dataset", F.lit(dataset) if isinstance(dataset, str) else dataset)
    named = named.withColumns({"time_res": F.lit(time_res), "zoom": F.lit(zoom)})
    write_store(named, root, zoom, time_chunk, "overwrite_days", ("dataset", "time_res", "zoom", "day"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_weights(weights: DataFrame, path: str) -> None:
    """Cache weights under (grid_id, zoom), replacing only the combination being written."""
    (
        weights.repartition("grid_id", "zoom", "cell")
        .sortWithinPartitions("grid_id", "zoom", "cell")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("grid_id", "zoom")
        .parquet(path)
    )


def weights_are_sound(weights: DataFrame) -> bool:
    """Three vertices per cell with weights adding to one; one row reaches the driver."""
    per_cell = weights.groupBy("cell").agg(F.count("*").alias("n"), F.sum("w").alias("s"))
    bad = F.sum(F.when((F.col("n") != 3) | (F.abs(F.col("s") - 1.0) > 1e-6), 1).otherwise(0))
    row = per_cell.agg(F.count("*").alias("cells"), F.coalesce(bad, F.lit(0)).alias("bad")).first()
    return row.cells > 0 and row.bad == 0


def cached_weights(
    spark: SparkSession, path: str, grid_id: str, zoom: int, build, force: bool = False
) -> DataFrame:
    """Weights of (grid_id, zoom) from the cache, or ``build()`` written there first.

    A cache entry is used only if it is for this grid and zoom and passes the soundness check.
    """

    def entry() -> DataFrame:
        return spark.read.parquet(path).filter((F.col("grid_id") == grid_id) & (F.col("zoom") == zoom))

    if not force and path_exists(spark, path):
        try:
            cached = entry()
            if weights_are_sound(cached):
                return cached
            log.warning("cached weights for %s zoom %s are incomplete; building again", grid_id, zoom)
        except Exception as exc:  # unreadable cache: build again, as for a missing one
            log.warning("cannot read cached weights (%s); building again", exc)
    write_weights(build(), path)
    return entry()


def cached_layout(
    spark: SparkSession, path: str, grid_id: str, zoom: int, weights: DataFrame, numbering: gather.Numbering | None = None,
    force: bool = False, lookup_limit: int = gather.BROADCAST_LOOKUP,
) -> gather.Layout:
    """Gather layout of (grid_id, zoom) below ``path``, arranged from ``weights`` and written there first where it is absent.

    One row of facts is written last and marks the entry as whole; it also says what may be broadcast, so that no job
    has to count anything.
    """
    root = f"{path}/{grid_id}/zoom={zoom}"
    if force or not path_exists(spark, f"{root}/facts/_SUCCESS"):
        layout = gather.gather_layout(weights, zoom, numbering=numbering, lookup_limit=lookup_limit)
        layout.cells.repartition("tile").sortWithinPartitions("tile", "cell").write.mode("overwrite").parquet(f"{root}/cells")
        layout.lookup.write.mode("overwrite").parquet(f"{root}/lookup")
        if layout.sizes is not None:
            layout.sizes.coalesce(1).write.mode("overwrite").parquet(f"{root}/sizes")
        by = layout.numbering
        facts = [(layout.lookup_is_small, layout.tile_levels, *((by.stride, by.start, by.side) if by else (None, None, None)))]
        schema = "lookup_is_small boolean, tile_levels int, stride bigint, start bigint, side int"
        spark.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/facts")
    fact = spark.read.parquet(f"{root}/facts").first()
    by = None if fact.side is None else gather.Numbering(fact.stride, fact.start, fact.side)
    cells, lookup = (spark.read.parquet(f"{root}/{name}") for name in ("cells", "lookup"))
    return gather.Layout(zoom, cells, lookup, fact.lookup_is_small, by, spark.read.parquet(f"{root}/sizes") if by else None, fact.tile_levels)


def attributes(zoom: int, original_grid: str, **extra: object) -> dict[str, str]:
    """What a store says about itself: the cells, the grid they were made from, and what else its job did."""
    attrs = {
        "grid_mapping_name": "healpix",
        "healpix_nside": healpix.nside(zoom),
        "healpix_npix": healpix.npix(zoom),
        "healpix_scheme": "nest",
        "zoom": zoom,
        "original_grid": original_grid,
        "remapping_method": "delaunay_triangulation",
        **{k: v for k, v in extra.items() if v is not None},
    }
    return {k: str(v) for k, v in attrs.items()}


def with_attributes(datasets: DataFrame, zoom: int, original_grid: str, **extra: str) -> DataFrame:
    """Attribute row of each data set in a ``(dataset, ...)`` table, kept beside its store."""
    pairs = [F.lit(x) for item in attributes(zoom, original_grid, **extra).items() for x in item]
    return datasets.withColumns({"zoom": F.lit(zoom), "attrs": F.create_map(*pairs)})


def _side_table(store: str) -> tuple[str, str]:
    folder, name = store.rstrip("/").rsplit("/", 1)
    return f"{folder}/_attributes", name.replace("=", "")


def save_attributes(spark: SparkSession, store: str, attrs: dict[str, str]) -> None:
    """Keep a store's attributes in a side table of its folder; a job that runs again replaces its own."""
    root, name = _side_table(store)
    rows = spark.createDataFrame(sorted(attrs.items()), "key string, value string").withColumn("dataset", F.lit(name))
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(root)


def load_attributes(spark: SparkSession, store: str) -> DataFrame:
    """(key, value) of a store; no rows where none were saved."""
    root, name = _side_table(store)
    path = f"{root}/dataset={name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "key string, value string")
    return spark.read.schema("key string, value string").parquet(path)


def stored_attributes(spark: SparkSession, store: str) -> dict[str, str]:
    return {r.key: r.value for r in load_attributes(spark, store).collect()}


def size_report(cube: DataFrame, zoom: int, time_chunk: int = 48) -> DataFrame:
    """Rows, 32-bit value bytes and chunk count per day and tile."""
    fields = value_columns(cube)
    per = cube.groupBy(F.to_date("time").alias("day"), healpix.tile(F.col("cell"), zoom).alias("tile")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("time").alias("steps")
    )
    return per.withColumns(
        {
            "value_bytes": F.col("n_rows") * F.lit(4 * len(fields)),
            "time_chunks": F.ceil(F.col("steps") / time_chunk),
        }
    )
