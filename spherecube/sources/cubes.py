"""Reading gridded tables and checking that a read is whole."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spherecube.functions.fields import missing_to_null

log = logging.getLogger(__name__)


def read_cube(
    spark: SparkSession, paths: list[str], schema: T.StructType | str | None = None, recursive: bool = False
) -> DataFrame:
    """Concatenate the files along time.

    Rows of every file are kept, repeated steps included. Files may differ in their variables: a
    variable absent from a file is NULL for its rows. NaN becomes NULL on the way in.
    ``recursive`` reads whole stores as one scan, without their partition columns.
    """
    if not paths:
        raise ValueError("no files for the requested period")
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return missing_to_null(reader.parquet(*paths))


def concat_time(cubes: list[DataFrame]) -> DataFrame:
    """Union of cubes that share keys, columns matched by name, duplicates kept."""
    if not cubes:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cubes)


def _verdict(steps, files):
    return F.when(steps < files, "incomplete").when(steps > files, "more_steps_than_files").otherwise("complete")


def load_report(cube: DataFrame, file: str = "source_file") -> DataFrame:
    """Number of time steps against number of files, and the verdict on the read.

    Fewer steps than files means that some file was not read in full.
    """
    per_file = cube.groupBy(file).agg(F.countDistinct("time").alias("n"))
    counts = per_file.agg(F.sum("n").cast("bigint").alias("steps"), F.count("*").alias("files"))
    return counts.withColumn("verdict", _verdict(F.col("steps"), F.col("files")))


def steps_of_files(spark: SparkSession, paths: list[str], recursive: bool = False) -> DataFrame:
    """(source_file, time) of every step of every file: the files are told apart by Spark's own file metadata, and the
    time column is all that is read of them."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    return reader.parquet(*paths).select(F.col("_metadata.file_path").alias("source_file"), "time").distinct()


def file_report(spark: SparkSession, paths: list[str]) -> DataFrame:
    """:func:`load_report` for files on storage. Files without a single row count as files too."""
    found = steps_of_files(spark, paths).agg(F.count("*").alias("steps"))
    return found.select("steps", F.lit(len(paths)).cast("bigint").alias("files")).withColumn("verdict", _verdict(F.col("steps"), F.col("files")))


def _refuse_incomplete(row) -> None:
    if row.verdict == "incomplete":
        raise ValueError(f"read only {row.steps} time steps from {row.files} files")
    if row.verdict != "complete":
        log.warning("%s time steps from %s files", row.steps, row.files)


def require_complete(cube: DataFrame, file: str = "source_file") -> DataFrame:
    """Raise when the load report finds fewer steps than files; one row reaches the driver."""
    _refuse_incomplete(load_report(cube, file).first())
    return cube


def require_complete_files(spark: SparkSession, paths: list[str]) -> None:
    """Raise before any work is done when the files hold fewer steps than there are files."""
    _refuse_incomplete(file_report(spark, paths).first())


def merge_variables(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Outer merge of per-variable cubes on their keys.

    A column already given by an earlier part is not taken from a later one. One union and one
    aggregation on the keys replace a chain of outer joins: a single shuffle for any number of
    variables, with partial aggregation before it. Two values of one variable under one key are an
    error: merged rows could hold only one of them.
    """
    taken: set[str] = set(keys)
    pieces = []
    for name, part in parts.items():
        if part is None:
            log.warning("variable %s has no files and is left out", name)
            continue
        fresh = [c for c in part.columns if c not in taken]
        taken.update(fresh)
        pieces.append(part.select(*keys, *fresh))
    stacked = concat_time(pieces)
    fields = [c for c in stacked.columns if c not in keys]
    twice = F.raise_error(F.lit("a variable has several values under one key"))
    return stacked.groupBy(*keys).agg(*[F.when(F.count(c) > 1, twice).otherwise(F.any_value(c, ignoreNulls=True)).alias(c) for c in fields])


def read_variables(
    spark: SparkSession, files: dict[str, list[str]], keys: list[str], combine: bool = True,
    select: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Read one file list per variable and merge them.

    ``select`` picks rows of each variable by itself, so that the merge shuffles only what is kept.
    """
    if not combine:
        raise ValueError("several file lists given; pass combine=True to merge their variables")
    parts = {v: read_cube(spark, paths) if paths else None for v, paths in files.items()}
    if select is not None:
        parts = {v: part if part is None else select(part) for v, part in parts.items()}
    return merge_variables(parts, keys)


def scan_catalog_table(
    table: DataFrame, dataset: str, zoom: int | None = None, time_res: str | None = None
) -> DataFrame:
    """Rows of one source in a table partitioned by (dataset, zoom, time_res): partition pruning."""
    out = table.filter(F.col("dataset") == dataset)
    if zoom is not None:
        out = out.filter(F.col("zoom") == zoom)
    if time_res is not None:
        out = out.filter(F.col("time_res") == time_res)
    return out


def scan_catalog(
    spark: SparkSession, root: str, dataset: str, zoom: int | None = None, time_res: str | None = None
) -> DataFrame:
    return scan_catalog_table(spark.read.parquet(root), dataset, zoom, time_res)


def scan_requests(spark: SparkSession, root: str, requests: DataFrame) -> DataFrame:
    """Rows of a stored catalog that a table of requests asks for, by any of (dataset, time_res, zoom, day).

    Requests are few and broadcast; their values prune the partitions of the scan at run time.
    """
    table = spark.read.parquet(root)
    keys = [c for c in ("dataset", "time_res", "zoom", "day") if c in requests.columns]
    # comparisons, true of every key that is there, tell the optimizer that the requests are a selection
    least = {"dataset": "''", "time_res": "''", "zoom": "0", "day": "date'0001-01-01'"}
    wanted = requests.select(*keys).filter(" and ".join(f"{c} >= {least[c]}" for c in keys)).distinct()
    return table.join(F.broadcast(wanted), keys, "left_semi")
