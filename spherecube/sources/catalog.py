"""File catalogs: which files or stores hold which dates.

A catalog is a DataFrame ``(path, name, bytes, mtime)``. Names carry the dates, so pruning is a
filter over the listing and never opens a data file.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spherecube.functions import names
from spherecube.functions.times import ntz

log = logging.getLogger(__name__)


def _existing(spark: SparkSession, folders: list[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(conf).exists(path):
            found.append(folder)
        else:
            log.warning("folder not found: %s", folder)
    return found


def _empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "path string, name string, bytes bigint, mtime timestamp")


def list_files(spark: SparkSession, folders: list[str], glob: str = "*", recursive: bool = False) -> DataFrame:
    """Catalog of the files in ``folders``; content is never read (the column is pruned)."""
    folders = _existing(spark, folders)
    if not folders:
        return _empty_catalog(spark)
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folders)
    )
    return listing.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("mtime"),
    )


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    system, place = file_system(spark, path)
    system.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file, such as the marker of a finished write."""
    system, place = file_system(spark, path)
    system.create(place, True).close()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob, hidden names such as commit markers included."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in fs.globStatus(path) or [])


def list_store_files(spark: SparkSession, root: str) -> DataFrame:
    """Data files and commit markers of the stores directly under ``root``: (store, name, bytes).

    Spark's own listing leaves out names that start with an underscore, so the markers (one per
    store) come from a glob.
    """
    store = F.element_at(F.split(F.split("path", F.lit(f"/{root.rstrip('/').rsplit('/', 1)[-1]}/")).getItem(1), "/"), 1)
    data = list_files(spark, [root], "*.parquet", recursive=True).select(store.alias("store"), "name", "bytes")
    marks = [(p.rsplit("/", 2)[1], "_SUCCESS", 0) for p in glob_paths(spark, f"{root}/*/_SUCCESS")]
    return data.unionByName(spark.createDataFrame(marks, "store string, name string, bytes bigint"))


def with_file_date(
    catalog: DataFrame, pattern: str = r"\.(\d{8})-", date_format: str = "%Y%m%d"
) -> DataFrame:
    return catalog.withColumn("file_date", names.date_in_name(F.col("name"), pattern, date_format))


def filter_files_by_date(
    catalog: DataFrame, start: dt.datetime, end: dt.datetime, pattern: str, date_format: str
) -> DataFrame:
    """Files whose name date lies in [start, end]; names without a readable date drop out."""
    dated = with_file_date(catalog, pattern, date_format)
    return dated.filter(F.col("file_date").between(ntz(F.lit(start)), ntz(F.lit(end))))


def find_files(
    spark: SparkSession,
    start: dt.datetime,
    end: dt.datetime,
    base_dir: str,
    pattern: str = r"\.(\d{8})-",
    date_format: str = "%Y%m%d",
    year_subdirs: bool = True,
    glob: str = "*",
) -> DataFrame:
    """Date-pruned discovery under ``base_dir/YYYY`` or a flat folder; missing folders warn."""
    names.checked_regex(pattern)
    folders = (
        [f"{base_dir}/{year}" for year in range(start.year, end.year + 1)] if year_subdirs else [base_dir]
    )
    return filter_files_by_date(list_files(spark, folders, glob), start, end, pattern, date_format)


def date_match_report(
    catalog: DataFrame, pattern: str, date_format: str, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """Dry run of a name pattern: how many names match, are out of range or do not match."""
    dated = with_file_date(catalog, pattern, date_format)
    in_range = F.col("file_date").between(ntz(F.lit(start)), ntz(F.lit(end)))
    status = (
        F.when(F.col("file_date").isNull(), "unmatched").when(in_range, "matched").otherwise("out_of_range")
    )
    return dated.groupBy(status.alias("status")).agg(F.count("*").alias("files"))


def month_folders(start: dt.datetime, end: dt.datetime) -> list[str]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def _variables_of_name(variables: list[dict], template: str) -> Column:
    """The requested variables whose file pattern a name fits.

    The dates in the template match anything, and the span regex then reads them. Patterns are
    literals, compiled once; no table of variables is joined.
    """
    fits = []
    for spec in variables:
        glob = template.format(**{**spec, "date_start": "*", "date_end": "*"})
        fits.append(F.when(F.col("name").rlike(names.glob_to_regex(glob)), F.lit(spec["var_name"])))
    return F.array_compact(F.array(*fits))


def span_overlap(start: dt.datetime, end: dt.datetime) -> Column:
    return (F.col("file_start") <= ntz(F.lit(end))) & (F.col("file_end") >= ntz(F.lit(start)))


def variable_span_files(
    catalog: DataFrame,
    variables: list[dict],
    template: str,
    start: dt.datetime,
    end: dt.datetime,
    monthly_files: bool = False,
) -> DataFrame:
    """Per-variable files whose date span overlaps [start, end].

    ``variables`` holds dicts with ``var_name`` and the fields used by ``template``. With
    ``monthly_files`` only the first file of each variable and month folder is kept.
    """
    if not variables:
        raise ValueError("name at least one variable")
    readable = F.col("name").rlike(names.SPAN_DATES)
    spans = catalog.filter(readable).withColumns(
        {
            "file_start": ntz(F.try_to_timestamp(F.regexp_extract("name", names.SPAN_DATES, 1), F.lit("yyyyMMdd"))),
            "file_end": ntz(F.try_to_timestamp(F.regexp_extract("name", names.SPAN_DATES, 2), F.lit("yyyyMMdd"))),
        }
    )
    months = month_folders(start, end)
    folder = F.regexp_extract("path", r"/(\d{6})/[^/]*$", 1)
    hits = (
        spans.withColumn("month", folder)
        .filter(F.col("month").between(months[0], months[-1]))
        .filter(span_overlap(start, end))
        .withColumn("var", F.explode(_variables_of_name(variables, template)))
    )
    if monthly_files:
        first = F.row_number().over(Window.partitionBy("var", "month").orderBy("path"))
        hits = hits.withColumn("_n", first).filter("_n = 1").drop("_n")
    return hits


def find_variable_files(
    spark: SparkSession,
    base_dir: str,
    variables: list[dict],
    template: str,
    start: dt.datetime,
    end: dt.datetime,
    monthly_files: bool = False,
) -> DataFrame:
    """Discovery over ``base_dir/YYYYMM`` folders followed by :func:`variable_span_files`."""
    folders = [f"{base_dir}/{m}" for m in month_folders(start, end)]
    catalog = list_files(spark, folders)
    return variable_span_files(catalog, variables, template, start, end, monthly_files)


def daily_stores(
    catalog: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Stores by the first eight-digit part of their name; undated ones drop out with a range."""
    dated = catalog.withColumn("store_date", names.first_date_token(F.col("name")))
    if start is not None:
        dated = dated.filter(F.col("store_date") >= ntz(F.lit(start)))
    if end is not None:
        dated = dated.filter(F.col("store_date") <= ntz(F.lit(end)))
    return dated


def path_list(catalog: DataFrame) -> list[str]:
    """Sorted paths for ``spark.read``: file names only, the same listing Spark keeps itself."""
    return [row.path for row in catalog.select("path").orderBy("path").toLocalIterator()]
