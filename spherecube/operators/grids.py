"""Source grids as tables of points ``(src_idx, iy, ix, lon, lat)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATLON_1D, LATLON_2D, UNSTRUCTURED = "latlon_1d", "latlon_2d", "unstructured"


def grid_kind(lon_rank: int, lat_rank: int, dims: list[str]) -> str:
    """Grid type from the rank of its coordinates and the dimension names."""
    if lon_rank == lat_rank == 1:
        return UNSTRUCTURED if {"ncol", "cell"} & set(dims) else LATLON_1D
    if lon_rank == lat_rank == 2:
        return LATLON_2D
    raise ValueError(f"cannot tell the grid type from ranks lon={lon_rank}, lat={lat_rank}")


def detect_kind(points: DataFrame) -> str:
    """Grid type from the points themselves, whatever columns they have.

    Regular: every ``iy`` has one latitude, every ``ix`` one longitude, none is NULL and all pairs are there. Positions
    without that make a curvilinear grid, points without positions an unstructured one.
    """
    if not {"iy", "ix"} <= set(points.columns):
        return UNSTRUCTURED
    facts = points.agg(
        F.count("*").alias("n"), F.count(F.when(F.col("iy").isNull() | F.col("ix").isNull(), 1)).alias("unplaced"),
        F.countDistinct("iy").alias("ny"), F.countDistinct("ix").alias("nx"),
    ).first()
    if facts.unplaced:
        return UNSTRUCTURED
    rows, columns = axis_table(points, "iy", "lat").count(), axis_table(points, "ix", "lon").count()
    regular = (rows, columns) == (facts.ny, facts.nx) and facts.n == facts.nx * facts.ny and min(facts.nx, facts.ny) > 1
    return LATLON_1D if regular else LATLON_2D


def flat_index(iy: Column, ix: Column, nx: Column | int) -> Column:
    """Row-major position: y runs slowest whatever the order of the stored dimensions."""
    return (iy * nx + ix).cast("bigint")


def points_from_axes(lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """Mesh of a latitude axis ``(iy, lat)`` and a longitude axis ``(ix, lon)``.

    Each latitude row is expanded over ``0..nx-1`` by a generator and looks its longitude up by
    index. The number of longitudes enters as a scalar subquery.
    """
    nx = lon_axis.agg(F.count("*").alias("nx")).scalar()
    rows = lat_axis.select("iy", "lat", nx.alias("_nx"))
    rows = rows.select(
        "iy", "lat", "_nx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_nx") - 1)).alias("ix")
    )
    return rows.join(lon_axis.withColumn("ix", F.col("ix").cast("bigint")), "ix").select(
        flat_index(F.col("iy"), F.col("ix"), F.col("_nx")).alias("src_idx"), "iy", "ix", "lon", "lat"
    )


def points_from_2d(coords: DataFrame, nx: int) -> DataFrame:
    """Curvilinear coordinates ``(iy, ix, lon, lat)`` with their flattened index."""
    return coords.select(
        flat_index(F.col("iy"), F.col("ix"), nx).alias("src_idx"), "iy", "ix", "lon", "lat"
    )


def points_from_columns(coords: DataFrame, index: str = "ncol") -> DataFrame:
    """Unstructured coordinates: one row per column, index kept. Half-filled rows are an error."""
    half = F.col("lon").isNull() != F.col("lat").isNull()
    checked = F.when(half, F.raise_error(F.lit("lon and lat differ in length"))).otherwise(F.col("lon"))
    return coords.select(
        F.col(index).cast("bigint").alias("src_idx"),
        F.lit(None).cast("bigint").alias("iy"),
        F.lit(None).cast("bigint").alias("ix"),
        checked.alias("lon"),
        "lat",
    )


def axis_table(points: DataFrame, position: str, value: str) -> DataFrame:
    """One axis of a regular grid: distinct (position, value)."""
    return points.select(position, value).distinct()


def grid_summary(points: DataFrame) -> DataFrame:
    """Size, extent, mean axis spacing and whether the grid goes round the sphere."""

    def mean_spacing(value: str) -> DataFrame:
        ends = points.select(value).distinct().agg(
            F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n")
        )
        # consecutive differences of a sorted axis add up to its length
        return ends.select(F.when(F.col("n") > 1, (F.col("hi") - F.col("lo")) / (F.col("n") - 1)))

    base = points.agg(
        F.count("*").alias("n_points"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
    )
    return base.select(
        "*",
        mean_spacing("lon").scalar().alias("dlon"),
        mean_spacing("lat").scalar().alias("dlat"),
        F.when(F.col("lon_max") - F.col("lon_min") >= 359, "global").otherwise("regional").alias("extent"),
    )


def shifted_copies(points: DataFrame, lon: str = "lon") -> DataFrame:
    """Each point at lon-360, lon and lon+360; the copy number is 0, 1 or 2."""
    copies = F.array(*[F.lit(s) for s in (-360.0, 0.0, 360.0)])
    out = points.select("*", F.posexplode(copies).alias("copy", "_shift"))
    return out.withColumn(lon, F.col(lon) + F.col("_shift")).drop("_shift")


def slice_sizes(cube: DataFrame, points: DataFrame) -> DataFrame:
    """Time steps whose number of points differs from the grid."""
    per_step = cube.groupBy("time").agg(F.countDistinct("src_idx").alias("n_points"))
    expected = points.agg(F.count("*").alias("n")).scalar()
    return per_step.withColumn("n_expected", expected).filter("n_points <> n_expected")


def axis_intervals(axis: DataFrame, value: str, position: str) -> DataFrame:
    """Neighbouring axis values as intervals ``(lo, hi, pos_lo, pos_hi)``, sorted by value.

    Runs over one axis of a grid (thousands of values), never over its points.
    """
    order = Window.orderBy(value)
    step = axis.select(
        F.col(value).alias("lo"),
        F.lead(value).over(order).alias("hi"),
        F.col(position).alias("pos_lo"),
        F.lead(position).over(order).alias("pos_hi"),
    )
    return step.filter("hi > lo")
