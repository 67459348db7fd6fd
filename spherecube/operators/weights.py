"""Interpolation weights from a source grid to cell centres: three vertices per cell.

Weights tables are ``(grid_id, zoom, cell, k, src_idx, w)`` and list valid cells only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.operators.grids import axis_intervals, axis_table

# cells this close (degrees) outside the outermost grid lines count as lying on them
EDGE = 1e-9
# interval tables of axes up to this length are broadcast, longer ones are joined by shuffle
BROADCAST_AXIS = 100_000


def longitude_frame(lon: Column, start: float) -> Column:
    """Shift a longitude by whole turns into the window that begins at ``start``."""
    turns = F.floor((lon - F.lit(start - EDGE)) / 360.0)
    return lon - turns * 360.0


def _snap(value: Column, lo: float, hi: float) -> Column:
    return (
        F.when(value.between(lo - EDGE, lo), F.lit(lo)).when(value.between(hi, hi + EDGE), F.lit(hi)).otherwise(value)
    )


def _bucketed(intervals: DataFrame, origin: float, width: float) -> DataFrame:
    """Repeat each interval for the equal-width buckets it touches (about two on a uniform axis)."""
    first = F.floor((F.col("lo") - origin) / width)
    last = F.floor((F.col("hi") - origin) / width)
    return intervals.withColumn("_bucket", F.explode(F.sequence(first, last)))


def _locate(targets: DataFrame, intervals: DataFrame, value: Column, axis: str, bounds, small: bool) -> DataFrame:
    """Equi-join targets to the axis interval that holds them, and keep the fraction inside it.

    A value on a shared edge belongs to the upper interval, the last edge to the last interval.
    """
    origin, end, width = bounds
    table = _bucketed(intervals, origin, width).select(
        "_bucket", *[F.col(c).alias(f"_{axis}_{c}") for c in ("lo", "hi", "pos_lo", "pos_hi")]
    )
    lo, hi = F.col(f"_{axis}_lo"), F.col(f"_{axis}_hi")
    inside = (value >= lo) & ((value < hi) | ((value == hi) & (hi == F.lit(end))))
    return (
        targets.withColumn("_bucket", F.floor((value - origin) / width))
        .join(F.broadcast(table) if small else table, "_bucket")
        .filter(inside)
        .withColumn(f"_{axis}_f", (value - lo) / (hi - lo))
        .drop("_bucket", f"_{axis}_lo", f"_{axis}_hi")
    )


def regular_weights(
    points: DataFrame, zoom: int, grid_id: str, wrap: bool | None = None, cells: DataFrame | None = None
) -> DataFrame:
    """Weights from a regular latitude/longitude grid.

    The four corners of a grid rectangle lie on one circle, so either diagonal is a Delaunay
    edge; the south-west to north-east one is used throughout. Locating a cell is a lookup in the
    two axis tables, broadcast up to ``BROADCAST_AXIS`` values. ``src_idx`` is the points' own: where it is
    a linear function of the positions it is computed, so that nothing as large as the grid or the cells is
    shuffled; otherwise vertices look it up by position. ``wrap=None`` closes the circle when the longitudes
    plus one spacing span 360 degrees. Cells outside the grid get no rows.
    """
    spark = points.sparkSession
    points = points.withColumns({c: F.col(c).cast("double") for c in ("lon", "lat")})
    lat_axis, lon_axis = axis_table(points, "iy", "lat"), axis_table(points, "ix", "lon")
    lat_stats, lon_stats = [
        axis.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count("*").alias("n")).first()
        for axis, v in ((lat_axis, "lat"), (lon_axis, "lon"))
    ]
    small = max(lat_stats.n, lon_stats.n) <= BROADCAST_AXIS
    if min(lat_stats.n, lon_stats.n) < 2:
        raise ValueError("a regular grid needs two values on each axis")
    dlat = (lat_stats.hi - lat_stats.lo) / (lat_stats.n - 1)
    dlon = (lon_stats.hi - lon_stats.lo) / (lon_stats.n - 1)
    if wrap is None:
        wrap = lon_stats.hi - lon_stats.lo + dlon >= 360.0 - 1e-6

    lat_steps = axis_intervals(lat_axis, "lat", "iy")
    lon_steps = axis_intervals(lon_axis, "lon", "ix")
    lon_end = lon_stats.hi
    if wrap and lon_stats.lo + 360.0 > lon_stats.hi + 1e-9:
        lon_end = lon_stats.lo + 360.0
        seam = lon_axis.agg(
            F.max("lon").alias("lo"),
            F.lit(lon_end).alias("hi"),
            F.max_by("ix", "lon").alias("pos_lo"),
            F.min_by("ix", "lon").alias("pos_hi"),
        )
        lon_steps = lon_steps.unionByName(seam)

    targets = healpix.with_cell_centers(cells if cells is not None else healpix.all_cells(spark, zoom), zoom)
    lon_in_frame = longitude_frame(F.col("lon"), lon_stats.lo)
    targets = targets.select(
        "cell",
        _snap(F.col("lat"), lat_stats.lo, lat_stats.hi).alias("lat"),
        (lon_in_frame if wrap else _snap(lon_in_frame, lon_stats.lo, lon_stats.hi)).alias("lon"),
    )
    found = _locate(targets, lon_steps, F.col("lon"), "x", (lon_stats.lo, lon_end, dlon), small)
    found = _locate(found, lat_steps, F.col("lat"), "y", (lat_stats.lo, lat_stats.hi, dlat), small)

    u, v = F.col("_x_f"), F.col("_y_f")

    def corner(k: int, y: str, x: str, w: Column) -> Column:
        place = [F.col(f"_y_pos_{y}").cast("bigint").alias("iy"), F.col(f"_x_pos_{x}").cast("bigint").alias("ix")]
        return F.struct(F.lit(k).alias("k"), *place, w.alias("w"))

    lower = F.array(corner(0, "lo", "lo", 1 - u), corner(1, "lo", "hi", u - v), corner(2, "hi", "hi", v))
    upper = F.array(corner(0, "lo", "lo", 1 - v), corner(1, "hi", "lo", v - u), corner(2, "hi", "hi", u))
    vertices = found.select("cell", F.inline(F.when(v <= u, lower).otherwise(upper)))
    linear = linear_index(points)
    if linear is not None:
        vertices = vertices.withColumn("src_idx", F.col("iy") * F.lit(linear[0]) + F.col("ix") + F.lit(linear[1]))
    else:
        own = points.select(F.col("iy").cast("bigint").alias("iy"), F.col("ix").cast("bigint").alias("ix"), "src_idx")
        vertices = vertices.join(own, ["iy", "ix"], "left")
    return vertices.select(
        F.lit(grid_id).alias("grid_id"), F.lit(zoom).alias("zoom"), "cell", "k", "src_idx", "w"
    )


def linear_index(points: DataFrame) -> tuple[int, int] | None:
    """(stride, start) with src_idx = iy * stride + ix + start for every point, if there are such numbers."""
    place = F.struct("src_idx", "iy", "ix")
    ends = points.agg(F.min_by(place, "iy").alias("low"), F.max_by(place, "iy").alias("high")).first()
    rows = ends.high.iy - ends.low.iy
    rise = (ends.high.src_idx - ends.high.ix) - (ends.low.src_idx - ends.low.ix)
    if not rows or rise % rows:
        return None
    stride = rise // rows
    start = ends.low.src_idx - ends.low.ix - ends.low.iy * stride
    odd = points.filter(~F.col("src_idx").eqNullSafe(F.col("iy") * F.lit(stride) + F.col("ix") + F.lit(start)))
    return (int(stride), int(start)) if odd.isEmpty() else None


def grid_fingerprint(points: DataFrame) -> str:
    """Identifier of a grid from its points, independent of row order."""
    row = points.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("src_idx", "lon", "lat")).alias("h")
    ).first()
    return f"g{row.n}_{row.h & 0xFFFFFFFFFFFFFFFF:016x}"


def weights_fit_grid(weights: DataFrame, points: DataFrame) -> DataFrame:
    """Check before a remap: three weights a cell, each on a point that the grid has. One row, ``fits`` never NULL."""
    n_points = points.agg(F.count("*").alias("n")).scalar()
    used = weights.agg(
        F.max("src_idx").alias("max_src_idx"),
        F.countDistinct("cell").alias("valid_cells"),
        F.count("*").alias("weight_rows"),
    )
    unknown = weights.select("src_idx").distinct().join(points.select("src_idx"), weights["src_idx"] == points["src_idx"], "left_anti")
    n_unknown = unknown.agg(F.count("*").alias("n")).scalar()
    return used.withColumn("n_points", n_points).withColumn("_unknown", n_unknown).withColumn(
        "fits", (F.col("_unknown") == 0) & (F.col("weight_rows") == 3 * F.col("valid_cells")),
    ).drop("_unknown")


def require_fit(weights: DataFrame, points: DataFrame) -> DataFrame:
    """Raise where :func:`weights_fit_grid` says no; one row reaches the driver."""
    row = weights_fit_grid(weights, points).first()
    if not row.fits:
        raise ValueError(f"weights do not fit the grid: {row.weight_rows} weights of {row.valid_cells} cells on {row.n_points} points")
    return weights


def one_per_location(points: DataFrame) -> DataFrame:
    """Drop repeated positions, keeping the lowest index (two triangles cannot share a point)."""
    return points.groupBy("lon", "lat").agg(F.min("src_idx").alias("src_idx"))
