"""Selecting, indexing and averaging along time."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spherecube.functions.fields import value_columns
from spherecube.functions.times import (
    bin_start,
    interval_seconds,
    ntz,
    parse_date_value,
    seconds_between,
)
from spherecube.session import broadcast_if_small, cut_lineage

log = logging.getLogger(__name__)

# longest time axis that is broadcast (a century of minutes is 53 million steps, of hours 0.9 million)
BROADCAST_STEPS = 2_000_000


# --- selection by clock value -------------------------------------------------------------------


def keep_minute(cube: DataFrame, time_subset: str, time: str = "time") -> DataFrame:
    """Steps near the full hour (``00min``) or the half hour (``30min``), five minutes either way."""
    minute = F.minute(time)
    near = {"00min": (minute <= 5) | (minute >= 55), "30min": minute.between(25, 35)}
    if time_subset not in near:
        raise ValueError(f"time_subset must be '00min' or '30min', not {time_subset!r}")
    return cube.filter(near[time_subset])


def keep_dates(
    cube: DataFrame, start_date: str | None = None, end_date: str | None = None, time: str = "time"
) -> DataFrame:
    """Rows from ``start_date`` to the last second of ``end_date``; either bound may be open."""
    out = cube
    if start_date is not None:
        out = out.filter(F.col(time) >= ntz(F.lit(parse_date_value(start_date))))
    if end_date is not None:
        out = out.filter(F.col(time) <= ntz(F.lit(parse_date_value(end_date, end_of_period=True))))
    return out


def keep_period(cube: DataFrame, start: dt.datetime, end: dt.datetime, time: str = "time") -> DataFrame:
    """Rows from ``start`` to the end of the second ``end``."""
    after = end.replace(microsecond=0) + dt.timedelta(seconds=1)
    return cube.filter((F.col(time) >= ntz(F.lit(start))) & (F.col(time) < ntz(F.lit(after))))


def slice_labels(cube: DataFrame, start: str | None = None, end: str | None = None, time: str = "time") -> DataFrame:
    """Rows between two labels, the whole day, hour or second of the last included."""
    first = parse_date_value(start) if start is not None else dt.datetime(1, 1, 1)
    last = parse_date_value(end, end_of_period=True) if end is not None else dt.datetime(9999, 12, 31, 23, 59, 58)
    return keep_period(cube, first, last, time)


# --- position of a step on the time axis --------------------------------------------------------


def time_index(cube: DataFrame, time: str = "time") -> DataFrame:
    """Distinct times with their zero-based position ``idx`` and the axis length ``n_steps``.

    Counting runs in two levels: steps are numbered inside their day, and days get the number of
    steps before them. The only ungrouped window is over one row per calendar day.
    """
    steps = cube.select(F.col(time).alias("time")).distinct().withColumn("_day", F.to_date("time"))
    days = steps.groupBy("_day").agg(F.count("*").alias("_in_day"))
    so_far = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    days = days.select(
        "_day",
        (F.sum("_in_day").over(so_far) - F.col("_in_day")).alias("_before"),
        F.sum("_in_day").over(whole).alias("n_steps"),
    )
    inside = F.row_number().over(Window.partitionBy("_day").orderBy("time"))
    numbered = steps.withColumn("_pos", inside).join(days, "_day")
    return numbered.select("time", (F.col("_before") + F.col("_pos") - 1).alias("idx"), "n_steps")


def step_size(cube: DataFrame, time_subset: str, time: str = "time") -> int:
    """How many source steps make one ``time_subset``, from the first two steps of the axis."""
    target = interval_seconds(time_subset)
    first_two = cube.select(time).distinct().orderBy(time).limit(2).collect()
    if len(first_two) < 2:
        raise ValueError("need at least two time steps to tell the resolution")
    spacing = (first_two[1][0] - first_two[0][0]).total_seconds()
    step = int(target / spacing)
    if step < 1:
        raise ValueError(f"{time_subset} is finer than the data ({spacing:g} s)")
    if target % spacing:
        log.warning("%s is no multiple of the %g s step; taking every %d steps", time_subset, spacing, step)
    return step


def every_nth(cube: DataFrame, step: int, time: str = "time") -> DataFrame:
    """Steps 0, step, 2*step ... of the time axis, unchanged."""
    if step < 1:
        raise ValueError("step must be at least 1")
    if step == 1:
        return cube
    kept = time_index(cube, time).filter(F.col("idx") % step == 0).select(F.col("time").alias(time))
    return cube.join(broadcast_if_small(kept, BROADCAST_STEPS), time, "left_semi")


def every_interval(cube: DataFrame, time_subset: str, time: str = "time") -> DataFrame:
    """Every Nth step so that kept steps are ``time_subset`` apart (no averaging)."""
    return every_nth(cube, step_size(cube, time_subset, time), time)


def step_at(cube: DataFrame, index: int, time: str = "time") -> DataFrame:
    """The rows of one step by position; negative positions count from the end."""
    axis = time_index(cube, time)
    wanted = F.col("idx") == (index if index >= 0 else F.col("n_steps") + index)
    picked = axis.filter(wanted).select(F.col("time").alias(time))
    return cube.join(broadcast_if_small(picked, 1), time, "left_semi")


# --- averages -----------------------------------------------------------------------------------


def _bin_origin(cube: DataFrame, seconds: int, offset: int, time: str) -> int:
    """Bins start at midnight of the first day plus ``offset``.

    That equals bins counted from 1970 whenever they divide the day; only otherwise is the first
    time looked up (one value).
    """
    if 86400 % seconds == 0:
        return offset % seconds
    first = cube.agg(F.min(time)).first()[0]
    if first is None:
        return offset % seconds
    midnight = (first.date() - dt.date(1970, 1, 1)).days * 86400
    return (midnight + offset) % seconds


def resample_mean(
    cube: DataFrame,
    freq: str,
    keys: list[str],
    offset_hours: int = 0,
    fill: bool = False,
    values: list[str] | None = None,
    time: str = "time",
) -> DataFrame:
    """Mean per left-labelled, left-closed time bin and key; missing values are skipped.

    One hash aggregation with partial sums before the shuffle, so a hot bin or cell costs one
    partial row per task. ``fill=True`` adds the empty bins between the first and last bin of the
    data as NULL rows for every key.
    """
    seconds = interval_seconds(freq)
    origin = _bin_origin(cube, seconds, offset_hours * 3600, time)
    values = values or [c for c in value_columns(cube) if c not in keys]
    binned = cube.withColumn("_bin", bin_start(F.col(time), seconds, origin))
    means = binned.groupBy(F.col("_bin").alias(time), *keys).agg(*[F.avg(v).alias(v) for v in values])
    if not fill:
        return means
    # written once: the axis, the keys and the result are all taken from the means, and the cube is read once
    means = cut_lineage(means)
    return means.unionByName(empty_bins(means.select(time, *keys), seconds, time), allowMissingColumns=True)


def empty_bins(binned: DataFrame, seconds: int, time: str = "time") -> DataFrame:
    """Key rows for every bin between the first and last that no row fell into.

    Each bin that is there knows the one before it, and a generator makes the bins between the two. They meet the keys
    where the rows are made; a gap list is broadcast after it has been counted.
    """
    keys = [c for c in binned.columns if c != time]
    step = F.expr(f"INTERVAL {seconds} SECONDS")
    walked = with_previous(binned.select(time).distinct(), time, time, F.to_date(time), "_previous")
    holes = walked.filter(F.col("_previous") + step < F.col(time))
    gaps = holes.select(F.explode(F.sequence(F.col("_previous") + step, F.col(time) - step, step)).alias(time))
    if not keys:
        return gaps
    return binned.select(*keys).distinct().crossJoin(broadcast_if_small(gaps, BROADCAST_STEPS)).select(time, *keys)


def temporal_average(
    cube: DataFrame, time_average: str | None, keys: list[str], fill: bool = True
) -> DataFrame:
    """Average to ``time_average`` (``1h``, ``3h``, ``1d`` ...); None leaves the cube alone."""
    return cube if time_average is None else resample_mean(cube, time_average, keys, fill=fill)


def target_hours_mean(
    cube: DataFrame, target_hours: list[int], keys: list[str], fill: bool = True
) -> DataFrame:
    """Resample so that bins start at the given hours of the day (first two define the width)."""
    if len(target_hours) < 2:
        raise ValueError("target_hours needs at least two hours")
    width = target_hours[1] - target_hours[0]
    return resample_mean(cube, f"{width}h", keys, offset_hours=target_hours[0], fill=fill)


def misaligned_hours(cube: DataFrame, target_hours: list[int], time: str = "time") -> DataFrame:
    """Output hours that are not among the wanted ones."""
    hours = cube.select(F.hour(time).alias("hour")).distinct()
    return hours.filter(~F.col("hour").isin(list(target_hours)))


def block_mean(
    cube: DataFrame, factor: int, keys: list[str], values: list[str] | None = None, time: str = "time"
) -> DataFrame:
    """Mean of ``factor`` consecutive steps, labelled by the first; an incomplete tail is dropped."""
    if factor <= 1:
        return cube
    values = values or [c for c in value_columns(cube) if c not in keys]
    axis = time_index(cube, time)
    axis = axis.withColumn("_block", F.floor(F.col("idx") / factor))
    axis = axis.filter((F.col("_block") + 1) * factor <= F.col("n_steps"))
    starts = axis.filter(F.col("idx") % factor == 0).select("_block", F.col("time").alias("_start"))
    lookup = axis.join(starts, "_block").select(F.col("time").alias(time), "_start")
    return (
        cube.join(broadcast_if_small(lookup, BROADCAST_STEPS), time)
        .groupBy(F.col("_start").alias(time), *keys)
        .agg(*[F.avg(v).alias(v) for v in values])
    )


def with_previous(rows: DataFrame, order: str | Column, value: str, bucket: Column, name: str) -> DataFrame:
    """Add the ``value`` of the row before in ``order``, across the whole table.

    The window runs inside ``bucket`` (any non-decreasing function of ``order``); the first row of a
    bucket takes the last value of the bucket before, from a table with one row per bucket.
    """
    rows = rows.withColumn("_b", bucket)
    ends = rows.groupBy("_b").agg(F.max_by(value, order).alias("_end"))
    ends = ends.select("_b", F.lag("_end").over(Window.orderBy("_b")).alias("_carried"))
    inside = F.lag(value).over(Window.partitionBy("_b").orderBy(order))
    return (
        rows.withColumn("_before", inside)
        .join(ends, "_b")
        .withColumn(name, F.coalesce("_before", "_carried"))
        .drop("_b", "_before", "_carried")
    )


def with_previous_in_ranges(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """:func:`with_previous` for any order: range partitions carry their last value over to the next.

    The table is sorted into ranges of rows by a sample and fixed there. Windows run inside a range; the only ungrouped one
    is over a row per range, as many as the session has shuffle partitions, however long the table is.
    """
    ranged = cut_lineage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    return with_previous(ranged, F.struct(*order), value, F.col("_range"), name).drop("_range")


def step_spacing(cube: DataFrame, time: str = "time") -> DataFrame:
    """Seconds between consecutive distinct steps (NULL for the first)."""
    steps = cube.select(F.col(time).alias("time")).distinct()
    both = with_previous(steps, "time", "time", F.to_date("time"), "_previous")
    return both.select("time", seconds_between(F.col("_previous"), F.col("time")).alias("spacing_s"))
