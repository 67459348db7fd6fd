"""Vertical levels."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

LEVEL_TOLERANCE = 0.01


def match_levels(levels: DataFrame, wanted: list[float], level: str = "level") -> DataFrame:
    """First level within the tolerance of each request: ``(level_order, level, requested)``.

    The request list is a literal array, so each distinct level is compared with it in place; a
    level requested twice comes out twice.
    """
    request = F.array(
        *[
            F.struct(F.lit(i).alias("level_order"), F.lit(float(v)).alias("requested"))
            for i, v in enumerate(wanted)
        ]
    )
    close = F.filter(request, lambda r: F.abs(F.col(level) - r["requested"]) < LEVEL_TOLERANCE)
    hits = levels.select(level).distinct().select(level, F.explode(close).alias("_r"))
    nearest_first = Window.partitionBy("level_order").orderBy(level)
    return (
        hits.select(level, "_r.level_order", "_r.requested")
        .withColumn("_n", F.row_number().over(nearest_first))
        .filter("_n = 1")
        .drop("_n")
    )


def keep_levels(
    cube: DataFrame, wanted: list[float], level: str = "level", levels: DataFrame | None = None
) -> DataFrame:
    """Rows of the wanted levels with ``level_order`` giving their place in the request.

    ``levels`` may name the level axis when it is known (a side table); otherwise it is the
    distinct levels of the cube, a scan of that column alone. The matched table has at most one
    row per request, hence the broadcast.
    """
    if level not in cube.columns:
        raise ValueError(f"no vertical coordinate {level!r}; columns are {cube.columns}")
    if not wanted:
        raise ValueError("the level request is empty")
    matched = match_levels(levels if levels is not None else cube, wanted, level)
    return cube.join(F.broadcast(matched.select(level, "level_order")), level)


def missing_levels(cube: DataFrame, wanted: list[float], level: str = "level") -> DataFrame:
    """Requested values that no level matches."""
    asked = cube.sparkSession.createDataFrame([(float(v),) for v in wanted], "requested double")
    found = match_levels(cube, wanted, level).select("requested")
    return asked.join(F.broadcast(found), "requested", "left_anti")


def keep_levels_checked(cube: DataFrame, wanted: list[float], level: str = "level") -> DataFrame:
    """As :func:`keep_levels`, but warns of missing levels and fails when none is found."""
    if level not in cube.columns:
        raise ValueError(f"no vertical coordinate {level!r}; columns are {cube.columns}")
    absent = [row.requested for row in missing_levels(cube, wanted, level).collect()]
    if len(set(absent)) == len(set(map(float, wanted))):
        raise ValueError(f"none of the requested levels exist: {wanted}")
    if absent:
        log.warning("levels not in the data: %s", absent)
    return keep_levels(cube, wanted, level)
