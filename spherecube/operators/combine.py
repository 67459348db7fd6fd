"""Putting cubes together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions.fields import value_columns
from spherecube.operators.gather import BROADCAST_CELLS
from spherecube.session import broadcast_if_small


def merge_surface_levels(surface: DataFrame, levels: DataFrame) -> DataFrame:
    """Outer merge of surface and level cubes on (time, cell).

    Surface values repeat for every level of their cell. A variable that both carry is taken from
    the surface cube.
    """
    keys = ["time", "cell"]
    shared = set(value_columns(surface)) & set(value_columns(levels))
    return surface.join(levels.drop(*shared), keys, "full_outer")


def _profile(cube: DataFrame, name: str) -> DataFrame:
    times = cube.select("time").distinct().agg(
        F.min("time").alias("t_min"), F.max("time").alias("t_max"), F.count("*").alias("n_times")
    )
    cells = cube.select("cell").distinct().agg(F.count("*").alias("n_cells"))
    return times.withColumns({"side": F.lit(name), "n_cells": cells.scalar()})


def premerge_checks(surface: DataFrame, levels: DataFrame) -> DataFrame:
    """What speaks against merging: rows ``(check, severity, ok)``, all from two one-row profiles."""
    both = _profile(surface, "surface").unionByName(_profile(levels, "levels"))

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    facts = both.agg(
        ((of("surface", "t_min") <= of("levels", "t_max")) & (of("levels", "t_min") <= of("surface", "t_max"))).alias("overlap"),
        (of("surface", "n_times") == of("levels", "n_times")).alias("same_steps"),
        (of("surface", "n_cells") == of("levels", "n_cells")).alias("same_cells"),
    )
    shared = set(value_columns(surface)) & set(value_columns(levels))
    checks = [
        ("time_ranges_overlap", "error", F.col("overlap")),
        ("equal_cell_count", "error", F.col("same_cells")),
        ("no_shared_variables", "error", F.lit(not shared)),
        ("equal_step_count", "warning", F.col("same_steps")),
        ("has_level", "warning", F.lit("level" in levels.columns)),
    ]
    rows = F.array(
        *[F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), ok.alias("ok")) for c, s, ok in checks]
    )
    return facts.select(F.inline(rows))


def require_mergeable(surface: DataFrame, levels: DataFrame) -> None:
    """Raise on the failed error checks (five rows reach the driver)."""
    failed = [r.check for r in premerge_checks(surface, levels).filter("severity = 'error' and not ok").collect()]
    if failed:
        raise ValueError(f"cubes cannot be merged: {', '.join(failed)}")


def attach_static(cube: DataFrame, static: DataFrame, fields: list[str], key: str = "cell") -> DataFrame:
    """Add time-independent fields of another cube (one row per cell) to every step."""
    return cube.join(broadcast_if_small(static.select(key, *fields), BROADCAST_CELLS), key, "left")


def shared_names(a: DataFrame, b: DataFrame) -> DataFrame:
    """Variable names both cubes carry, from ``(var)`` tables."""
    return a.select("var").intersect(b.select("var"))


def absent_names(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return expected.select("var").exceptAll(actual.select("var").distinct())
