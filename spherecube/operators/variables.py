"""Choosing and renaming variables.

Wide cubes have one column per variable. The exchange form ``cube_long`` has rows
``(dataset, var, dims, time, level, src_idx, value)``; there the same choices are row filters.
"""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions.fields import KEY_COLUMNS
from spherecube.functions.names import BOUNDS_SUFFIX, glob_to_regex
from spherecube.session import broadcast_if_small

log = logging.getLogger(__name__)

MAX_LEVELS = 100_000


def select_rename(cube: DataFrame, renames: dict[str, str], passthrough: list[str] | None = None) -> DataFrame:
    """Keep and rename the listed variables that exist, plus passthrough ones.

    When none exists the cube comes back unchanged, with a warning.
    """
    kept = [v for v in renames if v in cube.columns]
    through = [v for v in passthrough or [] if v in cube.columns and v not in KEY_COLUMNS and v not in kept]
    if not kept and not through:
        log.warning("none of %s in the cube; nothing selected", list(renames))
        return cube
    keys = [c for c in cube.columns if c in KEY_COLUMNS]
    return cube.select(*keys, *[F.col(v).alias(renames[v]) for v in kept], *through)


def select_rename_strict(cube: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Keep and rename exactly these columns, keys included; a missing one fails in analysis."""
    return cube.select(*[F.col(old).alias(new) for old, new in renames.items()])


def _matches_any(name: Column, globs: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [name.rlike(glob_to_regex(g)) for g in globs], F.lit(False))


def drop_skipped(long: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """Remove variables that match a wildcard, and cell-boundary variables always."""
    return long.filter(~_matches_any(F.col("var"), skip or []) & ~F.col("var").rlike(BOUNDS_SUFFIX))


def drop_skipped_columns(cube: DataFrame, skip: list[str] | None = None) -> DataFrame:
    patterns = [glob_to_regex(g) for g in skip or []] + [BOUNDS_SUFFIX]
    gone = [c for c in cube.columns if c not in KEY_COLUMNS and any(re.search(p, c) for p in patterns)]
    return cube.drop(*gone)


def with_required_dims(long: DataFrame, required: list[list[str]] | None) -> DataFrame:
    """Variables whose dimensions include all of at least one required set."""
    if required is None:
        return long
    sets = F.array(*[F.array(*[F.lit(d) for d in dims]) for dims in required])
    return long.filter(F.exists(sets, lambda r: F.size(F.array_except(r, F.col("dims"))) == 0))


def with_spatial_dims(long: DataFrame, x: str, y: str | None = None) -> DataFrame:
    """Variables on the sphere: the x dimension, and the y dimension for two-dimensional grids."""
    return long.filter(_spatial(x, y))


def without_spatial_dims(long: DataFrame, x: str, y: str | None = None) -> DataFrame:
    """The other variables, carried along unchanged."""
    return long.filter(~_spatial(x, y))


def _spatial(x: str, y: str | None) -> Column:
    on_sphere = F.array_contains("dims", x)
    return on_sphere & F.array_contains("dims", y) if y else on_sphere


def passthrough_table(cube: DataFrame, names: list[str], key: str = "level") -> DataFrame:
    """Side table of variables that depend on ``key`` only: one row per key value. Others are an error."""
    missing = [n for n in names if n not in cube.columns]
    if missing:
        log.warning("passthrough variables not in the data: %s", missing)
    present = [n for n in names if n in cube.columns and n != key]
    varies = F.raise_error(F.lit(f"a passthrough variable varies within {key}"))
    one = {n: F.when(F.min(n) != F.max(n), varies).otherwise(F.max(n)) for n in present}
    return cube.groupBy(key).agg(*[c.alias(n) for n, c in one.items()])


def attach_passthrough(cube: DataFrame, side: DataFrame, key: str = "level") -> DataFrame:
    """Join a side table back; levels are few, which is checked before it is broadcast."""
    return cube.join(broadcast_if_small(side, MAX_LEVELS), key, "left")


def requested_variables(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """Catalog rows of the requested names."""
    return catalog.join(requested.select("var"), "var", "left_semi")


def unknown_variables(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested names the catalog does not know."""
    return requested.select("var").join(catalog.select("var").distinct(), "var", "left_anti")


def filter_specs(specs: list[dict], names: list[str]) -> list[dict]:
    """Config entries of the requested variables; unknown names warn, none left is an error."""
    known = {s["var_name"] for s in specs}
    if unknown := [n for n in names if n not in known]:
        log.warning("unknown variables: %s", unknown)
    kept = [s for s in specs if s["var_name"] in names]
    if not kept:
        raise ValueError(f"none of {names} is configured")
    return kept


def pivot_long(long: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Long rows to one column per listed variable: one aggregation, names given up front."""
    cells = [F.any_value(F.when(F.col("var") == n, F.col("value")), ignoreNulls=True).alias(n) for n in names]
    return long.filter(F.col("var").isin(names)).groupBy(*keys).agg(*cells)
