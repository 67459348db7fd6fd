"""Region selection and value masks."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.functions.fields import value_columns

log = logging.getLogger(__name__)


def keep_region(
    cube: DataFrame,
    lat_bounds: tuple[float, float] | None = None,
    lon_bounds: tuple[float, float] | None = None,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Points inside inclusive bounds, whichever way the axes run."""
    out = cube
    if lat_bounds is not None:
        out = out.filter(F.col(lat).between(*map(float, lat_bounds)))
    if lon_bounds is not None:
        out = out.filter(F.col(lon).between(*map(float, lon_bounds)))
    return out


def quality_mask(
    cube: DataFrame,
    quality_var: str = "quality_flag",
    quality_threshold: float = 0.8,
    mask_value: float | None = None,
    values: list[str] | None = None,
) -> DataFrame:
    """Blank every variable where the flag is below the threshold; a missing flag fails too."""
    if quality_var not in cube.columns:
        log.warning("no quality variable %s; nothing masked", quality_var)
        return cube
    good = F.nanvl(F.col(quality_var).cast("double"), F.lit(None)) >= quality_threshold
    names = [v for v in (values or value_columns(cube)) if v != quality_var]
    types = dict(cube.dtypes)
    return cube.withColumns(
        {v: F.when(good, F.col(v)).otherwise(F.lit(mask_value).cast(types[v])) for v in names}
    )


def where(cube: DataFrame, condition: Column, values: list[str] | None = None) -> DataFrame:
    """Keep every row but blank values where the condition does not hold."""
    return cube.withColumns({v: F.when(condition, F.col(v)) for v in values or value_columns(cube)})
