"""Column helpers for field values: missing data, casts and unit arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_COLUMNS = ("time", "level", "level_order", "cell", "src_idx", "step_id", "day", "tile", "year", "month", "zoom", "lat", "lon")

# Fixed physical constants: Stefan-Boltzmann, and the two coefficients of the OLR flux
# temperature to brightness temperature fit.
STEFAN_BOLTZMANN = 5.67e-8
FLUX_TEMPERATURE_A = 1.228
FLUX_TEMPERATURE_B = -1.106e-3


def value_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are not keys, in table order."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in KEY_COLUMNS and isinstance(f.dataType, T.NumericType)
    ]


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN becomes NULL: averages must skip it and comparisons must not treat it as largest."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    wanted = [c for c in (columns or value_columns(df)) if c in floats]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in wanted}) if wanted else df


def to_storage_types(df: DataFrame) -> DataFrame:
    """Doubles that are values (not coordinates) are stored as 32-bit floats."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(
        {c: F.col(c).cast("float") for c in value_columns(df) if c in doubles}
    )


def brightness_temperature(olr: Column) -> Column:
    """Outgoing longwave flux (W m-2) to brightness temperature (K)."""
    flux_t = F.pow(olr / F.lit(STEFAN_BOLTZMANN), F.lit(0.25))
    a, b = FLUX_TEMPERATURE_A, FLUX_TEMPERATURE_B
    return (F.sqrt(F.lit(a * a) + F.lit(4.0 * b) * flux_t) - a) / F.lit(2.0 * b)


def rescale(column: Column, factor: float = 1.0, offset: float = 0.0) -> Column:
    """Linear unit change, e.g. m/s to mm/h (3.6e6) or kelvin to celsius (offset -273.15)."""
    return column * F.lit(float(factor)) + F.lit(float(offset))
