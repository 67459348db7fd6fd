"""Means, comparisons and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spherecube.functions.fields import value_columns


def time_mean(cube: DataFrame, values: list[str] | None = None, scale: float = 1.0) -> DataFrame:
    """Mean per cell over the whole period, optionally rescaled."""
    keys = [c for c in ("level", "cell") if c in cube.columns]
    values = values or value_columns(cube)
    return cube.groupBy(*keys).agg(*[(F.avg(v) * scale if scale != 1.0 else F.avg(v)).alias(v) for v in values])


def sphere_mean(cube: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Mean over cells per step; cells have equal area, so no weights."""
    keys = [c for c in ("time", "level") if c in cube.columns]
    return cube.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values or value_columns(cube)])


def month_climatology(cube: DataFrame, values: list[str] | None = None) -> DataFrame:
    keys = [c for c in ("level", "cell") if c in cube.columns]
    return cube.groupBy(F.month("time").alias("month"), *keys).agg(
        *[F.avg(v).alias(v) for v in values or value_columns(cube)]
    )


def conservation(source: DataFrame, remapped: DataFrame, value: str) -> DataFrame:
    """Mean and population spread before and after a remap, side by side."""

    def moments(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("field"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n")
        )

    return moments(source, "source").unionByName(moments(remapped, "remapped"))


def coverage(cube: DataFrame, value: str) -> DataFrame:
    return cube.agg(
        F.min("time").alias("time_min"),
        F.max("time").alias("time_max"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
    )


def max_abs_difference(a: DataFrame, b: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Largest absolute difference over common keys."""
    pair = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), keys)
    return pair.agg(F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"), F.count("*").alias("n"))


def step_difference(cube: DataFrame, value: str, name: str = "diff") -> DataFrame:
    """Value minus the cell's previous value in time."""
    keys = [c for c in ("level", "cell") if c in cube.columns]
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy("time"))
    return cube.withColumn(name, F.col(value) - before)


def retention(before: DataFrame, after: DataFrame, column: str = "time") -> DataFrame:
    """Distinct steps (or levels) before and after a selection, and the share kept."""

    def distinct(df: DataFrame) -> Column:
        return df.select(column).distinct().agg(F.count("*").alias("n")).scalar()

    one = before.sparkSession.range(1).select(distinct(before).alias("n_before"), distinct(after).alias("n_after"))
    return one.withColumn("percent_kept", F.col("n_after") * 100.0 / F.col("n_before"))


def passing_quality(cube: DataFrame, quality_var: str, threshold: float) -> DataFrame:
    flag = F.nanvl(F.col(quality_var).cast("double"), F.lit(None))
    return cube.agg(
        F.count("*").alias("points"), F.sum(F.when(flag >= threshold, 1).otherwise(0)).alias("passed")
    )
