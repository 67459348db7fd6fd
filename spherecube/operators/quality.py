"""Completeness and validity checks over stores and their catalogs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spherecube.functions.fields import value_columns
from spherecube.functions.times import seconds_between
from spherecube.operators.timeops import with_previous_in_ranges

MIN_STORE_BYTES = 1024 * 1024
COMMIT_MARKER = "_SUCCESS"


# --- daily progress -----------------------------------------------------------------------------


def expected_days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per calendar day of the range."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("day"))


def store_states(files: DataFrame, store: str = "store", min_bytes: int = MIN_STORE_BYTES) -> DataFrame:
    """Per store: total size, commit marker, and whether it counts as complete (with the reason)."""
    per = files.groupBy(store).agg(
        F.sum("bytes").alias("bytes"), F.max((F.col("name") == COMMIT_MARKER).cast("int")).alias("marked")
    )
    problem = F.when(F.col("marked") == 0, "no commit marker").when(F.col("bytes") < min_bytes, "too small")
    return per.select(store, "bytes", (F.col("marked") == 1).alias("has_marker"), problem.alias("problem"))


def day_status(days: DataFrame, stores: DataFrame) -> DataFrame:
    """Each expected day as complete, incomplete or missing.

    ``stores`` holds ``(day, bytes, problem)`` with NULL ``problem`` for a complete store.
    """
    found = stores.select("day", "bytes", "problem", F.lit(True).alias("_found"))
    status = (
        F.when(F.col("_found").isNull(), "missing")
        .when(F.col("problem").isNull(), "complete")
        .otherwise("incomplete")
    )
    return days.join(found, "day", "left").select(
        "day", F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"), "problem", status.alias("status")
    )


def progress_summary(status: DataFrame) -> DataFrame:
    """Days, share and size per status."""
    per = status.groupBy("status").agg(
        F.count("*").alias("days"), F.sum("bytes").cast("bigint").alias("total_bytes"), F.avg("bytes").alias("mean_bytes")
    )
    total = status.agg(F.count("*").alias("n")).scalar()
    return per.withColumn("percent", F.col("days") * 100.0 / total)


def day_ranges(days: DataFrame, day: str = "day", by: list[str] | None = None) -> DataFrame:
    """Consecutive days as ranges (one row per calendar day goes in)."""
    position = F.row_number().over(Window.partitionBy(*(by or [])).orderBy(day))
    islands = days.select(*(by or []), day).distinct().withColumn("_island", F.date_sub(F.col(day), position))
    return islands.groupBy(*(by or []), "_island").agg(
        F.min(day).alias("start_day"), F.max(day).alias("end_day"), F.count("*").alias("n_days")
    ).drop("_island")


def daily_tasks(days: DataFrame, zoom: int, factor: int) -> DataFrame:
    """One work item per day."""
    text = F.date_format("day", "yyyy-MM-dd")
    return days.select(
        text.alias("start_date"), text.alias("end_date"), F.lit(zoom).alias("zoom"), F.lit(factor).alias("factor")
    )


# --- time axis ----------------------------------------------------------------------------------


def time_order_report(steps: DataFrame, order: str | list[str], time: str = "time") -> DataFrame:
    """Steps in stored order: how many go backwards and how many repeat an earlier time."""
    order = [order] if isinstance(order, str) else order
    walked = with_previous_in_ranges(steps.select(*dict.fromkeys([*order, time])), order, time, "_previous")
    backwards = F.sum(F.when(F.col(time) < F.col("_previous"), 1).otherwise(0))
    distinct = steps.select(time).distinct().agg(F.count("*").alias("n")).scalar()
    return walked.agg(F.count("*").alias("steps"), F.coalesce(backwards, F.lit(0)).alias("backward_steps")).select(
        "steps", "backward_steps", (F.col("steps") - distinct).alias("repeated_steps")
    )


def not_increasing(cube: DataFrame, order: str, store: str = "store", time: str = "time") -> DataFrame:
    """Stores whose steps, taken as they first come in ``order``, don't rise strictly: (store, n_not_increasing)."""
    per_step = cube.groupBy(store, time).agg(F.min(order).alias("_at"))
    later = F.lag(time).over(Window.partitionBy(store).orderBy("_at", time)) >= F.col(time)
    return per_step.withColumn("_back", later).filter("_back").groupBy(store).agg(F.count("*").alias("n_not_increasing"))


# --- store contents -----------------------------------------------------------------------------


def _issue(when: Column, severity: str, message: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), message.alias("message")))


def store_profile(cube: DataFrame, values: list[str], store: str = "store") -> DataFrame:
    """Numbers the checks need, one row per store, from two-level aggregations.

    Values are first reduced per (store, step) and the few step rows then per store, which also
    gives the state of the first step. Dimension sizes are distinct counts of single columns.
    """
    per_step = cube.groupBy(store, "time").agg(
        F.count("*").alias("n"),
        *[F.count(v).alias(f"n_{v}") for v in values],
        *[F.min(v).alias(f"lo_{v}") for v in values],
        *[F.max(v).alias(f"hi_{v}") for v in values],
    )
    profile = per_step.groupBy(store).agg(
        F.count("*").alias("size_time"),
        F.sum("n").alias("n"),
        *[F.min_by(f"n_{v}", "time").alias(f"first_{v}") for v in values],
        *[F.sum(f"n_{v}").alias(f"n_{v}") for v in values],
        *[F.min(f"lo_{v}").alias(f"lo_{v}") for v in values],
        *[F.max(f"hi_{v}").alias(f"hi_{v}") for v in values],
    )
    gap = seconds_between(F.lag("time").over(Window.partitionBy(store).orderBy("time")), F.col("time"))
    # a store covers one day or month, so its step list is short
    spacing = per_step.select(store, "time").withColumn("_gap_h", gap / 3600.0)
    spacing = spacing.groupBy(store).agg(
        F.min("_gap_h").alias("gap_min"), F.max("_gap_h").alias("gap_max"), F.avg("_gap_h").alias("gap_mean")
    )
    profile = profile.join(spacing, store)
    for dim in ("cell", "level"):
        if dim in cube.columns:
            sizes = cube.select(store, dim).distinct().groupBy(store).agg(F.count("*").alias(f"size_{dim}"))
            profile = profile.join(sizes, store)
    return profile


def store_issues(
    cube: DataFrame,
    required: list[str],
    expected_sizes: dict[str, int],
    step_hours: float = 3.0,
    store: str = "store",
    order: str | None = None,
) -> DataFrame:
    """Rows ``(store, severity, message)``; stores without findings have none.

    ``order`` names a column with the stored order of the rows, by which steps have to rise.
    """
    values = [v for v in required if v in cube.columns]
    absent = [v for v in required if v not in cube.columns]
    profile = store_profile(cube, values, store)
    found = [_issue(F.lit(True), "error", F.lit(f"missing variable {v}")) for v in absent]
    for dim, size in expected_sizes.items():
        if f"size_{dim}" not in profile.columns:
            found.append(_issue(F.lit(True), "error", F.lit(f"missing dimension {dim}")))
            continue
        actual = F.col(f"size_{dim}")
        text = F.format_string(f"{dim} has size %d, expected {size}", actual)
        near = F.abs(actual - size) <= 1 if dim == "time" else F.lit(False)
        found.append(_issue((actual != size) & near, "warning", text))
        found.append(_issue((actual != size) & ~near, "error", text))
    for v in values:
        share = (F.col("n") - F.col(f"n_{v}")) * 100.0 / F.col("n")
        first_empty = F.col(f"first_{v}") == 0
        endless = F.lit(float("inf"))
        text = F.format_string(f"{v}: %.1f%% missing", F.bround(share, 1))
        found.append(_issue(first_empty, "error", F.lit(f"{v}: first step is all missing")))
        found.append(_issue(~first_empty & (share > 50), "error", text))
        found.append(_issue(~first_empty & (share > 0) & (share <= 50), "warning", text))
        unbounded = (F.col(f"lo_{v}") == -endless) | (F.col(f"hi_{v}") == endless)
        found.append(_issue(~first_empty & unbounded, "error", F.lit(f"{v}: infinite values")))
    uneven = (F.abs(F.col("gap_min") - step_hours) > 0.1) | (F.abs(F.col("gap_max") - step_hours) > 0.1)
    found.append(_issue(uneven, "warning", F.format_string("uneven time steps, mean %.2f h", F.bround("gap_mean", 2))))
    if order is not None:
        profile = profile.join(not_increasing(cube, order, store), store, "left")
        back = F.coalesce("n_not_increasing", F.lit(0))
        found.append(_issue(back > 0, "error", F.format_string("time not increasing at %d steps", back)))
    issues = F.filter(F.array(*found), lambda i: i.isNotNull())
    return profile.select(store, F.inline(issues))


def validation_summary(stores: DataFrame, issues: DataFrame, store: str = "store") -> DataFrame:
    """One row per store: verdict, counts and joined messages in alphabetical order."""

    def messages(severity: str) -> Column:
        picked = F.collect_list(F.when(F.col("severity") == severity, F.col("message")))
        return F.concat_ws("; ", F.array_sort(picked))

    def number(severity: str) -> Column:
        return F.count(F.when(F.col("severity") == severity, 1))

    per = issues.groupBy(store).agg(
        number("error").alias("n_errors"), number("warning").alias("n_warnings"),
        messages("error").alias("errors"), messages("warning").alias("warnings"),
    )
    blank = {"n_errors": 0, "n_warnings": 0, "errors": "", "warnings": ""}
    joined = stores.select(store).distinct().join(per, store, "left").fillna(blank)
    return joined.withColumn("valid", F.col("n_errors") == 0)


def value_stats(cube: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Per variable: smallest and largest value and share missing, from one pass."""
    names = values or value_columns(cube)
    facts = cube.agg(
        F.count("*").alias("n"),
        *[F.count(v).alias(f"n_{v}") for v in names],
        *[F.min(v).cast("double").alias(f"lo_{v}") for v in names],
        *[F.max(v).cast("double").alias(f"hi_{v}") for v in names],
    )
    rows = [
        F.struct(
            F.lit(v).alias("var"),
            F.col(f"lo_{v}").alias("min"),
            F.col(f"hi_{v}").alias("max"),
            ((F.col("n") - F.col(f"n_{v}")) * 100.0 / F.col("n")).alias("missing_percent"),
        )
        for v in names
    ]
    return facts.select(F.inline(F.array(*rows)))
