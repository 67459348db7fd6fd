"""Pyramids from one shuffle, filled gaps, stored catalogs and attributes, load and order checks: results and plans."""

import datetime as dt
import glob
import logging
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spherecube.operators import coarsen as co
from spherecube.operators import quality, timeops
from spherecube.operators.weights import grid_fingerprint
from spherecube.plans import presets, workflows
from spherecube.sources import catalog, cubes, stores

T0 = dt.datetime(2020, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def holes(spark):
    """Two days of zoom 3 with a third of the cells, and some values, missing."""
    rng = np.random.default_rng(1)
    rows = [(T0 + dt.timedelta(hours=int(h)), int(c), None if rng.random() < 0.2 else float(rng.normal())) for h in range(0, 48, 8) for c in rng.choice(768, 500, replace=False)]
    return spark.createDataFrame(rows, "time timestamp_ntz, cell bigint, v double")


def test_all_levels_equal_the_chain(holes):
    for bottom in (2, 1, 0):
        got = co.all_levels(holes, 3, bottom).toPandas()
        for z, level in co.pyramid(holes, 3, bottom).items():
            a, b = (x.sort_values(["time", "cell"], ignore_index=True) for x in (got[got.zoom == z][["time", "cell", "v"]], level.toPandas()))
            assert a[["time", "cell"]].equals(b[["time", "cell"]]) and np.allclose(a.v.astype(float), b.v.astype(float), equal_nan=True)
        assert set(got.zoom) == set(range(bottom, 3))


def test_all_levels_take_one_scan_and_one_exchange(spark, holes, tmp_path):
    stores.write_store(holes, str(tmp_path / "s"), 3)
    plan = plan_of(co.all_levels(stores.read_store(spark, str(tmp_path / "s")), 3, 0))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "hashpartitioning(_day" in plan


def test_pyramid_is_resumed_from_markers(spark, holes, tmp_path):
    root = str(tmp_path / "levels")
    assert co.write_pyramid(holes, 3, 0, root) == [2, 1, 0]
    whole = {z: spark.read.parquet(f"{root}/zoom={z}").orderBy("time", "cell").toPandas() for z in range(3)}
    # a level without its marker was not finished: its files go, those of finished levels stay
    os.remove(f"{root}/zoom=1/_SUCCESS")
    spark.read.parquet(f"{root}/zoom=0").limit(1).drop("day").withColumn("day", F.lit("2020-01-09")).write.mode("append").partitionBy("day").parquet(f"{root}/zoom=1")
    os.remove(f"{root}/zoom=1/_SUCCESS") if os.path.exists(f"{root}/zoom=1/_SUCCESS") else None
    assert [r.zoom for r in co.stored_levels(spark, root).orderBy("zoom").collect()] == [0, 2]
    assert co.write_pyramid(holes, 3, 0, root) == [1]
    for z, want in whole.items():
        pd.testing.assert_frame_equal(spark.read.parquet(f"{root}/zoom={z}").orderBy("time", "cell").toPandas(), want)
    assert co._runs(9, 0, set()) == [[8, 7, 6, 5, 4, 3], [2, 1, 0]] and co._runs(9, 4, {6}) == [[8, 7], [5, 4]]
    assert all(len(glob.glob(f"{root}/zoom=0/day={d}/*.parquet")) <= 12 for d in ("2020-01-01", "2020-01-02"))


def test_empty_bins_by_key(spark):
    hours = [0, 1, 5, 30]
    df = spark.createDataFrame([(T0 + dt.timedelta(hours=h), c, 1.0) for h in hours for c in ((1, 2) if h else (1,))], "time timestamp_ntz, cell bigint, v double")
    got = timeops.resample_mean(df, "1h", ["cell"], fill=True).toPandas()
    gaps = set(range(31)) - set(hours)
    seen = {(int((t - pd.Timestamp(T0)).total_seconds() // 3600), c) for t, c, v in got.itertuples(index=False) if np.isnan(v)}
    assert seen == {(h, c) for h in gaps for c in (1, 2)} and len(got) == len(seen) + 7
    assert timeops.empty_bins(df.select("time"), 3600).count() == len(gaps)
    assert timeops.resample_mean(df.limit(0), "1h", ["cell"], fill=True).count() == 0


def test_order_over_ranges(spark):
    rng = np.random.default_rng(2)
    at = rng.permutation(500)
    rows = [(f"f{k // 100}", int(k), T0 + dt.timedelta(minutes=int(m))) for k, m in enumerate(rng.integers(0, 400, 500))]
    df = spark.createDataFrame([rows[k] for k in at], "file string, i bigint, time timestamp_ntz").repartition(7)
    got = quality.time_order_report(df, ["file", "i"]).first()
    times = [r[2] for r in rows]
    assert (got.steps, got.backward_steps, got.repeated_steps) == (500, sum(b < a for a, b in zip(times, times[1:])), 500 - len(set(times)))
    back = timeops.with_previous_in_ranges(df, ["file", "i"], "time", "_p").orderBy("file", "i").collect()
    assert [r._p for r in back] == [None, *times[:-1]]
    assert quality.time_order_report(df.limit(0), "i").first().steps == 0


def test_steps_that_do_not_rise_are_an_error(spark):
    rows = [("a", k, T0 + dt.timedelta(hours=3 * k), c, 1.0) for k in range(4) for c in range(2)]
    rows += [("b", k, T0 + dt.timedelta(hours=3 * (k ^ 1)), c, 1.0) for k in range(4) for c in range(2)]
    df = spark.createDataFrame(rows, "store string, i int, time timestamp_ntz, cell bigint, v double")
    issues = quality.store_issues(df, ["v"], {}, order="i").collect()
    assert [(r.store, r.severity, r.message) for r in issues] == [("b", "error", "time not increasing at 2 steps")]
    assert quality.store_issues(df, ["v"], {}).count() == 0


def test_catalog_is_pruned_by_requests(spark, holes, tmp_path):
    root = str(tmp_path / "catalog")
    for name, zoom in (("a", 3), ("b", 3), ("a", 4)):
        stores.write_catalog(holes, root, name, "8H", zoom)
    stores.write_catalog(holes.withColumn("v", F.lit(9.0)), root, "b", "8H", 3)  # replaced, not added
    asked = spark.createDataFrame([("b", 3, dt.date(2020, 1, 2)), ("z", 3, dt.date(2020, 1, 1))], "dataset string, zoom int, day date")
    rows = cubes.scan_requests(spark, root, asked)
    got = rows.toPandas()
    assert len(got) == 1500 and set(got.v) == {9.0} and set(got.day) == {dt.date(2020, 1, 2)}
    plan = plan_of(rows)
    assert "dynamicpruning" in plan and "PartitionFilters" in plan
    assert cubes.scan_catalog(spark, root, "a", 4).count() == 3000
    assert "PushedFilters" in plan and cubes.scan_requests(spark, root, asked.limit(0)).count() == 0


@pytest.fixture(scope="module")
def grid(spark):
    points = spark.range(36 * 18).select(F.col("id").alias("src_idx"), F.floor(F.col("id") / 36).alias("iy"), (F.col("id") % 36).alias("ix"))
    return points.withColumns({"lon": F.col("ix") * 10.0 + 5.0, "lat": F.col("iy") * 10.0 - 85.0})


def _daily_files(spark, grid, folder, empty_day=None):
    os.makedirs(folder / "2020")
    for day in (1, 2):
        cube = grid.withColumn("h", F.explode(F.array(F.lit(0), F.lit(12)))).select(
            (F.lit(dt.datetime(2020, 1, day)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))).alias("time"), "src_idx", F.col("lat").alias("precipitation"))
        tmp = folder / f"tmp{day}"
        (cube.limit(0) if day == empty_day else cube).coalesce(1).write.parquet(str(tmp))
        part = next(p for p in os.listdir(tmp) if p.startswith("part"))
        os.link(tmp / part, folder / "2020" / f"x.2020010{day}-S000000.parquet")


def test_jobs_refuse_cut_files_and_keep_attributes(spark, grid, tmp_path):
    config = {**presets.IMERG, "remap_variables": {"precipitation": "pr"}, "time_average": None, "fill": False}
    _daily_files(spark, grid, tmp_path / "whole")
    _daily_files(spark, grid, tmp_path / "cut", empty_day=2)
    out = str(tmp_path / "run_12H_zoom2_20200101_20200102")
    # a file without rows, and one step in all the others: fewer steps than files
    files = sorted(glob.glob(str(tmp_path / "cut" / "2020" / "*.parquet")))
    single = tmp_path / "single"
    spark.read.parquet(files[0]).filter(F.hour("time") == 0).coalesce(1).write.parquet(str(single))
    cut = [next(str(p) for p in single.glob("part*")), files[1]]
    assert cubes.file_report(spark, cut).first().verdict == "incomplete"
    with pytest.raises(ValueError, match="read only 1 time steps from 2 files"):
        workflows.process_to_cells(spark, "2020-01-01", "2020-01-02", 2, out, grid, {**config, "input_files": cut})
    assert not os.path.exists(out)

    whole = sorted(glob.glob(str(tmp_path / "whole" / "2020" / "*.parquet")))
    for day, file in enumerate(whole, 1):
        path = str(tmp_path / "days" / f"run_12H_zoom2_2020010{day}_2020010{day}")
        workflows.process_to_cells(spark, f"2020-01-0{day}", f"2020-01-0{day}", 2, path, grid, {**config, "input_files": [file]})
        kept = stores.stored_attributes(spark, path)
        assert kept["grid_id"] == grid_fingerprint(grid) and kept["healpix_npix"] == "192" and kept["start"].startswith(f"2020-01-0{day}")
    all_days = workflows.combine_days(spark, str(tmp_path / "days"), out, 2)
    assert all_days.count() == 4 * all_days.select("cell").distinct().count()
    combined = stores.stored_attributes(spark, out)
    assert combined["combined_from"] == "2" and combined["grid_id"] == grid_fingerprint(grid)
    root = str(tmp_path / "levels")
    workflows.coarsen_store(spark, out, 0, root, temporal_factor=2)
    zero = stores.stored_attributes(spark, f"{root}/zoom=0")
    assert (zero["coarsened_from"], zero["temporal_coarsening"], zero["healpix_npix"], zero["grid_id"]) == ("1", "means of 2 steps", "12", grid_fingerprint(grid))
    levels = stores.read_store(spark, out).select("time", F.lit(1.0).alias("level"), "cell", F.col("pr").alias("ta"))
    stores.write_store(levels, str(tmp_path / "lev"), 2)
    workflows.merge_stores(spark, surface=out, level=str(tmp_path / "lev"), output=str(tmp_path / "both"), zoom=2)
    merged = stores.stored_attributes(spark, str(tmp_path / "both"))
    assert merged["merged_from"] == f"{out}, {tmp_path / 'lev'}" and merged["grid_id"] == grid_fingerprint(grid)
    assert stores.stored_attributes(spark, str(tmp_path / "lev")) == {}


def test_combining_warns_of_repeated_and_backward_steps(spark, holes, tmp_path, caplog):
    first, second = timeops.keep_dates(holes, "2020-01-01", "2020-01-01"), holes
    for k, part in enumerate((first, second), 1):
        stores.write_store(part, str(tmp_path / "days" / f"run_8H_zoom3_2020010{k}_2020010{k}"), 3)
    with caplog.at_level(logging.WARNING):
        workflows.combine_days(spark, str(tmp_path / "days"), str(tmp_path / "all"), 3)
    assert "1 steps go backwards, 3 repeat" in caplog.text


def test_a_hot_month_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(F.when(F.col("id") < 199_000, F.lit(T0)).otherwise(F.lit(T0 + dt.timedelta(days=40))).cast("timestamp_ntz").alias("time"), F.col("id").alias("cell"), F.rand(1).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        workflows.write_by_month(rows, str(tmp_path / "months"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {m: len(glob.glob(str(tmp_path / "months" / "year=2020" / f"month={m}" / "*.parquet"))) for m in (1, 2)}
    assert files[1] > 3 and files[2] == 1 and spark.read.parquet(str(tmp_path / "months")).count() == 200_000


def test_remove_and_touch(spark, tmp_path):
    path = str(tmp_path / "a" / "b")
    catalog.touch(spark, path)
    assert stores.path_exists(spark, path)
    catalog.remove_path(spark, str(tmp_path / "a"))
    catalog.remove_path(spark, str(tmp_path / "a"))
    assert not stores.path_exists(spark, path)
