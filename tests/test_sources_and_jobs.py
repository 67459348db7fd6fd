import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.operators import grids, levels, quality, timeops, variables
from spherecube.operators.weights import regular_weights
from spherecube.operators import coarsen as co
from spherecube.plans import presets, workflows
from spherecube.sources import catalog, cubes, stores

T0 = dt.datetime(2020, 1, 1)


def touch(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, n), "w") as f:
            f.write("x")


def hourly_name(d, h):
    return f"merg_{d:%Y%m%d}{h:02d}_10km-pixel.nc"


def test_hour_window_of_files(spark, tmp_path):
    day = dt.date(2020, 12, 31)
    touch(tmp_path / "2020", *[hourly_name(day, h) for h in range(8, 20)], "other.txt", "merg_20209999_x.nc")
    found = catalog.find_files(
        spark, dt.datetime(2020, 12, 31, 8), dt.datetime(2021, 1, 1, 18) - dt.timedelta(days=1), str(tmp_path), r"_(\d{10})_", "%Y%m%d%H", True, "merg_*"
    )
    names = sorted(r.name for r in found.collect())
    assert len(names) == 11 and names[-1] == hourly_name(day, 18)


def test_missing_folders_and_bad_patterns(spark, tmp_path):
    assert catalog.find_files(spark, T0, T0, str(tmp_path), year_subdirs=True).count() == 0
    with pytest.raises(ValueError):
        catalog.find_files(spark, T0, T0, str(tmp_path), pattern="(")
    with pytest.raises(ValueError):
        cubes.read_cube(spark, [])


def test_variable_files_by_month(spark, tmp_path):
    variables_wanted = [{"var_code": "128_130_t", "var_name": "T", "grid_type": "sc"}, {"var_code": "128_131_u", "var_name": "U", "grid_type": "uv"}]
    template = presets.ERA5_LEVELS["file_template"]
    for month, days in ((12, (30, 31)), (1, (1, 2))):
        year = 2019 if month == 12 else 2020
        folder = tmp_path / f"{year}{month:02d}"
        for d in days:
            stamp = f"{year}{month:02d}{d:02d}"
            touch(folder, *[f"e5.oper.an.pl.{v['var_code']}.ll025{v['grid_type']}.{stamp}00_{stamp}23.nc" for v in variables_wanted], "notes.txt")
    args = (spark, str(tmp_path), variables_wanted, template, dt.datetime(2019, 12, 31), dt.datetime(2020, 1, 1, 23))
    found = catalog.find_variable_files(*args).collect()
    assert sorted((r["var"], r.month) for r in found) == [("T", "201912"), ("T", "202001"), ("U", "201912"), ("U", "202001")]
    assert catalog.month_folders(dt.datetime(2019, 11, 5), dt.datetime(2020, 2, 1)) == ["201911", "201912", "202001", "202002"]
    assert catalog.find_variable_files(*args, monthly_files=True).count() == 4
    with pytest.raises(ValueError):
        catalog.find_variable_files(spark, str(tmp_path), [], template, T0, T0)


def test_catalog_scan_prunes_partitions(spark, tmp_path):
    rows = [("a", z, r, float(z)) for z in (5, 6) for r in ("1H", "1D")] + [("b", 5, "1H", 9.0)]
    spark.createDataFrame(rows, "dataset string, zoom int, time_res string, v double").write.partitionBy("dataset", "zoom", "time_res").parquet(str(tmp_path / "c"))
    scan = cubes.scan_catalog(spark, str(tmp_path / "c"), "a", 6, "1D")
    assert [r.v for r in scan.collect()] == [6.0]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan and "zoom" in plan[plan.index("PartitionFilters"):]


def gridded(spark, n_steps=6, minutes=30):
    axis_y = spark.createDataFrame([(i, -85.0 + 10 * i) for i in range(18)], "iy bigint, lat double")
    axis_x = spark.createDataFrame([(i, 5.0 + 10 * i) for i in range(36)], "ix bigint, lon double")
    points = grids.points_from_axes(axis_y, axis_x)
    times = [T0 + dt.timedelta(minutes=minutes * i) for i in range(n_steps)]
    cube = points.select(
        F.explode(F.array(*[F.lit(t).cast("timestamp_ntz") for t in times])).alias("time"), "src_idx", (2 * F.col("lat") + 3).alias("precipitation"), F.lit(1.0).alias("time_bnds")
    )
    return points, cube


def test_selection_reaches_the_scan(spark, tmp_path):
    _, cube = gridded(spark)
    cube.write.parquet(str(tmp_path / "g"))
    points, _ = gridded(spark)
    read = cubes.read_cube(spark, [str(tmp_path / "g")], schema=cube.schema)
    out = workflows.remap_cube(read, regular_weights(points, 2, "g"), 2, {"remap_variables": {"precipitation": "pr"}, "fill": False}, timeops.keep_dates, {"start_date": "2020-01-01", "end_date": "2020-01-01"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<time:timestamp_ntz,src_idx:bigint,precipitation:double>" in plan
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan


def test_full_job_round_trip(spark, tmp_path):
    points, cube = gridded(spark)
    name = "3B-HHR.MS.MRG.3IMERG.{:%Y%m%d}-S000000.parquet"
    base = tmp_path / "in" / "2020"
    os.makedirs(base)
    for day in (1, 2):
        shifted = cube.withColumn("time", F.col("time") + F.expr(f"INTERVAL {day - 1} DAYS"))
        shifted.write.parquet(str(base / "tmp" / str(day)))
        part = next(p for p in os.listdir(base / "tmp" / str(day)) if p.startswith("part") and p.endswith("parquet"))
        spark.read.parquet(str(base / "tmp" / str(day))).coalesce(1).write.parquet(str(tmp_path / f"one{day}"))
        part = next(p for p in os.listdir(tmp_path / f"one{day}") if p.startswith("part"))
        os.link(tmp_path / f"one{day}" / part, base / name.format(dt.date(2020, 1, day)))
    config = {**presets.IMERG, "input_base_dir": str(tmp_path / "in"), "remap_variables": {"precipitation": "pr"}}
    out_path = str(tmp_path / "IMERG_V7_1H_zoom3_20200101_20200101")
    store = workflows.process_to_cells(spark, "2020-01-01", "2020-01-01", 3, out_path, points, config, str(tmp_path / "w"))
    assert dict(store.dtypes)["pr"] == "float" and "time_bnds" not in store.columns
    assert store.select("time").distinct().count() == 3
    placed = healpix.with_cell_centers(store, 3)
    assert placed.agg(F.max(F.abs(F.col("pr") - 2 * F.col("lat") - 3))).first()[0] < 1e-4
    with pytest.raises(Exception, match="exists"):
        workflows.process_to_cells(spark, "2020-01-01", "2020-01-01", 3, out_path, points, config, str(tmp_path / "w"))
    again = workflows.process_to_cells(spark, "2020-01-01", "2020-01-02", 3, out_path, points, config, str(tmp_path / "w"), overwrite=True)
    assert again.select("day").distinct().count() == 2
    with pytest.raises(ValueError, match="no files"):
        workflows.process_to_cells(spark, "2021-01-01", "2021-01-02", 3, out_path, points, config)

    root = str(tmp_path / "levels")
    assert workflows.coarsen_store(spark, out_path, 1, root) == [2, 1]
    assert workflows.coarsen_store(spark, out_path, 0, root) == [0]
    assert co.existing_zooms(spark, root) == [0, 1, 2]
    zero = spark.read.parquet(f"{root}/zoom=0")
    # empty hours between the two days are bins without values
    assert zero.select("cell").distinct().count() == 12 and zero.select("time").distinct().count() == 27
    assert zero.filter("pr is not null").select("time").distinct().count() == 6
    assert workflows.coarsen_store(spark, out_path, 3, root) == []
    with pytest.raises(ValueError, match="no data"):
        workflows.coarsen_store(spark, out_path, 1, root, start_date="2030-01-01")


def test_daily_stores_overwrite_combine_merge(spark, tmp_path):
    rows = [(T0 + dt.timedelta(hours=6 * i), c, float(i)) for i in range(8) for c in range(12)]
    cube = spark.createDataFrame(rows, "time timestamp_ntz, cell bigint, v double")
    for day in ("2020-01-01", "2020-01-02"):
        stamp = day.replace("-", "")
        stores.write_store(timeops.keep_dates(cube, day, day), str(tmp_path / "days" / f"run_6H_zoom0_{stamp}_{stamp}"), 0)
    listed = catalog.list_store_files(spark, str(tmp_path / "days"))
    states = {r.store: r for r in quality.store_states(listed, min_bytes=1).collect()}
    assert len(states) == 2 and all(r.has_marker and r.problem is None and r.bytes > 0 for r in states.values())
    os.remove(tmp_path / "days" / "run_6H_zoom0_20200102_20200102" / "_SUCCESS")
    states = {r.store: r.problem for r in quality.store_states(catalog.list_store_files(spark, str(tmp_path / "days"))).collect()}
    assert states == {"run_6H_zoom0_20200101_20200101": "too small", "run_6H_zoom0_20200102_20200102": "no commit marker"}
    combined = workflows.combine_days(spark, str(tmp_path / "days"), str(tmp_path / "all"), 0)
    assert combined.count() == 96 and combined.select("day").distinct().count() == 2
    assert workflows.combine_days(spark, str(tmp_path / "days"), str(tmp_path / "second"), 0, start=dt.datetime(2020, 1, 2)).count() == 48
    with pytest.raises(FileNotFoundError):
        workflows.combine_days(spark, str(tmp_path / "days"), str(tmp_path / "none"), 0, start=dt.datetime(2021, 1, 2))

    # recompute one day: the other stays
    second = timeops.keep_dates(cube, "2020-01-02", "2020-01-02").withColumn("v", F.lit(-1.0))
    stores.write_store(second, str(tmp_path / "all"), 0, mode="overwrite_days")
    got = stores.read_store(spark, str(tmp_path / "all"))
    assert got.count() == 96 and got.filter("v = -1").count() == 48

    lev = cube.select("time", F.lit(500.0).alias("level"), "cell", F.col("v").alias("ta"))
    stores.write_store(lev, str(tmp_path / "lev"), 0)
    merged = workflows.merge_stores(spark, surface=str(tmp_path / "all"), level=str(tmp_path / "lev"), output=str(tmp_path / "m"), zoom=0)
    assert merged.count() == 96 and {"v", "ta", "level"} <= set(merged.columns)


def test_user_steps(spark):
    df = spark.range(4).withColumnRenamed("id", "cell")
    add = lambda d, by=1: d.withColumn("cell", F.col("cell") + by)
    assert workflows.apply_steps(df, add).agg(F.max("cell")).first()[0] == 4
    assert workflows.apply_steps(df, [add, add], {"by": 10}).agg(F.max("cell")).first()[0] == 23
    assert workflows.apply_steps(df, [add, add], [{"by": 1}, {"by": 2}]).agg(F.max("cell")).first()[0] == 6
    with pytest.raises(ValueError):
        workflows.apply_steps(df, [add], [{}, {}])


def test_presets(spark):
    assert set(presets.PRESETS) == {"imerg", "ir_imerg", "era5_2d", "era5_3d", "scream_1h", "scream_3h", "scream_1m"}
    funcs, kwargs = workflows.preset_steps(presets.ERA5_LEVELS)
    assert funcs == [timeops.every_interval, levels.keep_levels_checked] and len(kwargs[1]["wanted"]) == 15
    assert [len(presets.PRESETS[p]["remap_variables"]) for p in ("era5_2d", "era5_3d", "scream_1h", "scream_3h", "scream_1m")] == [10, 7, 3, 17, 28]
    kept = variables.filter_specs(presets.ERA5_LEVELS["variables"], ["T", "NOPE"])
    assert [v["var_name"] for v in kept] == ["T"]
    with pytest.raises(ValueError):
        variables.filter_specs(presets.ERA5_LEVELS["variables"], ["NOPE"])


def test_variable_merge_rules(spark):
    a = spark.createDataFrame([(1, 1.0, 5.0)], "cell bigint, x double, both double")
    b = spark.createDataFrame([(1, 9.0, 2.0), (2, 9.0, 3.0)], "cell bigint, both double, y double")
    rows = {r.cell: r for r in cubes.merge_variables({"a": a, "b": b}, ["cell"]).collect()}
    assert (rows[1].x, rows[1].both, rows[1].y) == (1.0, 5.0, 2.0) and (rows[2].x, rows[2].both, rows[2].y) == (None, None, 3.0)
    with pytest.raises(ValueError):
        cubes.read_variables(spark, {"a": []}, ["cell"], combine=False)


def test_load_check(spark):
    whole = spark.createDataFrame([(T0, "f1"), (T0 + dt.timedelta(hours=1), "f2")], "time timestamp_ntz, source_file string")
    assert cubes.require_complete(whole) is whole
    assert cubes.load_report(whole).first().verdict == "complete"


def test_selection_of_variables(spark):
    cube = spark.createDataFrame([(T0, 1, 2.0, 3.0, 4.0)], "time timestamp_ntz, cell bigint, T double, Q double, hyam double")
    assert variables.select_rename(cube, {"T": "ta", "X": "x"}, ["hyam"]).columns == ["time", "cell", "ta", "hyam"]
    assert variables.select_rename(cube, {"X": "x"}) is cube
    assert variables.drop_skipped_columns(cube.withColumn("lat_bnds", F.lit(1)), ["hy*"]).columns == ["time", "cell", "T", "Q"]
    with pytest.raises(Exception):
        variables.select_rename_strict(cube, {"X": "x"}).collect()


def test_storage_layout(spark):
    cube = spark.createDataFrame([(T0 + dt.timedelta(hours=h), 300_000, 1.0) for h in (0, 11, 12)], "time timestamp_ntz, cell bigint, v double")
    laid = stores.store_layout(cube, 9, time_chunk=12).collect()
    assert {r.tile for r in laid} == {1} and len({r._slot for r in laid}) == 2
    assert np.isclose(stores.size_report(cube, 9, 2).first().time_chunks, 2)
