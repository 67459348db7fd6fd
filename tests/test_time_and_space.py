import datetime as dt

import pytest
from pyspark.sql import functions as F

from spherecube.operators import coarsen as co
from spherecube.operators import combine, levels, masks, quality, stats, timeops

T0 = dt.datetime(2020, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def cube(spark, rows, schema="time timestamp_ntz, cell bigint, v double"):
    return spark.createDataFrame(rows, schema)


def steps(spark, n, minutes=60, cell=0):
    return cube(spark, [(at(i * minutes), cell, float(i)) for i in range(n)])


def values(df, *keys):
    return [tuple(r) for r in df.orderBy(*keys).collect()]


def test_minute_selection_edges(spark):
    df = cube(spark, [(at(m), m, 1.0) for m in (0, 5, 6, 24, 25, 35, 36, 54, 55, 59)])
    assert sorted(r.cell for r in timeops.keep_minute(df, "00min").collect()) == [0, 5, 55, 59]
    assert sorted(r.cell for r in timeops.keep_minute(df, "30min").collect()) == [25, 35]
    with pytest.raises(ValueError):
        timeops.keep_minute(df, "15min")


def test_time_index_across_days(spark):
    df = steps(spark, 60, minutes=75)
    rows = timeops.time_index(df).orderBy("time").collect()
    assert [r.idx for r in rows] == list(range(60)) and {r.n_steps for r in rows} == {60}


def test_every_interval(spark):
    df = steps(spark, 7, minutes=30)
    assert [r.v for r in timeops.every_interval(df, "1h").orderBy("time").collect()] == [0, 2, 4, 6]
    assert [r.v for r in timeops.every_interval(df, "100min").orderBy("time").collect()] == [0, 3, 6]
    with pytest.raises(ValueError):
        timeops.every_interval(df, "10min")
    with pytest.raises(ValueError):
        timeops.every_interval(steps(spark, 1), "1h")


def test_seven_steps_by_three(spark):
    df = steps(spark, 7)
    assert [r.v for r in timeops.every_nth(df, 3).orderBy("time").collect()] == [0, 3, 6]
    assert values(timeops.block_mean(df, 3, ["cell"]).select("time", "v"), "time") == [(at(0), 1.0), (at(180), 4.0)]


def test_index_pick(spark):
    df = steps(spark, 5)
    assert timeops.step_at(df, 1).first().v == 1.0 and timeops.step_at(df, -1).first().v == 4.0


def test_date_range_includes_last_second(spark):
    df = cube(spark, [(dt.datetime(2020, 1, 2, 23, 59, 59), 1, 1.0), (dt.datetime(2020, 1, 3), 2, 1.0), (dt.datetime(2019, 12, 31), 3, 1.0)])
    assert [r.cell for r in timeops.keep_dates(df, "2020-01-01", "20200102").collect()] == [1]
    assert timeops.keep_dates(df).count() == 3


def test_resample_skips_missing_and_fills_gaps(spark):
    df = cube(spark, [(at(0), 1, 2.0), (at(30), 1, None), (at(59), 1, 4.0), (at(200), 1, 8.0), (at(10), 2, None)])
    out = timeops.resample_mean(df, "1h", ["cell"], fill=True)
    assert values(out.filter("cell = 1").select("time", "v"), "time") == [(at(0), 3.0), (at(60), None), (at(120), None), (at(180), 8.0)]
    assert values(out.filter("cell = 2").select("time", "v"), "time") == [(at(0), None), (at(60), None), (at(120), None)]


def test_five_hour_bins_start_at_first_midnight(spark):
    df = cube(spark, [(dt.datetime(2020, 1, 1, 6), 1, 1.0), (dt.datetime(2020, 1, 2, 0, 30), 1, 3.0)])
    assert [r.time for r in timeops.resample_mean(df, "5h", ["cell"]).orderBy("time").collect()] == [
        dt.datetime(2020, 1, 1, 5), dt.datetime(2020, 1, 1, 20)
    ]


def test_target_hours(spark):
    df = cube(spark, [(dt.datetime(2020, 1, 1, h), 1, float(h)) for h in range(3, 15)])
    out = timeops.target_hours_mean(df, [3, 9, 15, 21], ["cell"])
    assert values(out.select("time", "v"), "time") == [(dt.datetime(2020, 1, 1, 3), 5.5), (dt.datetime(2020, 1, 1, 9), 11.5)]
    with pytest.raises(ValueError):
        timeops.target_hours_mean(df, [3], ["cell"])


def test_step_spacing_over_midnight(spark):
    df = cube(spark, [(at(m), 1, 1.0) for m in (0, 1430, 1450, 4400)])
    assert [r.spacing_s for r in timeops.step_spacing(df).orderBy("time").collect()] == [None, 85800.0, 1200.0, 177000.0]


def test_levels(spark):
    df = cube(spark, [(T0, 0, lev, lev) for lev in (499.995, 500.02, 100.0, 850.0)], "time timestamp_ntz, cell bigint, level double, v double")
    out = levels.keep_levels(df, [850, 500, 100, 850, 7])
    assert values(out.select("level_order", "level"), "level_order") == [(0, 850.0), (1, 499.995), (2, 100.0), (3, 850.0)]
    assert [r.requested for r in levels.missing_levels(df, [850, 7]).collect()] == [7.0]
    with pytest.raises(ValueError):
        levels.keep_levels_checked(df, [1.0, 2.0])
    with pytest.raises(ValueError):
        levels.keep_levels(df, [1.0], level="plev")


def test_quality_mask_treats_nan_as_failing(spark):
    df = cube(spark, [(1, 1.0, 0.8), (2, 1.0, 0.79), (3, 1.0, float("nan")), (4, 1.0, None)], "cell bigint, v double, q double")
    assert values(masks.quality_mask(df, "q", 0.8).select("cell", "v"), "cell") == [(1, 1.0), (2, None), (3, None), (4, None)]
    assert values(masks.quality_mask(df, "q", 0.8, mask_value=-1).select("cell", "v"), "cell") == [(1, 1.0), (2, -1.0), (3, -1.0), (4, -1.0)]
    assert masks.quality_mask(df, "absent") is df


def test_region_is_inclusive(spark):
    df = cube(spark, [(1, 10.0, 20.0), (2, 30.0, 20.0), (3, 30.1, 20.0)], "cell bigint, lat double, lon double")
    assert sorted(r.cell for r in masks.keep_region(df, (30, 10)[::-1], (20, 20)).collect()) == [1, 2]


def test_coarsening_constant_and_missing(spark):
    full = cube(spark, [(T0, c, 7.0) for c in range(192)])
    assert {r.v for r in co.coarsen(full, 2, 0).collect()} == {7.0}
    holes = cube(spark, [(T0, c, None if c in (1, 2, 3) else float(c)) for c in range(16)])
    direct = co.coarsen(holes, 2, 0).first().v
    chained = co.pyramid(holes, 2, 0)[0].first().v
    assert direct == pytest.approx(sum([0, *range(4, 16)]) / 13)
    assert chained == pytest.approx((0 + 5.5 + 9.5 + 13.5) / 4) and direct != chained
    assert co.coarsen(cube(spark, [(T0, 0, None)]), 1, 0).first().v is None
    assert co.pyramid(full, 2, 2) == {}


def test_direct_equals_sequential_without_gaps(spark):
    full = cube(spark, [(T0, c, float(c * c % 37)) for c in range(192)])
    direct = {r.cell: r.v for r in co.coarsen(full, 2, 0).collect()}
    chained = {r.cell: r.v for r in co.pyramid(full, 2, 0)[0].collect()}
    assert direct == pytest.approx(chained)


def test_time_reduction_precedence(spark):
    df = steps(spark, 12)
    assert co.coarsen_time(df, [0, 6], 3, 4).count() == 2
    assert [r.v for r in co.coarsen_time(df, None, 3, 4).orderBy("time").collect()] == [0, 3, 6, 9]
    assert [r.v for r in co.coarsen_time(df, None, 1, 4).orderBy("time").collect()] == [1.5, 5.5, 9.5]


def test_premerge_checks(spark):
    sfc = steps(spark, 3).withColumnRenamed("v", "ps")
    lev = steps(spark, 4).withColumns({"level": F.lit(500.0)}).withColumnRenamed("v", "ta")
    verdict = {r.check: r.ok for r in combine.premerge_checks(sfc, lev).collect()}
    assert verdict == {"time_ranges_overlap": True, "equal_cell_count": True, "no_shared_variables": True, "equal_step_count": False, "has_level": True}
    with pytest.raises(ValueError, match="no_shared_variables"):
        combine.require_mergeable(sfc, lev.withColumnRenamed("ta", "ps"))
    assert combine.merge_surface_levels(sfc, lev).count() == 4


def test_day_ranges(spark):
    days = spark.createDataFrame([(dt.date(2020, 1, d),) for d in (1, 2, 3, 7, 9, 10)], "day date")
    got = values(quality.day_ranges(days), "start_day")
    assert got == [(dt.date(2020, 1, 1), dt.date(2020, 1, 3), 3), (dt.date(2020, 1, 7),) * 2 + (1,), (dt.date(2020, 1, 9), dt.date(2020, 1, 10), 2)]


def test_time_order(spark):
    df = spark.createDataFrame([(i, at(m)) for i, m in enumerate([0, 10, 20, 15, 15, 30])], "i bigint, time timestamp_ntz")
    row = quality.time_order_report(df, "i").first()
    assert (row.steps, row.backward_steps, row.repeated_steps) == (6, 1, 1)


def test_store_issues_clean_store(spark):
    df = cube(spark, [("s", at(180 * i), c, 1.0) for i in range(8) for c in range(12)], "store string, time timestamp_ntz, cell bigint, v double")
    issues = quality.store_issues(df, ["v"], {"time": 8, "cell": 12})
    assert issues.count() == 0
    row = quality.validation_summary(df, issues).first()
    assert row.valid and row.n_errors == 0 and row.errors == ""


def test_step_difference_and_conservation(spark):
    df = steps(spark, 3)
    assert [r["diff"] for r in stats.step_difference(df, "v").orderBy("time").collect()] == [None, 1.0, 1.0]
    rows = {r.field: r for r in stats.conservation(df, df.filter("v > 0"), "v").collect()}
    assert rows["source"].mean == 1.0 and rows["remapped"].mean == 1.5 and rows["remapped"].std == 0.5
