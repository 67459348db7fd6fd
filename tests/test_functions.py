import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from spherecube.functions import fields, healpix, names, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_order_zero_centres(spark):
    rows = healpix.with_cell_centers(healpix.all_cells(spark, 0), 0).orderBy("cell").collect()
    cap = math.degrees(math.asin(2 / 3))
    assert [round(r.lat, 9) for r in rows] == [round(v, 9) for v in [cap] * 4 + [0.0] * 4 + [-cap] * 4]
    assert [r.lon for r in rows] == [45, 135, 225, 315, 0, 90, 180, 270, 45, 135, 225, 315]


@pytest.mark.parametrize("zoom", [1, 3, 6])
def test_centres_are_distinct_and_children_surround_parent(spark, zoom):
    fine = healpix.with_cell_centers(healpix.all_cells(spark, zoom), zoom)
    assert fine.select(F.round("lon", 8), F.round("lat", 8)).distinct().count() == healpix.npix(zoom)
    coarse = healpix.with_cell_centers(healpix.all_cells(spark, zoom - 1), zoom - 1, lon="plon", lat="plat")
    near = fine.withColumn("parent", healpix.parent_cell(F.col("cell"), 1)).join(coarse.withColumnRenamed("cell", "parent"), "parent")
    a, b = F.radians("lat"), F.radians("plat")
    cosd = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(F.col("lon") - F.col("plon")))
    far = near.agg(F.max(F.degrees(F.acos(F.least(cosd, F.lit(1.0)))))).first()[0]
    assert far < healpix.resolution_deg(zoom - 1)


def test_published_sizes():
    assert [healpix.npix(z) for z in (7, 8, 9)] == [196_608, 786_432, 3_145_728]
    assert healpix.chunk_cells(9) == 262_144 and healpix.npix(9) // healpix.chunk_cells(9) == 12
    assert healpix.chunk_cells(7) == healpix.npix(7)


def test_filter_on_centres_does_not_repeat_the_maths(spark):
    placed = healpix.with_cell_centers(healpix.all_cells(spark, 5), 5).filter("lat > 10 and lon < 50")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


@pytest.mark.parametrize(
    "text, seconds", [("1h", 3600), ("3H", 10800), ("30min", 1800), ("1d", 86400), ("2 days", 172800), ("6hours", 21600)]
)
def test_interval_seconds(text, seconds):
    assert times.interval_seconds(text) == seconds


@pytest.mark.parametrize("text", ["h", "3", "3w", "", "0h"])
def test_bad_interval(text):
    with pytest.raises(ValueError):
        times.interval_seconds(text)


@pytest.mark.parametrize(
    "text, end, expected",
    [
        ("2020-01-01", False, dt.datetime(2020, 1, 1)),
        ("2020-01-03", True, dt.datetime(2020, 1, 3, 23, 59, 59)),
        ("2020-01-03T12", True, dt.datetime(2020, 1, 3, 12, 59, 59)),
        ("2020-01-03 07", False, dt.datetime(2020, 1, 3, 7)),
    ],
)
def test_parse_date(spark, text, end, expected):
    assert one(spark, times.parse_date(F.lit(text), end)) == expected
    assert times.parse_date_value(text, end) == expected


@pytest.mark.parametrize("text", ["03/01/2020", "2020-13-01", "now"])
def test_parse_date_rejects(spark, text):
    assert one(spark, times.parse_date(F.lit(text))) is None
    with pytest.raises(ValueError):
        times.parse_date_value(text)


@pytest.mark.parametrize(
    "label, factor, expected",
    [("1H", 3, "3H"), ("6H", 4, "1D"), ("1H", 25, "25H"), ("12H", 4, "2D"), ("1D", 5, "5D"), ("30MIN", 2, "30MIN")],
)
def test_coarser_label(spark, label, factor, expected):
    assert one(spark, times.coarser_label(F.lit(label), factor)) == expected


@pytest.mark.parametrize(
    "name, pattern, form, expected",
    [
        ("3B-HHR.MS.MRG.3IMERG.20200101-S000000-E002959.0000.V07B.HDF5.nc4", r"\.(\d{8})-", "%Y%m%d", dt.datetime(2020, 1, 1)),
        ("merg_2020123108_10km-pixel.nc", r"_(\d{10})_", "%Y%m%d%H", dt.datetime(2020, 12, 31, 8)),
        ("precipitation_2020-01-01_v2.nc", r"_(\d{4}-\d{2}-\d{2})_", "%Y-%m-%d", dt.datetime(2020, 1, 1)),
        ("1hi.INSTANT.nhours_x1.2019-08-01-00000.nc", r"\.(\d{4}-\d{2}-\d{2})-", "%Y-%m-%d", dt.datetime(2019, 8, 1)),
        ("x.20209901-y.nc", r"\.(\d{8})-", "%Y%m%d", None),
        ("readme.txt", r"\.(\d{8})-", "%Y%m%d", None),
    ],
)
def test_date_in_name(spark, name, pattern, form, expected):
    assert one(spark, names.date_in_name(F.lit(name), pattern, form)) == expected


def test_bad_patterns():
    with pytest.raises(ValueError):
        names.checked_regex("(")
    with pytest.raises(ValueError):
        names.checked_regex(r"\d{8}")


@pytest.mark.parametrize(
    "name, expected",
    [
        ("IMERG_V7_1H_zoom9_20200101_20200131.zarr", ("IMERG_V7", "1H", 9, "20200101", "20200131")),
        ("x_zoom9_20200101_20200131.zarr", ("x", None, 9, "20200101", "20200131")),
        ("X_30MIN_zoom9_20200101_20200131.zarr", ("X_30MIN", None, 9, "20200101", "20200131")),
        ("nothing.zarr", (None, None, None, None, None)),
    ],
)
def test_store_names(spark, name, expected):
    row = names.with_store_name_parts(spark.createDataFrame([(name,)], "name string")).first()
    got = (row.base_name, row.time_res, row.zoom, row.start_date, row.end_date)
    assert got == expected
    if expected[0]:
        assert tuple(names.parse_store_name(name).values()) == expected
    else:
        with pytest.raises(ValueError):
            names.parse_store_name(name)


@pytest.mark.parametrize("glob, name, hit", [("*_bnds", "lat_bnds", True), ("*_bnds", "lat_bnds2", False), ("t?s", "tas", True), ("a.b", "axb", False), ("v[0-9]", "v3", True), ("v[!0-9]", "v3", False)])
def test_globs(spark, glob, name, hit):
    assert one(spark, F.lit(name).rlike(names.glob_to_regex(glob))) is hit


def test_missing_to_null_and_storage_types(spark):
    df = spark.createDataFrame([(1, float("nan"), 2.5)], "cell bigint, a double, lat double")
    row = fields.missing_to_null(df).first()
    assert row.a is None and row.lat == 2.5
    assert dict(fields.to_storage_types(df).dtypes) == {"cell": "bigint", "a": "float", "lat": "double"}


def test_calendar_fields(spark):
    made = times.from_calendar_fields(F.lit(2021), F.lit(2), F.lit(30), F.lit(1), F.lit(2), F.lit(3))
    assert one(spark, made) is None
    made = times.from_calendar_fields(F.lit(2021), F.lit(2), F.lit(28), F.lit(1), F.lit(2), F.lit(3))
    assert one(spark, made) == dt.datetime(2021, 2, 28, 1, 2, 3)


def test_brightness_temperature(spark):
    tb = one(spark, fields.brightness_temperature(F.lit(240.0)))
    flux_t = (240.0 / 5.67e-8) ** 0.25
    assert math.isclose(1.228 * tb - 1.106e-3 * tb * tb, flux_t, rel_tol=1e-9)
