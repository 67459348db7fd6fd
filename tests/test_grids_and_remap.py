import dataclasses
import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.operators import blocks, gather, grids, remap
from spherecube.operators.triangulation import triangulated_weights
from spherecube.operators.weights import regular_weights, weights_fit_grid
from spherecube.plans import workflows
from spherecube.sources import stores

T0 = dt.datetime(2020, 1, 1)


def axis(spark, name, position, numbers):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(numbers)], f"{position} bigint, {name} double")


def regular(spark, lats, lons):
    return grids.points_from_axes(axis(spark, "lat", "iy", lats), axis(spark, "lon", "ix", lons))


def back_interpolated(spark, weights, points, zoom):
    """Target coordinates rebuilt from the weights, beside the true ones."""
    per = weights.join(points.select("src_idx", "lon", "lat"), "src_idx").groupBy("cell").agg(
        F.count("*").alias("n"), F.sum("w").alias("s"), F.min("w").alias("w_min"),
        F.sum(F.col("w") * F.col("lat")).alias("lat_back"), F.sum(F.col("w") * F.col("lon")).alias("lon_back"),
    )
    return healpix.with_cell_centers(per, zoom).toPandas()


def test_grid_kinds():
    assert grids.grid_kind(1, 1, ["time", "ncol"]) == "unstructured"
    assert grids.grid_kind(1, 1, ["time", "lat", "lon"]) == "latlon_1d"
    assert grids.grid_kind(2, 2, ["south_north", "west_east"]) == "latlon_2d"
    with pytest.raises(ValueError):
        grids.grid_kind(1, 2, [])


def test_mesh_order(spark):
    rows = regular(spark, [10, 0], [5, 6, 7]).orderBy("src_idx").collect()
    assert [(r.src_idx, r.lat, r.lon) for r in rows] == [(0, 10, 5), (1, 10, 6), (2, 10, 7), (3, 0, 5), (4, 0, 6), (5, 0, 7)]


@pytest.mark.parametrize("descending", [False, True])
def test_global_regular_weights(spark, descending):
    lats = np.arange(-85, 90, 10.0)
    points = regular(spark, lats[::-1] if descending else lats, np.arange(5, 360, 10.0))
    pdf = back_interpolated(spark, regular_weights(points, 3, "g"), points, 3)
    inside = healpix.with_cell_centers(healpix.all_cells(spark, 3), 3).filter("lat between -85 and 85").count()
    assert len(pdf) == inside and (pdf.n == 3).all() and (pdf.w_min >= -1e-12).all()
    assert np.allclose(pdf.s, 1) and np.allclose(pdf.lat_back, pdf.lat)
    off_seam = pdf[(pdf.lon > 5) & (pdf.lon < 355)]
    assert np.allclose(off_seam.lon_back, off_seam.lon)


def test_uneven_axis_and_negative_longitudes(spark):
    points = regular(spark, [20, 21, 25, 40, 50], [-120, -118, -100, -99, -70])
    pdf = back_interpolated(spark, regular_weights(points, 5, "r"), points, 5)
    assert len(pdf) and np.allclose(pdf.lat_back, pdf.lat) and np.allclose(pdf.lon_back + 360, pdf.lon)
    assert pdf.lon.min() >= 240 and pdf.lon.max() <= 290


def test_duplicate_meridian(spark):
    points = regular(spark, np.linspace(-90, 90, 10), np.linspace(-180, 180, 20))
    pdf = back_interpolated(spark, regular_weights(points, 2, "small"), points, 2)
    assert len(pdf) == healpix.npix(2) and np.allclose(pdf.lat_back, pdf.lat)


def brute_delaunay(xy):
    """All triangles whose circumcircle holds no other point."""
    out = []
    for i, j, k in itertools.combinations(range(len(xy)), 3):
        (ax, ay), (bx, by), (cx, cy) = xy[i], xy[j], xy[k]
        d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by))
        if abs(d) < 1e-12:
            continue
        ux = ((ax**2 + ay**2) * (by - cy) + (bx**2 + by**2) * (cy - ay) + (cx**2 + cy**2) * (ay - by)) / d
        uy = ((ax**2 + ay**2) * (cx - bx) + (bx**2 + by**2) * (ax - cx) + (cx**2 + cy**2) * (bx - ax)) / d
        r2 = (ax - ux) ** 2 + (ay - uy) ** 2
        if not (((xy[:, 0] - ux) ** 2 + (xy[:, 1] - uy) ** 2) < r2 - 1e-9).any():
            out.append((i, j, k))
    return out


@pytest.mark.parametrize("points_per_leaf", [4, 9, 4096])
def test_scattered_points_match_brute_force(spark, points_per_leaf):
    rng = np.random.default_rng(7)
    # two thirds of the points crowd into one corner
    xy = np.concatenate([rng.uniform([100, -40], [200, 40], (25, 2)), rng.uniform([110, 0], [118, 8], (45, 2))])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "src_idx bigint, lon double, lat double")
    got = triangulated_weights(points, 4, "s", points_per_leaf=points_per_leaf).orderBy("cell", "k").toPandas()
    targets = healpix.with_cell_centers(healpix.all_cells(spark, 4), 4).toPandas()
    expected = {}
    for tri in brute_delaunay(xy):
        m = np.vstack([xy[list(tri)].T, np.ones(3)])
        w = np.linalg.solve(m, np.vstack([targets.lon, targets.lat, np.ones(len(targets))]))
        for c in targets.cell[(w >= -1e-12).all(axis=0)]:
            expected[int(c)] = set(tri)
    assert {int(c): set(g.src_idx) for c, g in got.groupby("cell")} == expected
    assert np.allclose(got.groupby("cell").w.sum(), 1)


def test_blocks_hold_their_points_and_halos(spark):
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.uniform(0, 100, (3000, 2)), rng.normal(20, 0.5, (3000, 2))])
    points = spark.createDataFrame([(float(x), float(y)) for x, y in xy], "px double, py double")
    found = blocks.split_nodes(points, (0.0, 100.0, 0.0, 100.0), len(xy), 50)
    own = found.locate(xy[:, 0], xy[:, 1])
    assert np.unique(own, return_counts=True)[1].max() <= 50 and len(np.unique(own)) < len(xy) / 5
    row, near = found.around(xy[:, 0], xy[:, 1], 0.25)
    pairs = set(zip(row.tolist(), near.tolist(), strict=True))
    assert len(pairs) == len(row) and set(enumerate(own.tolist())) <= pairs
    for block in np.unique(own).tolist():
        x_lo, x_hi, y_lo, y_hi = found.known(block, 0.25)
        inside = np.flatnonzero((xy[:, 0] > x_lo) & (xy[:, 0] < x_hi) & (xy[:, 1] > y_lo) & (xy[:, 1] < y_hi))
        assert {(int(k), block) for k in inside} <= pairs


def test_point_grid_radius_is_safe():
    rng = np.random.default_rng(4)
    xy, at = rng.normal(0, 1, (800, 2)), rng.uniform(-3, 3, (300, 2))
    grid = blocks.PointGrid(np.arange(800), xy[:, 0], xy[:, 1])
    for ring, most in ((1, 8), (3, 60)):
        ids, x, y, radius = grid.nearest(at[:, 0], at[:, 1], ring, most, 5000)
        for k, place in enumerate(at):
            within = np.flatnonzero(np.hypot(*(xy - place).T) < radius[k])
            assert set(within) <= set(ids[k])
            real = ids[k] >= 0
            assert np.array_equal(np.column_stack([x[k][real], y[k][real]]), xy[ids[k][real]]) and np.isnan(x[k][~real]).all()


def test_box_index_finds_every_box():
    rng = np.random.default_rng(5)
    low = rng.uniform(0, 90, (200, 2))
    boxes = np.column_stack([low[:, 0], low[:, 0] + 5, low[:, 1], low[:, 1] + 5])
    x, y = rng.uniform(0, 100, (2, 500))
    t, b = blocks.BoxIndex(boxes).hits(500, lambda t, box: (box[:, 0] <= x[t]) & (x[t] <= box[:, 1]) & (box[:, 2] <= y[t]) & (y[t] <= box[:, 3]))
    every = (boxes[:, 0] <= x[:, None]) & (x[:, None] <= boxes[:, 1]) & (boxes[:, 2] <= y[:, None]) & (y[:, None] <= boxes[:, 3])
    assert set(zip(t.tolist(), b.tolist(), strict=True)) == set(zip(*map(list, np.nonzero(every)), strict=True))


def test_curvilinear_lattice_reproduces_linear_field(spark):
    n = 20 * 30
    grid = spark.range(n).select((F.col("id") % 30).alias("ix"), F.floor(F.col("id") / 30).alias("iy"))
    coords = grid.select("iy", "ix", (180 + 1.5 * F.col("ix") - 0.3 * F.col("iy")).alias("lon"), (-10 + 1.2 * F.col("iy") + 0.3 * F.col("ix")).alias("lat"))
    points = grids.points_from_2d(coords, 30)
    pdf = back_interpolated(spark, triangulated_weights(points, 4, "c", points_per_leaf=64), points, 4)
    assert len(pdf) > 50 and np.allclose(pdf.lat_back, pdf.lat) and np.allclose(pdf.lon_back, pdf.lon)


def test_regular_and_triangulated_agree_on_a_linear_field(spark):
    points = regular(spark, np.arange(0, 31, 5.0), np.arange(10, 61, 5.0))
    a = back_interpolated(spark, regular_weights(points, 4, "a"), points, 4)
    b = back_interpolated(spark, triangulated_weights(points, 4, "b"), points, 4)
    assert set(a.cell) == set(b.cell) and np.allclose(sorted(a.lat_back), sorted(b.lat_back))


def test_duplicate_points_and_mismatched_lengths(spark):
    points = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 40.0, 0.0), (3, 0.0, 40.0)], "src_idx bigint, lon double, lat double")
    used = {r.src_idx for r in triangulated_weights(points, 2, "d").select("src_idx").collect()}
    assert used == {0, 2, 3}
    bad = spark.createDataFrame([(0, 1.0, None)], "ncol bigint, lon double, lat double")
    with pytest.raises(Exception, match="differ in length"):
        grids.points_from_columns(bad).collect()


@pytest.mark.parametrize("broadcast", [True, False])
def test_missing_vertex_blanks_the_cell(spark, broadcast):
    weights = spark.createDataFrame([(c, k, 3 * c + k, w) for c in range(2) for k, w in enumerate((0.5, 0.5, 0.0))], "cell bigint, k int, src_idx bigint, w double")
    cube = spark.createDataFrame([(T0, i, None if i == 5 else float(i), 2.0) for i in range(6)], "time timestamp_ntz, src_idx bigint, a double, b double")
    out = {r.cell: r for r in remap.apply_weights(cube, weights, 1, broadcast=broadcast, tile_levels=0, time_groups=3).collect()}
    assert out[0].a == 0.5 and out[1].a is None and out[1].b == 2.0
    dense = remap.apply_weights(cube, weights, 1, dense=True, broadcast=broadcast)
    assert dense.count() == 48 and dense.filter("b is not null").count() == 2


def test_repeated_steps_need_a_step_id(spark):
    weights = spark.createDataFrame([(0, k, k, 1 / 3) for k in range(3)], "cell bigint, k int, src_idx bigint, w double")
    rows = [(T0, i, float(f), f) for f in ("1", "2") for i in range(3)]
    cube = spark.createDataFrame(rows, "time timestamp_ntz, src_idx bigint, v double, source_file string")
    assert remap.repeated_points(cube).count() == 3
    with pytest.raises(Exception, match="given twice"):
        remap.apply_weights(cube, weights, 1).collect()
    told_apart = remap.apply_weights(remap.with_step_id(cube), weights, 1)
    assert sorted(round(r.v, 9) for r in told_apart.collect()) == [1.0, 2.0]


def test_remap_plans(spark, tmp_path):
    """Output rows come straight from the join: no exchange and no grouping above it."""
    points = regular(spark, np.arange(-85, 90, 10.0), np.arange(5, 360, 10.0))
    points.select(F.lit(T0).cast("timestamp_ntz").alias("time"), "src_idx", F.col("lat").alias("v"), F.col("lon").alias("unused")).write.parquet(str(tmp_path / "cube"))
    cube = spark.read.parquet(str(tmp_path / "cube"))
    weights = regular_weights(points, 3, "g")
    plan = remap.apply_weights(cube, weights, 3)._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("BroadcastHashJoin")]
    assert "Exchange" not in head and "Aggregate" not in head
    plan = remap.apply_weights(cube, weights, 3, values=["v"], broadcast=False)._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("ShuffledHashJoin")]
    assert "Exchange" not in head and "Aggregate" not in head
    # the arrays and the weights are joined where their one explicit repartition put them
    below = plan[plan.index("ShuffledHashJoin"):]
    assert below.count("hashpartitioning(_group") == 2 and below.count("REPARTITION_BY_NUM") == 2
    assert "ReadSchema: struct<time:timestamp_ntz,src_idx:bigint,v:double>" in plan


def _remap_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("numbering", [None, (36, 0)])
def test_cube_is_exchanged_once_for_grids_with_many_points(spark, tmp_path, numbering):
    """With tiles of source points only the exchange by step and tile moves the cube; every other table is broadcast."""
    points = regular(spark, np.arange(-85, 90, 10.0), np.arange(5, 360, 10.0))
    points.select(F.lit(T0).cast("timestamp_ntz").alias("time"), "src_idx", F.col("lat").alias("v")).write.parquet(str(tmp_path / "cube"))
    cube = spark.read.parquet(str(tmp_path / "cube"))
    w = regular_weights(points, 3, "g")
    by = gather.Numbering(*(numbering or (0, 0)), side=4)
    layout = stores.cached_layout(spark, str(tmp_path / "layout"), "g", 3, w, by, lookup_limit=10_000)
    assert layout.numbering is None  # few points: tiles of cells
    layout = stores.cached_layout(spark, str(tmp_path / "layout"), "g", 3, w, by, force=True, lookup_limit=600)
    if numbering is None:
        layout = dataclasses.replace(layout, lookup_is_small=True)
    assert layout.numbering == by and layout.lookup_is_small
    for dense in (False, True):
        out = remap.apply_weights(cube, layout, 3, dense=dense)
        plan = _remap_plan(out)
        above, below = plan[: plan.index("BroadcastHashJoin")], plan[plan.index("BroadcastHashJoin"):]
        assert "Exchange" not in above and plan.count("REPARTITION_BY_NUM") == 1
        if not dense:
            assert below.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in below
        got = out.orderBy("cell").toPandas()
        want = remap.apply_weights(cube, w, 3, dense=dense).orderBy("cell").toPandas()
        assert (got.cell == want.cell).all() and np.allclose(got.v, want.v, equal_nan=True)
    assert len(got) == 768


def test_places_of_source_points(spark):
    for by in (gather.Numbering(10, 3, 4), gather.Numbering(0, 0, 3)):
        tile, pos = by.place(F.col("id"))
        rows = spark.range(3, 3 + 70).select("id", tile.alias("tile"), pos.alias("pos")).collect()
        assert len({(r.tile, r.pos) for r in rows}) == 70
        for t in {r.tile for r in rows}:
            places = sorted(r.pos for r in rows if r.tile == t)
            assert by.stride == 0 or places == list(range(len(places)))


def test_dense_steps_without_points(spark):
    weights = spark.createDataFrame([(c, k, 3 * c + k, w) for c in range(2) for k, w in enumerate((0.5, 0.5, 0.0))], "cell bigint, k int, src_idx bigint, w double")
    rows = [(T0, 0, 1.0), (T0, 1, 3.0), (T0, 2, 5.0), (T0 + dt.timedelta(hours=1), 4, 7.0)]
    cube = spark.createDataFrame(rows, "time timestamp_ntz, src_idx bigint, v double")
    out = remap.apply_weights(cube, weights, 1, dense=True).toPandas()
    assert len(out) == 96 and out.v.notna().sum() == 1 and out.groupby("time").cell.nunique().eq(48).all()


def test_tile_sizes_do_not_change_values(spark):
    points = regular(spark, np.arange(-85, 90, 10.0), np.arange(5, 360, 10.0))
    weights = regular_weights(points, 3, "g")
    cube = points.filter("src_idx % 11 <> 3").select(
        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"), "src_idx", F.when(F.col("src_idx") % 7 != 0, F.sin("src_idx")).alias("v")
    ).select((F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, i)")).alias("time"), "src_idx", (F.col("v") * F.col("i")).alias("v"))
    plain = (
        cube.join(weights, "src_idx").groupBy("time", "cell").agg(F.when(F.count("v") == 3, F.sum(F.col("v") * F.col("w"))).alias("v"))
        .orderBy("time", "cell").toPandas()
    )
    for levels in (0, 2, 3):
        got = remap.apply_weights(cube, weights, 3, tile_levels=levels).orderBy("time", "cell").toPandas()
        assert (got.cell == plain.cell).all() and (got.time == plain.time).all()
        assert np.allclose(got.v, plain.v, equal_nan=True) and got.v.isna().any() and got.v.notna().any()


def test_weight_cache(spark, tmp_path):
    points = regular(spark, np.arange(-80, 81, 20.0), np.arange(0, 360, 20.0))
    path = str(tmp_path / "weights")
    calls = []

    def build():
        calls.append(1)
        return regular_weights(points, 2, "g")

    first = stores.cached_weights(spark, path, "g", 2, build)
    assert weights_fit_grid(first, points).first().fits
    stores.cached_weights(spark, path, "g", 2, build)
    assert len(calls) == 1
    # another grid is not served from this entry
    stores.cached_weights(spark, path, "h", 2, lambda: build().withColumn("grid_id", F.lit("h")))
    assert len(calls) == 2
    stores.cached_weights(spark, path, "g", 2, build, force=True)
    assert len(calls) == 3
    # an entry with a lost row is built again
    broken = str(tmp_path / "broken")
    stores.write_weights(build().filter("not (cell = 5 and k = 1)"), broken)
    calls.clear()
    assert stores.cached_weights(spark, broken, "g", 2, build).count() % 3 == 0 and len(calls) == 1


def test_grid_types(spark):
    points = regular(spark, np.arange(0, 31, 10.0), np.arange(10, 61, 10.0))
    assert workflows.build_weights(points, 2, "auto", "g").count() == workflows.build_weights(points, 2, "latlon_1d", "g").count()
    with pytest.raises(ValueError):
        workflows.build_weights(points, 2, "hexagonal", "g")
    summary = grids.grid_summary(points).first()
    assert (summary.n_points, summary.dlon, summary.dlat, summary.extent) == (24, 10.0, 10.0, "regional")
