"""Grids, weights, remapping and variable selection."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from spherecube.functions import healpix
from spherecube.operators import gather, grids, remap, stats, triangulation, variables, weights
from spherecube.operators.timeops import keep_minute
from spherecube.plans import presets, workflows
from spherecube.queries import fixtures as fx
from spherecube.queries.registry import query, rounded
from spherecube.session import scratch_path
from spherecube.sources import stores

Z = 4
OBS = fx.obs_orders_sql()


def _weights(spark, sf_dir, zoom=Z):
    return weights.regular_weights(fx.grid_orders(spark, sf_dir), zoom, "orders")


def _cells_in_use(spark, sf_dir, zoom):
    return fx.hp_events(spark, sf_dir, zoom).select("cell").distinct()


# --- grids --------------------------------------------------------------------------------------


@query(
    "J3_points_from_axes",
    f"SELECT DISTINCT src_idx, iy, ix, lon, lat FROM {OBS}",
)
def j3(spark, sf_dir):
    obs = fx.obs_orders(spark, sf_dir)
    return grids.points_from_axes(grids.axis_table(obs, "iy", "lat"), grids.axis_table(obs, "ix", "lon"))


@query(
    "J3_points_from_columns",
    f"SELECT src_idx, round(lon, 6) AS lon, round(lat, 6) AS lat FROM {fx.points_customers_sql()}",
)
def j3_columns(spark, sf_dir):
    points = fx.points_customers(spark, sf_dir).withColumnRenamed("src_idx", "ncol")
    return rounded(grids.points_from_columns(points).drop("iy", "ix"), "lon", "lat")


@query(
    "A15_grid_summary",
    f"""SELECT count(*) AS n_points, min(lon) AS lon_min, max(lon) AS lon_max, min(lat) AS lat_min, max(lat) AS lat_max,
      (max(lon) - min(lon)) / (count(DISTINCT lon) - 1) AS dlon, (max(lat) - min(lat)) / (count(DISTINCT lat) - 1) AS dlat,
      CASE WHEN max(lon) - min(lon) >= 359 THEN 'global' ELSE 'regional' END AS extent
    FROM (SELECT DISTINCT src_idx, lon, lat FROM {OBS})""",
)
def a15(spark, sf_dir):
    return grids.grid_summary(fx.grid_orders(spark, sf_dir))


@query(
    "P9_flat_index",
    f"SELECT o_orderkey, (o_orderkey % {fx.SLICE}) // {fx.NX} * {fx.NX} + o_orderkey % {fx.NX} AS src_idx FROM orders",
)
def p9(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    iy = F.floor((F.col("o_orderkey") % fx.SLICE) / fx.NX)
    return o.select("o_orderkey", grids.flat_index(iy, F.col("o_orderkey") % fx.NX, fx.NX).alias("src_idx"))


@query(
    "P9_incomplete_slices",
    f"SELECT time, count(DISTINCT src_idx) AS n_points, {fx.SLICE} AS n_expected FROM {OBS} GROUP BY 1 HAVING count(DISTINCT src_idx) <> {fx.SLICE}",
)
def p9_slices(spark, sf_dir):
    sizes = grids.slice_sizes(fx.obs_orders(spark, sf_dir), fx.grid_orders(spark, sf_dir))
    return sizes.withColumn("n_expected", F.col("n_expected").cast("int"))


@query(
    "U3_shifted_copies",
    f"""SELECT src_idx, copy, round(lon + (copy - 1) * 360, 6) AS lon, round(lat, 6) AS lat
    FROM {fx.points_customers_sql()}, (SELECT CAST(range AS INTEGER) AS copy FROM range(3))""",
)
def u3(spark, sf_dir):
    return rounded(grids.shifted_copies(fx.points_customers(spark, sf_dir).drop("c_acctbal")), "lon", "lat")


@query("C8_periodic_index", "SELECT o_orderkey, ((o_orderkey - 7000) % 648 + 648) % 648 AS src_idx FROM orders")
def c8(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.pmod(F.col("o_orderkey") - 7000, F.lit(fx.SLICE)).alias("src_idx"))


# --- weights ------------------------------------------------------------------------------------


def _positions_back(w, points):
    """What the weights make of the points' own positions, cell by cell."""
    out = w.join(points.select("src_idx", "lon", "lat"), "src_idx").groupBy("cell").agg(
        F.count("*").cast("int").alias("vertices"), F.sum("w").alias("weight_sum"), F.sum(F.col("w") * F.col("lon")).alias("lon_back"),
        F.sum(F.col("w") * F.col("lat")).alias("lat_back"))
    return rounded(out, "weight_sum", "lon_back", "lat_back")


@query(
    "J1_weights_regular",
    f"""SELECT 'orders' AS grid_id, 7 AS zoom, cell, k, src_idx, round(w, 6) AS w FROM {fx.regular_weights_sql(7)}""",
)
def j1(spark, sf_dir):
    """Weights of the 10-degree grid for every cell of zoom 7."""
    return rounded(weights.regular_weights(fx.grid_orders(spark, sf_dir), 7, "orders"), "w")


@query(
    "J1_F7_region_remap",
    f"""SELECT time, w.cell AS cell, round(CASE WHEN count(pr) = 3 THEN sum(pr * w) END, 3) AS pr
    FROM {OBS} o JOIN {fx.regular_weights_sql(Z)} w ON o.src_idx = w.src_idx
    JOIN (SELECT cell FROM {fx.cells_sql(Z, fx.all_cells_sql(Z))} WHERE lon BETWEEN 115 AND 215 AND lat BETWEEN 5 AND 45) c ON c.cell = w.cell
    GROUP BY time, w.cell""",
)
def j1_region(spark, sf_dir):
    """A region cut from the grid keeps its own point numbers: weights and remap of the subset."""
    box = (F.col("lon").between(110, 220)) & (F.col("lat").between(0, 50))
    points = fx.grid_orders(spark, sf_dir).filter(box)
    w = workflows.weights_for(points, Z)
    obs = fx.obs_orders(spark, sf_dir).filter(box).select("time", "src_idx", "pr")
    return rounded(remap.apply_weights(obs, weights.require_fit(w, points), Z), "pr", digits=3)


@query(
    "J4_apply_weights_sparse",
    f"""SELECT time, CASE WHEN src_idx_in % 10 = 0 THEN 2.0 ELSE 1.0 END::DOUBLE AS level, cell, round(CASE WHEN count(pr) = 3 THEN sum(pr * w) END, 3) AS pr
    FROM (SELECT time, src_idx, src_idx AS src_idx_in, pr FROM {OBS}) o JOIN {fx.regular_weights_sql(Z)} w ON o.src_idx = w.src_idx GROUP BY 1, 2, 3""",
)
def j4_sparse(spark, sf_dir):
    """Slices with a tenth, and with nine tenths, of their points absent as rows."""
    obs = fx.obs_orders(spark, sf_dir)
    level = F.when(F.col("src_idx") % 10 == 0, 2.0).otherwise(1.0)
    return rounded(remap.apply_weights(obs.select("time", level.alias("level"), "src_idx", "pr"), _weights(spark, sf_dir), Z), "pr", digits=3)


@query(
    "J1_weights_curvilinear",
    f"""SELECT cell, 3 AS vertices, round(CAST(1 AS DOUBLE), 6) AS weight_sum, round(lon, 6) AS lon_back, round(lat, 6) AS lat_back
    FROM {fx.cells_sql(Z, fx.all_cells_sql(Z))}
    WHERE (3 * (lon - 100) + 0.4 * (lat + 30)) / 6.16 BETWEEN 0 AND {fx.NX - 1} AND (2 * (lat + 30) - 0.4 * (lon - 100)) / 6.16 BETWEEN 0 AND {fx.NY - 1}""",
)
def j1_curvilinear(spark, sf_dir):
    """A sheared and turned lattice, recognised as curvilinear: cells inside it get their own position back."""
    place = fx.grid_orders(spark, sf_dir).select(
        "iy", "ix", (F.lit(100.0) + 2.0 * F.col("ix") - 0.4 * F.col("iy")).alias("lon"), (F.lit(-30.0) + 3.0 * F.col("iy") + 0.4 * F.col("ix")).alias("lat"))
    points = grids.points_from_2d(place, fx.NX)
    return _positions_back(workflows.weights_for(points, Z), points)


@query(
    "J1_weights_auto_unstructured",
    f"""SELECT cell, 3 AS vertices, round(CAST(1 AS DOUBLE), 6) AS weight_sum, round(lat, 6) AS lat_back, true AS lon_fits
    FROM {fx.cells_sql(Z, fx.all_cells_sql(Z))}
    WHERE lat BETWEEN (SELECT min(lat) FROM {fx.points_customers_sql()}) AND (SELECT max(lat) FROM {fx.points_customers_sql()})""",
)
def j1_auto(spark, sf_dir):
    """Scattered points all round, through ``auto``; a vertex may stand one turn to either side of its point."""
    points = grids.points_from_columns(fx.points_round(spark, sf_dir), "src_idx")
    w = workflows.weights_for(points, Z)
    turns = F.array(*[F.array(*map(F.lit, t)) for t in itertools.product((-360.0, 0.0, 360.0), repeat=3)])
    shares = w.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("k", "w")))["w"].alias("_w"))
    here = healpix.with_cell_centers(_positions_back(w, points), Z).join(shares, "cell")
    fits = F.exists(turns, lambda t: F.abs(F.col("lon_back") + sum(F.col("_w")[k] * t[k] for k in range(3)) - F.col("lon")) < 1e-5)
    return here.select("cell", "vertices", "weight_sum", "lat_back", fits.alias("lon_fits"))


@query(
    "J1_weights_auto_gap",
    f"""SELECT cell, 3 AS vertices, round(CAST(1 AS DOUBLE), 6) AS weight_sum, round(lon, 6) AS lon_back, round(lat, 6) AS lat_back
    FROM {fx.cells_sql(Z, fx.all_cells_sql(Z))} WHERE lon BETWEEN 100 AND 260 AND lat BETWEEN -60 AND 60""",
)
def j1_gap(spark, sf_dir):
    """Scattered points that don't go round: ``auto`` closes no circle, and cells outside their hull get no weights."""
    points = grids.points_from_columns(fx.points_window(spark, sf_dir), "src_idx")
    return _positions_back(workflows.weights_for(points, Z), points)


@query(
    "J1_weights_unstructured",
    f"""SELECT cell, 3 AS vertices, round(CAST(1 AS DOUBLE), 6) AS weight_sum, round(lat, 6) AS lat_back
    FROM {fx.cells_sql(Z, fx.all_cells_sql(Z))}
    WHERE lat BETWEEN (SELECT min(lat) FROM {fx.points_customers_sql()}) AND (SELECT max(lat) FROM {fx.points_customers_sql()})""",
)
def j1_unstructured(spark, sf_dir):
    """Delaunay weights over scattered points.

    Repeated round the sphere, the points enclose every cell between their lowest and highest
    latitude, and weights of a true enclosing triangle give the cell's own latitude back. That
    triangles are Delaunay is tested against brute force on small sets.
    """
    points = fx.points_customers(spark, sf_dir)
    w = triangulation.triangulated_weights(points, Z, "customers", wrap=True)
    per = w.join(points.select("src_idx", "lat"), "src_idx").groupBy("cell").agg(
        F.count("*").cast("int").alias("vertices"), F.sum("w").alias("weight_sum"), F.sum(F.col("w") * F.col("lat")).alias("lat_back")
    )
    return rounded(per, "weight_sum", "lat_back")


@query(
    "K5_weights_cache",
    f"SELECT {Z} AS zoom, cell, k, src_idx, round(w, 6) AS w FROM {fx.regular_weights_sql(Z)}",
)
def k5(spark, sf_dir):
    """Built once, then read back: the second call finds a sound entry."""
    path = scratch_path(spark, "weights")
    points = fx.grid_orders(spark, sf_dir)
    workflows.weights_for(points, Z, grids.LATLON_1D, cache=path)
    again = workflows.weights_for(points, Z, grids.LATLON_1D, cache=path)
    return rounded(again.select("zoom", "cell", "k", "src_idx", "w"), "w")


@query(
    "V8_weights_fit_grid",
    f"""SELECT max(src_idx) AS max_src_idx, count(DISTINCT cell) AS valid_cells, count(*) AS weight_rows, {fx.SLICE} AS n_points, true AS fits
    FROM {fx.regular_weights_sql(Z)}""",
)
def v8(spark, sf_dir):
    fit = weights.weights_fit_grid(_weights(spark, sf_dir), fx.grid_orders(spark, sf_dir))
    return fit.withColumn("n_points", F.col("n_points").cast("int"))


# --- remap --------------------------------------------------------------------------------------

_REMAP_SQL = f"""(SELECT time, cell, CASE WHEN count(pr) = 3 THEN sum(pr * w) END AS pr, CASE WHEN count(lin) = 3 THEN sum(lin * w) END AS lin
    FROM {OBS} o JOIN {fx.regular_weights_sql(Z)} w ON o.src_idx = w.src_idx GROUP BY 1, 2)"""


def _remapped(spark, sf_dir, **kwargs):
    obs = fx.obs_orders(spark, sf_dir).select("time", "src_idx", "pr", "lin")
    return remap.apply_weights(obs, _weights(spark, sf_dir), Z, **kwargs)


@query("J4_apply_weights", f"SELECT time, cell, round(pr, 3) AS pr, round(lin, 3) AS lin FROM {_REMAP_SQL}")
def j4(spark, sf_dir):
    return rounded(_remapped(spark, sf_dir), "pr", "lin", digits=3)


@query("J4_apply_weights_blocked", f"SELECT time, cell, round(pr, 3) AS pr, round(lin, 3) AS lin FROM {_REMAP_SQL}")
def j4_blocked(spark, sf_dir):
    """The shuffle plan for weights too large to broadcast."""
    return rounded(_remapped(spark, sf_dir, broadcast=False, tile_levels=2, time_groups=4), "pr", "lin", digits=3)


_LEVEL_OBS = f"""(SELECT TIMESTAMP '2020-01-01' + to_hours(CAST(o_orderkey // {3 * fx.SLICE} AS INTEGER)) AS time,
    CAST(1000 - 250 * ((o_orderkey // {fx.SLICE}) % 3) AS DOUBLE) AS level, o_orderkey % {fx.SLICE} AS src_idx,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice * CAST(0.3183098861837907 AS DOUBLE) END AS ta FROM orders)"""


@query(
    "J4_apply_weights_levels",
    f"""SELECT time, level, cell, round(CASE WHEN count(ta) = 3 THEN sum(ta * w) END, 3) AS ta
    FROM {_LEVEL_OBS} o JOIN {fx.regular_weights_sql(Z)} w ON o.src_idx = w.src_idx GROUP BY 1, 2, 3""",
)
def j4_levels(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    obs = o.select(
        F.expr(f"timestamp_ntz'2020-01-01' + make_dt_interval(0, cast(o_orderkey div {3 * fx.SLICE} as int), 0, 0)").alias("time"),
        (1000.0 - 250.0 * (F.floor(key / fx.SLICE) % 3)).alias("level"), (key % fx.SLICE).alias("src_idx"),
        F.when(key % 97 != 0, F.col("o_totalprice") * 0.3183098861837907).alias("ta"),
    )
    return rounded(remap.apply_weights(obs, _weights(spark, sf_dir), Z), "ta", digits=3)


@query(
    "J5_densify",
    f"""SELECT t.time, c.cell, round(r.pr, 3) AS pr, round(r.lin, 3) AS lin
    FROM (SELECT DISTINCT time FROM {_REMAP_SQL}) t, {fx.all_cells_sql(Z)} c LEFT JOIN {_REMAP_SQL} r ON r.time = t.time AND r.cell = c.cell""",
)
def j5(spark, sf_dir):
    return rounded(_remapped(spark, sf_dir, dense=True), "pr", "lin", digits=3)


@query(
    "J4_gather_by_points",
    f"SELECT time, cell, round(pr, 3) AS pr, round(lin, 3) AS lin FROM {_REMAP_SQL}",
)
def j4_by_points(spark, sf_dir):
    """The layout for grids with many points, built once, stored, and read back: tiles of 8 by 8 source points."""
    points = fx.grid_orders(spark, sf_dir)
    numbering = gather.Numbering(*weights.linear_index(points), side=8)
    path, w = scratch_path(spark, "layout"), _weights(spark, sf_dir)
    for _ in range(2):
        layout = stores.cached_layout(spark, path, "orders", Z, w, numbering, lookup_limit=100)
    obs = fx.obs_orders(spark, sf_dir).select("time", "src_idx", "pr", "lin")
    return rounded(remap.apply_weights(obs, layout, Z), "pr", "lin", digits=3)


@query(
    "J5_invalid_cells",
    f"SELECT cell FROM {fx.all_cells_sql(Z)} WHERE cell NOT IN (SELECT cell FROM {fx.regular_weights_sql(Z)})",
)
def j5_invalid(spark, sf_dir):
    return remap.invalid_cells(_weights(spark, sf_dir), Z)


@query(
    "J4_repeated_points",
    f"""SELECT time, src_idx, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, src_idx FROM {OBS}) GROUP BY 1, 2 HAVING count(*) > 1""",
)
def j4_repeated(spark, sf_dir):
    obs = fx.obs_orders(spark, sf_dir).withColumn("time", F.window("time", "1 hour").start)
    return remap.repeated_points(obs.select("time", "src_idx", "pr"))


@query(
    "A13_conservation",
    f"""SELECT 'source' AS field, round(avg(pr), 4) AS mean, round(stddev_pop(pr), 4) AS std, count(pr) AS n FROM {OBS}
    UNION ALL SELECT 'remapped', round(avg(pr), 4), round(stddev_pop(pr), 4), count(pr) FROM {_REMAP_SQL}""",
)
def a13(spark, sf_dir):
    both = stats.conservation(fx.obs_orders(spark, sf_dir), _remapped(spark, sf_dir), "pr")
    return rounded(both, "mean", "std", digits=4)


# --- variables ----------------------------------------------------------------------------------


@query("P1_select_rename", "SELECT o_orderdate AS time, o_totalprice AS pr FROM orders")
def p1(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "time")
    return variables.select_rename(o, {"o_totalprice": "pr", "not_there": "x"})


@query("P2_select_rename_strict", "SELECT ts AS time, user_id AS cell, value AS pr FROM events")
def p2(spark, sf_dir):
    return variables.select_rename_strict(fx.table(spark, sf_dir, "events"), {"ts": "time", "user_id": "cell", "value": "pr"})


LONG = fx.cube_long_sql()


@query("P3_drop_skipped", f"SELECT src_idx, var FROM {LONG} WHERE var NOT IN ('time_bnds', 'pr_err', 'p_levs')")
def p3(spark, sf_dir):
    return variables.drop_skipped(fx.cube_long(spark, sf_dir), ["*_err", "p_l?vs"]).select("src_idx", "var")


@query("P4_required_dims", f"SELECT src_idx, var FROM {LONG} WHERE var IN ('pr', 'ta', 'pr_err', 'p_levs')")
def p4(spark, sf_dir):
    long = fx.cube_long(spark, sf_dir)
    return variables.with_required_dims(long, [["time", "lat", "lon"], ["lev"]]).select("src_idx", "var")


@query("P5_spatial_dims", f"SELECT src_idx, var FROM {LONG} WHERE list_contains(dims, 'lat') AND list_contains(dims, 'lon')")
def p5(spark, sf_dir):
    return variables.with_spatial_dims(fx.cube_long(spark, sf_dir), "lon", "lat").select("src_idx", "var")


@query("P6_copied_variables", f"SELECT src_idx, var FROM {LONG} WHERE NOT (list_contains(dims, 'lat') AND list_contains(dims, 'lon'))")
def p6(spark, sf_dir):
    return variables.without_spatial_dims(fx.cube_long(spark, sf_dir), "lon", "lat").select("src_idx", "var")


@query(
    "P6_passthrough",
    f"""SELECT time, level, cell, round(ta, 6) AS ta, hyam FROM {fx.lev_lineitem_sql(3)}
    JOIN (SELECT CAST(l_linenumber * 100 AS DOUBLE) AS level, max(l_linenumber / CAST(8 AS DOUBLE)) AS hyam FROM lineitem GROUP BY 1) USING (level)""",
)
def p6_side(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * 100).cast("double").alias("level"), (F.col("l_linenumber") / 8.0).alias("hyam"))
    side = variables.passthrough_table(li, ["hyam"])
    return rounded(variables.attach_passthrough(fx.lev_lineitem(spark, sf_dir, 3).drop("hus"), side), "ta")


@query(
    "S6_pivot_variables",
    f"""SELECT time_bucket(INTERVAL 1 MINUTE, time) AS time, max(CASE WHEN var = 'pr' THEN 1.0 END) AS pr, max(CASE WHEN var = 'ta' THEN 1.0 END) AS ta
    FROM {LONG} WHERE var IN ('pr', 'ta') GROUP BY 1""",
)
def s6_pivot(spark, sf_dir):
    long = fx.cube_long(spark, sf_dir).withColumns({"time": F.window("time", "1 minute").start, "value": F.lit(1.0)})
    return variables.pivot_long(long, ["pr", "ta"], ["time"])


# --- whole jobs ---------------------------------------------------------------------------------


@query(
    "Q1_Q2_remap_job",
    f"""WITH o AS (SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, src_idx, avg(pr) AS pr FROM {OBS}
        WHERE minute(time) <= 5 OR minute(time) >= 55 GROUP BY 1, 2)
    SELECT time, cell, round(CASE WHEN count(pr) = 3 THEN sum(pr * w) END, 3) AS precipitation
    FROM o JOIN {fx.regular_weights_sql(Z)} w ON o.src_idx = w.src_idx GROUP BY 1, 2""",
)
def q1(spark, sf_dir):
    """Half-hourly source, full hours kept, hourly mean, remap, rename."""
    obs = fx.obs_orders(spark, sf_dir).select("time", "src_idx", "pr", F.col("lin").alias("lat_bnds"))
    config = {"time_average": "1h", "skip_variables": ["*_bnds"], "remap_variables": {"pr": "precipitation"}, "fill": False}
    w = workflows.weights_for(fx.grid_orders(spark, sf_dir), Z)
    out = workflows.remap_cube(obs, w, Z, config, [keep_minute], [{"time_subset": "00min"}])
    return rounded(out, "precipitation", digits=3)


@query(
    "Q2_preset_job",
    f"""WITH n AS (SELECT time, dense_rank() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM {OBS}))
    SELECT r.time AS time, r.cell AS cell, round(CAST(CAST(pr AS FLOAT) AS DOUBLE), 3) AS tas, round(CAST(CAST(lin AS FLOAT) AS DOUBLE), 3) AS ps
    FROM {_REMAP_SQL} r JOIN n ON n.time = r.time WHERE i % 6 = 0""",
)
def q2(spark, sf_dir):
    """A preset as it stands, two of its ten variables there: files found by their names, every third hour, remapped, renamed, stored."""
    obs, points = fx.obs_orders(spark, sf_dir), fx.grid_orders(spark, sf_dir)
    base = scratch_path(spark, "reanalysis")
    for code, name, column in (("128_167_2t", "VAR_2T", "pr"), ("128_134_sp", "SP", "lin")):
        rows = obs.select("time", "src_idx", F.col(column).alias(name))
        fx.write_one_file(rows, f"{base}/202001/e5.oper.an.sfc.{code}.ll025sc.2020010100_2020013123.nc")
    config = {**presets.ERA5_SURFACE, "input_base_dir": base}
    store = workflows.process_to_cells(spark, "2020-01-01", "2020-01-31", Z, scratch_path(spark, "store"), points, config)
    return rounded(store.select("time", "cell", F.col("tas").cast("double").alias("tas"), F.col("ps").cast("double").alias("ps")), "tas", "ps", digits=3)


@query(
    "Q4_combine_and_merge",
    f"""SELECT coalesce(s.time, l.time) AS time, coalesce(s.cell, l.cell) AS cell, l.level, round(CAST(s.ps AS FLOAT), 1) AS ps, round(CAST(l.ta AS FLOAT), 3) AS ta
    FROM {fx.sfc_orders_sql(1)} s FULL JOIN {fx.lev_lineitem_sql(1)} l ON s.time = l.time AND s.cell = l.cell""",
)
def q4(spark, sf_dir):
    """Surface and level stores written, checked, merged, written again and read back."""
    paths = [scratch_path(spark, n) for n in ("surface", "levels", "merged")]
    stores.write_store(fx.sfc_orders(spark, sf_dir, 1), paths[0], 1, partition_by=("tile",))
    stores.write_store(fx.lev_lineitem(spark, sf_dir, 1).drop("hus"), paths[1], 1, partition_by=("tile",))
    merged = workflows.merge_stores(spark, *paths, 1, partition_by=("tile",))
    return rounded(rounded(merged.select("time", "cell", "level", "ps", "ta"), "ps", digits=1), "ta", digits=3)
