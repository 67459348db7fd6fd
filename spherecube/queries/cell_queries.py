"""Coarsening, statistics, merging, stores and validity checks over cell cubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from spherecube.functions import fields, healpix
from spherecube.functions.healpix import npix
from spherecube.operators import combine, quality, stats, timeops
from spherecube.operators import coarsen as co
from spherecube.plans import presets, workflows
from spherecube.queries import fixtures as fx
from spherecube.queries.registry import query, rounded
from spherecube.session import scratch_path
from spherecube.sources import catalog, cubes, stores

Z = 5


# --- cells --------------------------------------------------------------------------------------


@query(
    "C1_grid_facts",
    """SELECT zoom, CAST(pow(2, zoom) AS BIGINT) AS nside, CAST(12 * pow(4, zoom) AS BIGINT) AS npix,
      round(degrees(sqrt(4 * pi() / (12 * pow(4, zoom)))), 6) AS resolution_deg,
      CAST(CASE WHEN zoom < 8 THEN 12 * pow(4, zoom) ELSE 262144 END AS BIGINT) AS chunk_cells, n
    FROM (SELECT l_linenumber + 3 AS zoom, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def c1(spark, sf_dir):
    zooms = fx.table(spark, sf_dir, "lineitem").groupBy((F.col("l_linenumber") + 3).alias("zoom")).agg(F.count("*").alias("n"))
    return rounded(healpix.grid_facts(zooms), "resolution_deg")


@query(
    "C2_P10_cell_centers",
    f"SELECT event_id, cell, round(lon, 6) AS lon, round(lat, 6) AS lat FROM {fx.cells_sql(9, fx.hp_events_sql(9))}",
)
def c2(spark, sf_dir):
    placed = healpix.with_cell_centers(fx.hp_events(spark, sf_dir, 9), 9)
    return rounded(placed.select("event_id", "cell", "lon", "lat"), "lon", "lat")


@query("C3_parent_cell", f"SELECT event_id, cell, cell >> 6 AS parent FROM {fx.hp_events_sql(9)}")
def c3(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, 9)
    return e.select("event_id", "cell", healpix.parent_cell(F.col("cell"), 3).alias("parent"))


# --- coarsening ---------------------------------------------------------------------------------


@query(
    "A5_coarsen_direct",
    f"SELECT time, cell >> 6 AS cell, round(avg(value), 6) AS value FROM {fx.hp_hourly_sql(Z)} GROUP BY 1, 2",
)
def a5(spark, sf_dir):
    return rounded(co.coarsen(fx.hp_hourly(spark, sf_dir, Z), Z, Z - 3), "value")


@query(
    "A5_coarsen_levels",
    f"""SELECT time, level, cell >> 4 AS cell, round(avg(ta), 6) AS ta, round(avg(hus), 6) AS hus
    FROM {fx.lev_lineitem_sql(Z)} GROUP BY 1, 2, 3""",
)
def a5_levels(spark, sf_dir):
    return rounded(co.coarsen(fx.lev_lineitem(spark, sf_dir, Z), Z, Z - 2), "ta", "hus")


_PYRAMID_SQL = f"""WITH z4 AS (SELECT time, cell >> 2 AS cell, avg(value) AS value FROM {fx.hp_hourly_sql(Z)} GROUP BY 1, 2),
    z3 AS (SELECT time, cell >> 2 AS cell, avg(value) AS value FROM z4 GROUP BY 1, 2),
    z2 AS (SELECT time, cell >> 2 AS cell, avg(value) AS value FROM z3 GROUP BY 1, 2)
    SELECT 4 AS zoom, time, cell, round(value, 6) AS value FROM z4
    UNION ALL SELECT 3, time, cell, round(value, 6) FROM z3
    UNION ALL SELECT 2, time, cell, round(value, 6) FROM z2"""


@query("A6_coarsen_sequential", _PYRAMID_SQL)
def a6(spark, sf_dir):
    return rounded(co.all_levels(fx.hp_hourly(spark, sf_dir, Z), Z, 2), "value")


@query("A7_skip_existing", "SELECT DISTINCT l_linenumber AS zoom FROM lineitem WHERE l_linenumber NOT IN (3, 4)")
def a7(spark, sf_dir):
    """Levels 4 and 3 are stored; level 2 was begun and has no marker. The wanted ones are those without a marker."""
    root = scratch_path(spark, "levels")
    co.write_pyramid(fx.hp_hourly(spark, sf_dir, Z), Z, 2, root)
    catalog.remove_path(spark, f"{root}/zoom=2/_SUCCESS")
    wanted = fx.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("zoom")).distinct()
    return co.wanted_levels(wanted, co.stored_levels(spark, root))


@query(
    "A9_time_then_space",
    f"""WITH t AS (SELECT time_bucket(INTERVAL 6 HOUR, time, INTERVAL 3 HOUR) AS time, cell, avg(value) AS value
      FROM {fx.hp_hourly_sql(Z)} GROUP BY 1, 2)
    SELECT time, cell >> 4 AS cell, round(avg(value), 6) AS value FROM t GROUP BY 1, 2""",
)
def a9(spark, sf_dir):
    h = fx.hp_hourly(spark, sf_dir, Z)
    hours = timeops.target_hours_mean(h, [3, 9, 15, 21], ["cell"], fill=False)
    return rounded(co.coarsen(hours, Z, Z - 2), "value")


@query(
    "A9_subsample_then_space",
    f"""WITH h AS (SELECT * FROM {fx.hp_hourly_sql(Z)}),
    t AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM h))
    SELECT h.time, cell >> 4 AS cell, round(avg(value), 6) AS value FROM h JOIN t ON h.time = t.time AND t.i % 3 = 0 GROUP BY 1, 2""",
)
def a9_subsample(spark, sf_dir):
    h = fx.hp_hourly(spark, sf_dir, Z)
    return rounded(co.coarsen_time_and_space(h, Z, Z - 2, subsample=3, temporal_factor=9), "value")


# --- statistics ---------------------------------------------------------------------------------


@query("A10_time_mean", f"SELECT cell, round(avg(value) * 24, 6) AS value FROM {fx.hp_hourly_sql(Z)} GROUP BY 1")
def a10(spark, sf_dir):
    return rounded(stats.time_mean(fx.hp_hourly(spark, sf_dir, Z), scale=24.0), "value")


@query("A11_sphere_mean", f"SELECT time, round(avg(value * CAST(0.3183098861837907 AS DOUBLE)), 6) AS value FROM {fx.hp_hourly_sql(Z)} GROUP BY 1")
def a11(spark, sf_dir):
    """Mean over cells of the rescaled field (unscaled means of cents often end in an exact 5)."""
    h = fx.hp_hourly(spark, sf_dir, Z)
    scaled = h.withColumn("value", fields.rescale(F.col("value"), 0.3183098861837907))
    return rounded(stats.sphere_mean(scaled), "value")


@query(
    "A12_month_climatology",
    f"""SELECT CAST(month(time) AS INTEGER) AS month, level, cell, round(avg(ta), 6) AS ta, round(avg(hus), 6) AS hus
    FROM {fx.lev_lineitem_sql(3)} GROUP BY 1, 2, 3""",
)
def a12(spark, sf_dir):
    return rounded(stats.month_climatology(fx.lev_lineitem(spark, sf_dir, 3)), "ta", "hus")


@query(
    "A14_coverage",
    f"""SELECT min(time) AS time_min, max(time) AS time_max, min(value) AS value_min, max(value) AS value_max
    FROM {fx.hp_events_sql(Z)}""",
)
def a14(spark, sf_dir):
    return stats.coverage(fx.hp_events(spark, sf_dir, Z), "value")


@query(
    "A14_max_abs_difference",
    f"""SELECT round(max(abs(a.value - b.value)), 6) AS max_abs_diff, count(*) AS n FROM {fx.hp_hourly_sql(3)} a
    JOIN (SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, cell, max(value) AS value FROM {fx.hp_events_sql(3)} GROUP BY 1, 2) b
      ON a.time = b.time AND a.cell = b.cell""",
)
def a14_diff(spark, sf_dir):
    mean = fx.hp_hourly(spark, sf_dir, 3)
    e = fx.hp_events(spark, sf_dir, 3)
    top = e.groupBy(F.window("time", "1 hour").start.alias("time"), "cell").agg(F.max("value").alias("value"))
    return rounded(stats.max_abs_difference(mean, top, "value", ["time", "cell"]), "max_abs_diff")


@query(
    "A16_size_report",
    f"""SELECT CAST(time AS DATE) AS day, cell >> 18 AS tile, count(*) AS n_rows, count(DISTINCT time) AS steps,
      count(*) * 4 AS value_bytes, CAST(ceil(count(DISTINCT time) / 6.0) AS BIGINT) AS time_chunks
    FROM {fx.hp_hourly_sql(9)} GROUP BY 1, 2""",
)
def a16(spark, sf_dir):
    return stores.size_report(fx.hp_hourly(spark, sf_dir, 9), 9, time_chunk=6)


@query(
    "J10_step_difference",
    f"""SELECT time, cell, round(value, 6) AS value, round(value - lag(value) OVER (PARTITION BY cell ORDER BY time), 6) AS diff
    FROM {fx.hp_hourly_sql(3)}""",
)
def j10(spark, sf_dir):
    return rounded(stats.step_difference(fx.hp_hourly(spark, sf_dir, 3), "value"), "value", "diff")


@query(
    "J9_attach_static",
    f"""SELECT h.time, h.cell, round(h.value, 6) AS value, round(s.landfrac, 6) AS landfrac FROM {fx.hp_hourly_sql(Z)} h
    LEFT JOIN (SELECT c_custkey % {healpix.npix(Z)} AS cell, avg(c_acctbal) AS landfrac FROM customer GROUP BY 1) s ON h.cell = s.cell""",
)
def j9(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    static = c.groupBy((F.col("c_custkey") % healpix.npix(Z)).alias("cell")).agg(F.avg("c_acctbal").alias("landfrac"))
    return rounded(combine.attach_static(fx.hp_hourly(spark, sf_dir, Z), static, ["landfrac"]), "value", "landfrac")


# --- merging ------------------------------------------------------------------------------------


@query(
    "J7_merge_surface_levels",
    f"""SELECT coalesce(s.time, l.time) AS time, coalesce(s.cell, l.cell) AS cell, l.level, round(s.ps, 6) AS ps,
      round(l.ta, 6) AS ta, round(l.hus, 6) AS hus
    FROM {fx.sfc_orders_sql(3)} s FULL JOIN {fx.lev_lineitem_sql(3)} l ON s.time = l.time AND s.cell = l.cell""",
)
def j7(spark, sf_dir):
    merged = combine.merge_surface_levels(fx.sfc_orders(spark, sf_dir, 3), fx.lev_lineitem(spark, sf_dir, 3))
    return rounded(merged, "ps", "ta", "hus")


@query(
    "J8_premerge_checks",
    f"""WITH s AS (SELECT min(time) AS lo, max(time) AS hi, count(DISTINCT time) AS t, count(DISTINCT cell) AS c FROM {fx.sfc_orders_sql(3)}),
    l AS (SELECT min(time) AS lo, max(time) AS hi, count(DISTINCT time) AS t, count(DISTINCT cell) AS c FROM {fx.lev_lineitem_sql(3)})
    SELECT 'time_ranges_overlap' AS "check", 'error' AS severity, s.lo <= l.hi AND l.lo <= s.hi AS ok FROM s, l
    UNION ALL SELECT 'equal_cell_count', 'error', s.c = l.c FROM s, l
    UNION ALL SELECT 'no_shared_variables', 'error', true
    UNION ALL SELECT 'equal_step_count', 'warning', s.t = l.t FROM s, l
    UNION ALL SELECT 'has_level', 'warning', true""",
)
def j8(spark, sf_dir):
    return combine.premerge_checks(fx.sfc_orders(spark, sf_dir, 3), fx.lev_lineitem(spark, sf_dir, 3))


@query(
    "S6_merge_variables",
    f"""WITH a AS (SELECT time, cell, avg(value) AS pr FROM {fx.hp_hourly_sql(4)} GROUP BY 1, 2),
    b AS (SELECT time_bucket(INTERVAL 1 HOUR, time) + to_hours(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS time, cell, max(quality) AS qc FROM {fx.hp_events_sql(4)} GROUP BY 1, 2),
    c AS (SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, (cell + event_id % 2) % {npix(4)} AS cell, count(*) AS n FROM {fx.hp_events_sql(4)} GROUP BY 1, 2)
    SELECT time, cell, round(pr, 6) AS pr, qc, CAST(n AS DOUBLE) AS n FROM a FULL JOIN b USING (time, cell) FULL JOIN c USING (time, cell)""",
)
def s6(spark, sf_dir):
    """Three variables whose keys are alike in part only."""
    e = fx.hp_events(spark, sf_dir, 4).withColumn("time", F.window("time", "1 hour").start)
    later = F.col("time") + F.make_dt_interval(hours=F.when(F.col("event_id") % 3 == 0, 1).otherwise(0))
    beside = F.pmod(F.col("cell") + F.col("event_id") % 2, F.lit(npix(4)))
    parts = {
        "pr": fx.hp_hourly(spark, sf_dir, 4).withColumnRenamed("value", "pr"),
        "qc": e.groupBy(later.alias("time"), "cell").agg(F.max("quality").alias("qc")),
        "n": e.groupBy("time", beside.alias("cell")).agg(F.count("*").cast("double").alias("n"), F.max("quality").alias("qc")),
        "nothing": None,
    }
    return rounded(cubes.merge_variables(parts, ["time", "cell"]), "pr")


@query(
    "U1_concat_days",
    f"""SELECT time, cell, value FROM {fx.hp_events_sql(Z)} WHERE time < TIMESTAMP '2024-01-12'
    UNION ALL SELECT time, cell, value FROM {fx.hp_events_sql(Z)} WHERE time >= TIMESTAMP '2024-01-11'""",
)
def u1(spark, sf_dir):
    """Two stores that share a day: rows of that day appear twice."""
    e = fx.hp_events(spark, sf_dir, Z).select("time", "cell", "value")
    early, late = e.filter("time < timestamp_ntz'2024-01-12'"), e.filter("time >= timestamp_ntz'2024-01-11'")
    return cubes.concat_time([early, late])


_OTHER_NAMES_SQL = f"(SELECT CASE WHEN src_idx % 3 = 0 THEN var ELSE var || '_other' END AS var FROM {fx.cube_long_sql()})"


def _other_names(long):
    """Two variables in three go by another name."""
    return long.withColumn("var", F.when(F.col("src_idx") % 3 == 0, F.col("var")).otherwise(F.concat("var", F.lit("_other"))))


@query("U2_shared_names", f"SELECT DISTINCT var FROM {fx.cube_long_sql()} WHERE var IN (SELECT var FROM {_OTHER_NAMES_SQL})")
def u2(spark, sf_dir):
    long = fx.cube_long(spark, sf_dir)
    return combine.shared_names(long, _other_names(long))


@query("U2_absent_names", f"SELECT DISTINCT var FROM {fx.cube_long_sql()} WHERE var NOT IN (SELECT var FROM {_OTHER_NAMES_SQL})")
def u2_absent(spark, sf_dir):
    long = fx.cube_long(spark, sf_dir)
    return combine.absent_names(long.select("var").distinct(), _other_names(long))


# --- stores -------------------------------------------------------------------------------------


@query(
    "K1_S8_write_and_read_store",
    f"SELECT time, cell, round(CAST(value AS FLOAT), 3) AS value, CAST(time AS DATE) AS day, cell >> 18 AS tile FROM {fx.hp_hourly_sql(9)}",
)
def k1(spark, sf_dir):
    path = scratch_path(spark, "store")
    stores.write_store(fx.hp_hourly(spark, sf_dir, 9), path, 9, time_chunk=24)
    return rounded(stores.read_store(spark, path), "value", digits=3)


@query(
    "K2_storage_tile",
    f"SELECT event_id, a.cell >> 18 AS tile9, CAST(0 AS BIGINT) AS tile5 FROM {fx.hp_events_sql(9)} a",
)
def k2(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, 9)
    return e.select("event_id", healpix.tile(F.col("cell"), 9).alias("tile9"), healpix.tile(F.col("cell"), 5).alias("tile5"))


@query(
    "K4_storage_types",
    "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS FLOAT) AS o_totalprice FROM orders",
)
def k4(spark, sf_dir):
    return fields.to_storage_types(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))


@query(
    "K8_attributes",
    f"""SELECT dataset, 5 AS zoom, '32' AS nside, '12288' AS npix, 'healpix' AS mapping, n_steps FROM
    (SELECT event_type AS dataset, count(DISTINCT time_bucket(INTERVAL 1 HOUR, ts)) AS n_steps FROM events GROUP BY 1)""",
)
def k8(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    steps = e.groupBy(F.col("event_type").alias("dataset")).agg(F.countDistinct(F.window("ts", "1 hour").start).alias("n_steps"))
    out = stores.with_attributes(steps, 5, "latlon_1d")
    return out.select(
        "dataset", "zoom", F.col("attrs")["healpix_nside"].alias("nside"), F.col("attrs")["healpix_npix"].alias("npix"),
        F.col("attrs")["grid_mapping_name"].alias("mapping"), "n_steps",
    )


@query(
    "K8_stored_attributes",
    """SELECT CAST(z AS INTEGER) AS zoom, CAST(1 << z AS VARCHAR) AS nside, CAST(12 * (1 << (2 * z)) AS VARCHAR) AS npix, 'latlon_1d' AS original_grid,
      CAST(z + 1 AS VARCHAR) AS coarsened_from, 'means of 2 steps' AS temporal, (SELECT CAST(count(DISTINCT time_bucket(INTERVAL 1 HOUR, ts)) AS VARCHAR) FROM events) AS n_steps
    FROM generate_series(2, 4) t(z)""",
)
def k8_stored(spark, sf_dir):
    """Attributes of a store, handed on by the job that coarsens it and read back from beside each level."""
    source, root = scratch_path(spark, "fine"), scratch_path(spark, "levels")
    hourly = fx.hp_hourly(spark, sf_dir, Z)
    stores.write_store(hourly, source, Z)
    n_steps = hourly.select("time").distinct().count()
    for _ in range(2):  # saved again, not twice
        stores.save_attributes(spark, source, stores.attributes(Z, "latlon_1d", n_steps=n_steps))
    written = workflows.coarsen_store(spark, source, 2, root, start_zoom=Z, temporal_factor=2)
    found = [stores.load_attributes(spark, f"{root}/zoom={z}").withColumn("zoom", F.lit(z)) for z in written]
    names = {"healpix_nside": "nside", "healpix_npix": "npix", "original_grid": "original_grid", "coarsened_from": "coarsened_from", "temporal_coarsening": "temporal", "n_steps": "n_steps"}
    return cubes.concat_time(found).groupBy("zoom").pivot("key", list(names)).agg(F.first("value")).withColumnsRenamed(names)


_STORED_SQL = f"""WITH z4 AS (SELECT time, cell >> 2 AS cell, CAST(avg(CAST(value AS FLOAT)) AS FLOAT) AS value FROM {fx.hp_hourly_sql(Z)} GROUP BY 1, 2),
    z3 AS (SELECT time, cell >> 2 AS cell, CAST(avg(value) AS FLOAT) AS value FROM z4 GROUP BY 1, 2),
    z2 AS (SELECT time, cell >> 2 AS cell, CAST(avg(value) AS FLOAT) AS value FROM z3 GROUP BY 1, 2)
    SELECT 4 AS zoom, time, cell, round(CAST(value AS DOUBLE), 5) AS value FROM z4
    UNION ALL SELECT 3, time, cell, round(CAST(value AS DOUBLE), 5) FROM z3
    UNION ALL SELECT 2, time, cell, round(CAST(value AS DOUBLE), 5) FROM z2"""


@query("Q3_coarsen_stored_levels", _STORED_SQL)
def q3(spark, sf_dir):
    """The sequential levels again, each written and read back before the next."""
    source, root = scratch_path(spark, "fine"), scratch_path(spark, "levels")
    stores.write_store(fx.hp_hourly(spark, sf_dir, Z), source, Z)
    workflows.coarsen_store(spark, source, 2, root, start_zoom=Z)
    out = spark.read.parquet(root)
    return rounded(out.select("zoom", "time", "cell", F.col("value").cast("double").alias("value")), "value", digits=5)


_CATALOG_SQL = f"""WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, cell, CAST(avg(value) AS FLOAT) AS ta, CAST(max(quality) AS FLOAT) AS pr FROM {fx.hp_events_sql(Z)} GROUP BY 1, 2),
    n AS (SELECT time, dense_rank() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM h)),
    z4 AS (SELECT time, cell >> 2 AS cell, CAST(avg(ta) AS FLOAT) AS ta, CAST(avg(pr) AS FLOAT) AS pr FROM h JOIN n USING (time) WHERE i % 3 = 0 GROUP BY 1, 2),
    z3 AS (SELECT time, cell >> 2 AS cell, CAST(avg(ta) AS FLOAT) AS ta, CAST(avg(pr) AS FLOAT) AS pr FROM z4 GROUP BY 1, 2)
    SELECT 4 AS zoom, time, cell, round(CAST(ta AS DOUBLE), 4) AS ta, round(CAST(pr AS DOUBLE), 4) AS pr FROM z4
    UNION ALL SELECT 3, time, cell, round(CAST(ta AS DOUBLE), 4), round(CAST(pr AS DOUBLE), 4) FROM z3"""


@query("Q3_coarsen_catalog_source", _CATALOG_SQL)
def q3_catalog(spark, sf_dir):
    """One source of a stored catalog: variables by their model names, every third step, two levels."""
    e = fx.hp_events(spark, sf_dir, Z).withColumn("time", F.window("time", "1 hour").start)
    cube = e.groupBy("time", "cell").agg(F.avg("value").alias("t"), F.max("quality").alias("tp"), F.count("*").cast("double").alias("r"))
    home, root = scratch_path(spark, "catalog"), scratch_path(spark, "levels")
    stores.write_catalog(cube, home, "ifs", "1H", Z)
    stores.write_catalog(cube.withColumn("t", F.lit(0.0)), home, "other", "1H", Z)
    names = {old: presets.IFS_NAMES[old] for old in ("t", "tp")}
    workflows.coarsen_catalog(spark, home, "ifs", "1H", Z, 3, root, names, subsample=3)
    out = spark.read.parquet(root)
    return rounded(out.select("zoom", "time", "cell", F.col("ta").cast("double").alias("ta"), F.col("pr").cast("double").alias("pr")), "ta", "pr", digits=4)


@query(
    "Q5_month_folders",
    f"""SELECT CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, count(*) AS n, min(time) AS first_time, max(time) AS last_time
    FROM {fx.sfc_orders_sql(3)} GROUP BY 1, 2""",
)
def q5(spark, sf_dir):
    path = scratch_path(spark, "months")
    workflows.write_by_month(fx.sfc_orders(spark, sf_dir, 3), path)
    back = spark.read.parquet(path)
    return back.groupBy("year", "month").agg(F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


# --- validity -----------------------------------------------------------------------------------


@query(
    "V3_time_order",
    """SELECT count(*) AS steps, count(CASE WHEN t < p THEN 1 END) AS backward_steps, count(*) - count(DISTINCT t) AS repeated_steps
    FROM (SELECT t, lag(t) OVER (ORDER BY event_id) AS p FROM
      (SELECT event_id, date_trunc('minute', ts) - CASE WHEN event_id % 50 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS t FROM events))""",
)
def v3(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    minute = F.window("ts", "1 minute").start
    shifted = F.when(F.col("event_id") % 50 == 0, minute - F.expr("INTERVAL 2 HOURS")).otherwise(minute)
    steps = e.select("event_id", shifted.alias("time"))
    return quality.time_order_report(steps, "event_id")


@query(
    "V4_order_issues",
    f"""WITH s AS (SELECT event_type AS store, {{t}} AS time, min(event_id) AS first FROM events GROUP BY 1, 2),
    w AS (SELECT store, lag(time) OVER (PARTITION BY store ORDER BY first, time) >= time AS back FROM s)
    SELECT store, count(*) FILTER (back) AS n_not_increasing FROM w GROUP BY 1 HAVING count(*) FILTER (back) > 0""".replace(
        "{t}", "date_trunc('minute', ts) - CASE WHEN event_id % 50 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END"),
)
def v4_order(spark, sf_dir):
    """Stores whose steps don't rise in the order they are stored in."""
    e = fx.table(spark, sf_dir, "events")
    minute = F.window("ts", "1 minute").start
    shifted = F.when(F.col("event_id") % 50 == 0, minute - F.expr("INTERVAL 2 HOURS")).otherwise(minute)
    return quality.not_increasing(e.select(F.col("event_type").alias("store"), shifted.alias("time"), "event_id"), "event_id")


_V4_CUBE_SQL = f"""(SELECT 'day_' || strftime(time_bucket(INTERVAL 3 HOUR, time), '%d') AS store, time_bucket(INTERVAL 3 HOUR, time) AS time, cell,
      CASE WHEN day(min(time)) % 9 = 0 AND hour(min(time)) < 3 THEN NULL ELSE avg(value) END AS ta,
      CASE WHEN day(min(time)) % 10 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE max(quality) END AS pr
    FROM (SELECT time - to_hours(CASE WHEN day(time) = 12 AND hour(time) BETWEEN 9 AND 11 THEN 3 ELSE 0 END) AS time, cell, value, quality FROM {fx.hp_events_sql(1)})
    GROUP BY time_bucket(INTERVAL 3 HOUR, time), cell)"""


def _v4_cube(spark, sf_dir):
    # one day has no step at nine: what belongs there is counted with the step before
    moved = F.when((F.dayofmonth("time") == 12) & F.hour("time").between(9, 11), 3).otherwise(0)
    e = fx.hp_events(spark, sf_dir, 1).withColumn("time", F.col("time") - F.make_dt_interval(hours=moved))
    e = e.withColumn("bin", F.window("time", "3 hours").start)
    day, first_hours = F.dayofmonth("bin"), F.hour("bin") < 3
    cube = e.groupBy("bin", "cell").agg(F.avg("value").alias("ta"), F.max("quality").alias("pr"))
    return cube.select(
        F.concat(F.lit("day_"), F.date_format("bin", "dd")).alias("store"), F.col("bin").alias("time"), "cell",
        F.when(~((day % 9 == 0) & first_hours), F.col("ta")).alias("ta"),
        F.when(day % 10 == 0, F.lit(float("inf"))).otherwise(F.col("pr")).alias("pr"),
    )


_V4_SQL = f"""WITH c AS (SELECT * FROM {_V4_CUBE_SQL}),
    f AS (SELECT store, min(time) AS t0 FROM c GROUP BY 1),
    g AS (SELECT store, min(d) AS gmin, max(d) AS gmax, avg(d) AS gmean FROM
      (SELECT store, date_diff('second', lag(time) OVER (PARTITION BY store ORDER BY time), time) / 3600.0 AS d FROM (SELECT DISTINCT store, time FROM c)) GROUP BY 1),
    p AS (SELECT c.store, count(DISTINCT time) AS nt, count(DISTINCT cell) AS nc, count(*) AS n, count(ta) AS nta,
      count(CASE WHEN time = t0 THEN ta END) AS fta, max(pr) AS hpr, any_value(gmin) AS gmin, any_value(gmax) AS gmax, any_value(gmean) AS gmean
      FROM c JOIN f USING (store) JOIN g USING (store) GROUP BY 1)
    SELECT store, 'error' AS severity, 'missing variable omega' AS message FROM p
    UNION ALL SELECT store, CASE WHEN abs(nt - 8) <= 1 THEN 'warning' ELSE 'error' END, 'time has size ' || nt || ', expected 8' FROM p WHERE nt <> 8
    UNION ALL SELECT store, 'error', 'cell has size ' || nc || ', expected 48' FROM p WHERE nc <> 48
    UNION ALL SELECT store, 'error', 'missing dimension level' FROM p
    UNION ALL SELECT store, 'error', 'ta: first step is all missing' FROM p WHERE fta = 0
    UNION ALL SELECT store, CASE WHEN (n - nta) * 100.0 / n > 50 THEN 'error' ELSE 'warning' END, printf('ta: %.1f%% missing', CAST((n - nta) * 100.0 / n AS DOUBLE)) FROM p WHERE fta > 0 AND n > nta
    UNION ALL SELECT store, 'error', 'pr: infinite values' FROM p WHERE hpr = CAST('Infinity' AS DOUBLE)
    UNION ALL SELECT store, 'warning', printf('uneven time steps, mean %.2f h', CAST(gmean AS DOUBLE)) FROM p WHERE abs(gmin - 3) > 0.1 OR abs(gmax - 3) > 0.1"""

_V4_SIZES = {"time": 8, "cell": 48, "level": 25}


@query("V4_store_issues", _V4_SQL)
def v4(spark, sf_dir):
    return quality.store_issues(_v4_cube(spark, sf_dir), ["ta", "pr", "omega"], _V4_SIZES)


@query(
    "V4_value_stats",
    f"""SELECT 'ta' AS var, min(ta) AS min, max(ta) AS max, round((count(*) - count(ta)) * 100.0 / count(*), 6) AS missing_percent FROM {_V4_CUBE_SQL}
    UNION ALL SELECT 'pr', min(pr), max(pr), round((count(*) - count(pr)) * 100.0 / count(*), 6) FROM {_V4_CUBE_SQL}""",
)
def v4_stats(spark, sf_dir):
    return rounded(quality.value_stats(_v4_cube(spark, sf_dir), ["ta", "pr"]), "missing_percent")


@query(
    "V5_validation_summary",
    f"""WITH i AS ({_V4_SQL})
    SELECT s.store, count(CASE WHEN severity = 'error' THEN 1 END) AS n_errors, count(CASE WHEN severity = 'warning' THEN 1 END) AS n_warnings,
      coalesce(string_agg(CASE WHEN severity = 'error' THEN message END, '; ' ORDER BY message), '') AS errors,
      coalesce(string_agg(CASE WHEN severity = 'warning' THEN message END, '; ' ORDER BY message), '') AS warnings,
      count(CASE WHEN severity = 'error' THEN 1 END) = 0 AS valid
    FROM (SELECT DISTINCT store FROM {_V4_CUBE_SQL}) s LEFT JOIN i ON s.store = i.store GROUP BY 1""",
)
def v5(spark, sf_dir):
    cube = _v4_cube(spark, sf_dir)
    return quality.validation_summary(cube, quality.store_issues(cube, ["ta", "pr", "omega"], _V4_SIZES))
