"""Cubes, grids and catalogs derived from the driver tables, and the same in DuckDB SQL.

The tables hold no climate data, so keys are folded onto cells, grid points and file names. Every
builder reads a whole table; the SQL text beside it gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.functions.healpix import npix
from spherecube.sources import catalog

# regular 10-degree grid that order keys are laid out on, one slice after the other
NX, NY = 36, 18
SLICE = NX * NY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_one_file(rows: DataFrame, path: str) -> None:
    """Write a table as one file of a given name, as data providers name theirs."""
    spark = rows.sparkSession
    made = f"{path}.made"
    rows.coalesce(1).write.parquet(made)
    name = spark.read.parquet(made).select("_metadata.file_path").first()[0]
    system, place = catalog.file_system(spark, path)
    system.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name), place)
    catalog.remove_path(spark, made)


# --- cell cubes ---------------------------------------------------------------------------------


def hp_events(spark: SparkSession, sf_dir: str, zoom: int) -> DataFrame:
    """Events as point observations on cells, with a quality flag and some missing values."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("time"),
        F.pmod(F.col("user_id") * 7919 + F.col("event_id"), F.lit(npix(zoom))).alias("cell"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"),
        ((F.col("event_id") % 100) / 100.0).alias("quality"),
        "event_id",
    )


def hp_events_sql(zoom: int) -> str:
    return f"""(SELECT ts AS time, (user_id * 7919 + event_id) % {npix(zoom)} AS cell,
        CASE WHEN event_id % 17 <> 0 THEN value END AS value,
        CAST(event_id % 100 AS DOUBLE) / 100 AS quality, event_id FROM events)"""


def hp_hourly(spark: SparkSession, sf_dir: str, zoom: int) -> DataFrame:
    from spherecube.operators.timeops import resample_mean

    return resample_mean(hp_events(spark, sf_dir, zoom), "1h", ["cell"], values=["value"])


def hp_hourly_sql(zoom: int) -> str:
    return f"""(SELECT time_bucket(INTERVAL 1 HOUR, time) AS time, cell, avg(value) AS value
        FROM {hp_events_sql(zoom)} GROUP BY 1, 2)"""


def lev_lineitem(spark: SparkSession, sf_dir: str, zoom: int) -> DataFrame:
    """Line items as values on levels 100..700."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy(
            F.col("l_shipdate").alias("time"),
            (F.col("l_linenumber") * 100).cast("double").alias("level"),
            F.pmod("l_partkey", F.lit(npix(zoom))).alias("cell"),
        )
        .agg(F.avg("l_quantity").alias("ta"), F.avg("l_discount").alias("hus"))
    )


def lev_lineitem_sql(zoom: int) -> str:
    return f"""(SELECT l_shipdate AS time, CAST(l_linenumber * 100 AS DOUBLE) AS level,
        l_partkey % {npix(zoom)} AS cell, avg(l_quantity) AS ta, avg(l_discount) AS hus
        FROM lineitem GROUP BY 1, 2, 3)"""


def sfc_orders(spark: SparkSession, sf_dir: str, zoom: int) -> DataFrame:
    """Orders as a surface field."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.col("o_orderdate").alias("time"), F.pmod("o_custkey", F.lit(npix(zoom))).alias("cell")
    ).agg(F.avg("o_totalprice").alias("ps"))


def sfc_orders_sql(zoom: int) -> str:
    return f"""(SELECT o_orderdate AS time, o_custkey % {npix(zoom)} AS cell, avg(o_totalprice) AS ps
        FROM orders GROUP BY 1, 2)"""


# --- gridded cubes ------------------------------------------------------------------------------


def obs_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as consecutive half-hourly slices of a regular grid; the last one is cut short."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    placed = o.select(
        F.expr(f"timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, cast(30 * (o_orderkey div {SLICE}) as int))").alias("time"),
        (key % SLICE).alias("src_idx"),
        F.floor((key % SLICE) / NX).alias("iy"),
        ((key % SLICE) % NX).alias("ix"),
        F.when(key % 97 != 0, F.col("o_totalprice") * 0.3183098861837907).alias("pr"),
    )
    return placed.withColumns(
        {"lat": F.col("iy") * 10.0 - 85.0, "lon": F.col("ix") * 10.0 + 5.0}
    ).withColumn("lin", F.col("lat") * 2.0 + 3.0)


def obs_orders_sql() -> str:
    return f"""(SELECT TIMESTAMP '2020-01-01' + to_minutes(CAST(30 * (o_orderkey // {SLICE}) AS BIGINT)) AS time,
        o_orderkey % {SLICE} AS src_idx, (o_orderkey % {SLICE}) // {NX} AS iy, (o_orderkey % {SLICE}) % {NX} AS ix,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice * CAST(0.3183098861837907 AS DOUBLE) END AS pr,
        CAST((o_orderkey % {SLICE}) // {NX} AS DOUBLE) * 10 - 85 AS lat,
        CAST((o_orderkey % {SLICE}) % {NX} AS DOUBLE) * 10 + 5 AS lon,
        (CAST((o_orderkey % {SLICE}) // {NX} AS DOUBLE) * 10 - 85) * 2 + 3 AS lin FROM orders)"""


def grid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points that occur in the gridded orders."""
    return obs_orders(spark, sf_dir).select("src_idx", "iy", "ix", "lon", "lat").distinct()


def points_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as scattered points of an unstructured grid."""
    c = table(spark, sf_dir, "customer")
    turn = F.col("c_custkey") * F.lit(137.50776405003785) / F.lit(360.0)
    rise = F.col("c_custkey") * F.lit(0.5698402909980532)
    return c.select(
        F.col("c_custkey").alias("src_idx"),
        ((turn - F.floor(turn)) * F.lit(360.0)).alias("lon"),
        (F.lit(-88.0) + F.lit(176.0) * (rise - F.floor(rise))).alias("lat"),
        "c_acctbal",
    )


def points_customers_sql() -> str:
    turn = "(c_custkey * CAST(137.50776405003785 AS DOUBLE) / CAST(360 AS DOUBLE))"
    rise = "(c_custkey * CAST(0.5698402909980532 AS DOUBLE))"
    return f"""(SELECT c_custkey AS src_idx, ({turn} - floor{turn}) * 360 AS lon,
        CAST(-88 AS DOUBLE) + CAST(176 AS DOUBLE) * ({rise} - floor{rise}) AS lat, c_acctbal FROM customer)"""


#: fixed values: corners of a window below 359 degrees that the first four customers are moved to
WINDOW_CORNERS = ((100.0, -60.0), (260.0, -60.0), (260.0, 60.0), (100.0, 60.0))


def points_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scattered points that span 359.9 degrees at every size of the tables."""
    pinned = F.when(F.col("src_idx") == 1, 0.0).when(F.col("src_idx") == 2, 359.9).otherwise(F.col("lon") * 359.0 / 360.0)
    return points_customers(spark, sf_dir).withColumn("lon", pinned)


def points_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scattered points inside a window, whose corners are points too."""
    points = points_customers(spark, sf_dir).withColumns({"lon": 100.0 + F.col("lon") * 160.0 / 360.0, "lat": F.col("lat") * 60.0 / 88.0})
    for k, corner in enumerate(WINDOW_CORNERS, 1):
        points = points.withColumns({c: F.when(F.col("src_idx") == k, v).otherwise(F.col(c)) for c, v in zip(("lon", "lat"), corner, strict=True)})
    return points


def cells_sql(zoom: int, source: str) -> str:
    """Centre of every cell in ``source`` (a subquery with a ``cell`` column), all columns kept."""
    n = 1 << zoom
    x = " + ".join(f"(((cell >> {2 * b}) & 1) << {b})" for b in range(zoom)) or "0"
    y = " + ".join(f"(((cell >> {2 * b + 1}) & 1) << {b})" for b in range(zoom)) or "0"
    return f"""(SELECT * EXCLUDE (hp_f, hp_x, hp_y, hp_jr, hp_nr, hp_s, hp_z, hp_jp),
        (hp_jp - (hp_s + 1) / CAST(2 AS DOUBLE)) * CAST(90 AS DOUBLE) / hp_nr AS lon, degrees(asin(hp_z)) AS lat
      FROM (SELECT * EXCLUDE (hp_j), CASE WHEN hp_j > {4 * n} THEN hp_j - {4 * n} WHEN hp_j < 1 THEN hp_j + {4 * n} ELSE hp_j END AS hp_jp
      FROM (SELECT *, (list_value(1,3,5,7,0,2,4,6,1,3,5,7)[hp_f + 1] * hp_nr + hp_x - hp_y + 1 + hp_s) // 2 AS hp_j
      FROM (SELECT *, CASE WHEN hp_jr < {n} THEN hp_jr WHEN hp_jr > {3 * n} THEN {4 * n} - hp_jr ELSE {n} END AS hp_nr,
        CASE WHEN hp_jr < {n} OR hp_jr > {3 * n} THEN 0 ELSE (hp_jr - {n}) & 1 END AS hp_s,
        CASE WHEN hp_jr < {n} THEN 1 - CAST(hp_jr * hp_jr AS DOUBLE) / {3 * n * n}
             WHEN hp_jr > {3 * n} THEN CAST(({4 * n} - hp_jr) * ({4 * n} - hp_jr) AS DOUBLE) / {3 * n * n} - 1
             ELSE CAST(({2 * n} - hp_jr) * 2 AS DOUBLE) / {3 * n} END AS hp_z
      FROM (SELECT *, (2 + hp_f // 4) * {n} - hp_x - hp_y - 1 AS hp_jr
      FROM (SELECT *, cell >> {2 * zoom} AS hp_f, {x} AS hp_x, {y} AS hp_y FROM {source}))))))"""


def all_cells_sql(zoom: int) -> str:
    return f"(SELECT range AS cell FROM range({npix(zoom)}))"


def regular_weights_sql(zoom: int, source: str | None = None) -> str:
    """Weights of the 10-degree grid by plain arithmetic: rows (cell, k, src_idx, w)."""
    return f"""(SELECT cell, k, src_idx, w FROM (SELECT cell,
        unnest([0, 1, 2]) AS k,
        unnest(CASE WHEN v <= u THEN [sw, se, ne] ELSE [sw, nw, ne] END) AS src_idx,
        unnest(CASE WHEN v <= u THEN [1 - u, u - v, v] ELSE [1 - v, v - u, u] END) AS w
      FROM (SELECT cell, (x - (5 + 10 * ix)) / 10 AS u, (lat - (10 * iy - 85)) / 10 AS v,
        iy * {NX} + ix AS sw, iy * {NX} + (ix + 1) % {NX} AS se,
        (iy + 1) * {NX} + ix AS nw, (iy + 1) * {NX} + (ix + 1) % {NX} AS ne
      FROM (SELECT cell, x, lat, CAST(floor((x - 5) / 10) AS BIGINT) AS ix,
          CAST(least(floor((lat + 85) / 10), {NY - 2}) AS BIGINT) AS iy
      FROM (SELECT cell, lat, CASE WHEN lon < 5 THEN lon + 360 ELSE lon END AS x
      FROM {cells_sql(zoom, source or all_cells_sql(zoom))} WHERE lat BETWEEN -85 AND 85)))))"""


# --- catalogs -----------------------------------------------------------------------------------


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written into the known file-name layouts, with unreadable names among them."""
    o = table(spark, sf_dir, "orders")
    stamp, dashed = F.date_format("o_orderdate", "yyyyMMdd"), F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 5
    name = (
        F.when(kind == 0, F.concat(F.lit("3B-HHR.MS.MRG.3IMERG."), stamp, F.lit("-S000000-E002959.0000.V07B.HDF5.nc4")))
        .when(kind == 1, F.concat(F.lit("merg_"), stamp, F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("_10km-pixel.nc")))
        .when(kind == 2, F.concat(F.lit("precipitation_"), dashed, F.lit("_v2.nc")))
        .when(kind == 3, F.concat(F.lit("run.20201399-"), F.col("o_orderkey").cast("string"), F.lit(".nc")))
        .otherwise(F.concat(F.lit("notes_"), F.col("o_orderkey").cast("string"), F.lit(".txt")))
    )
    return o.select(
        F.concat(F.lit("/data/"), F.date_format("o_orderdate", "yyyy"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit("/"), name).alias("path"),
        name.alias("name"),
        (F.col("o_orderkey") * 10).alias("bytes"),
    )


def file_names_sql() -> str:
    name = """CASE o_orderkey % 5
        WHEN 0 THEN '3B-HHR.MS.MRG.3IMERG.' || strftime(o_orderdate, '%Y%m%d') || '-S000000-E002959.0000.V07B.HDF5.nc4'
        WHEN 1 THEN 'merg_' || strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '_10km-pixel.nc'
        WHEN 2 THEN 'precipitation_' || strftime(o_orderdate, '%Y-%m-%d') || '_v2.nc'
        WHEN 3 THEN 'run.20201399-' || CAST(o_orderkey AS VARCHAR) || '.nc'
        ELSE 'notes_' || CAST(o_orderkey AS VARCHAR) || '.txt' END"""
    return f"""(SELECT '/data/' || strftime(o_orderdate, '%Y') || '/' || CAST(o_orderkey AS VARCHAR) || '/' || {name} AS path,
        {name} AS name, o_orderkey * 10 AS bytes FROM orders)"""


def store_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store names of three layouts, one per order."""
    o = table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    zoom = (F.col("o_orderkey") % 10).cast("string")
    kind = F.col("o_orderkey") % 4
    tail = F.concat(F.lit("zoom"), zoom, F.lit("_"), stamp, F.lit("_"), stamp, F.lit(".parquet"))
    name = (
        F.when(kind == 0, F.concat(F.lit("IMERG_V7_1H_"), tail))
        .when(kind == 1, F.concat(F.lit("run_"), tail))
        .when(kind == 2, F.concat(F.lit("X_30MIN_"), tail))
        .otherwise(F.concat(F.lit("log-"), F.col("o_orderkey").cast("string")))
    )
    return o.select("o_orderkey", name.alias("name"), F.col("o_orderdate").alias("made"))


def store_names_sql() -> str:
    tail = "'zoom' || CAST(o_orderkey % 10 AS VARCHAR) || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%Y%m%d') || '.parquet'"
    return f"""(SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'IMERG_V7_1H_' || {tail} WHEN 1 THEN 'run_' || {tail}
        WHEN 2 THEN 'X_30MIN_' || {tail} ELSE 'log-' || CAST(o_orderkey AS VARCHAR) END AS name, o_orderdate AS made FROM orders)"""


def span_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that cover one day, in month folders, for four variables."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_linenumber").distinct()
    stamp = F.date_format("l_shipdate", "yyyyMMdd")
    code = F.element_at(F.array(*[F.lit(c) for c in ("128_130_t", "128_133_q", "128_131_u", "999_000_x")]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    grid = F.when(F.col("l_linenumber") % 4 == 2, "uv").otherwise("sc")
    name = F.concat(F.lit("e5.oper.an.pl."), code, F.lit(".ll025"), grid, F.lit("."), stamp, F.lit("00_"), stamp, F.lit("23.nc"))
    return li.select(name.alias("name"), F.date_format("l_shipdate", "yyyyMM").alias("_m")).distinct().select(
        F.concat(F.lit("/era5/"), F.col("_m"), F.lit("/"), F.col("name")).alias("path"), "name"
    )


def span_files_sql() -> str:
    return """(SELECT DISTINCT '/era5/' || strftime(l_shipdate, '%Y%m') || '/' || name AS path, name FROM
        (SELECT l_shipdate, 'e5.oper.an.pl.' || list_value('128_130_t', '128_133_q', '128_131_u', '999_000_x')[l_linenumber % 4 + 1]
          || '.ll025' || CASE WHEN l_linenumber % 4 = 2 THEN 'uv' ELSE 'sc' END || '.' || strftime(l_shipdate, '%Y%m%d')
          || '00_' || strftime(l_shipdate, '%Y%m%d') || '23.nc' AS name FROM lineitem))"""


SPAN_VARIABLES = [
    {"var_code": "128_130_t", "var_name": "T", "grid_type": "sc"},
    {"var_code": "128_133_q", "var_name": "Q", "grid_type": "sc"},
    {"var_code": "128_131_u", "var_name": "U", "grid_type": "uv"},
]


def day_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one store per event day; some days have no store, a marker or enough bytes."""
    e = table(spark, sf_dir, "events")
    at, own = F.dayofmonth("ts"), F.to_date("ts")
    # events of the days without a store are in the store of the day before
    day = F.when(at.between(20, 22), F.date_sub(own, at - 19)).when(at % 7 == 3, F.date_sub(own, 1)).otherwise(own)
    per = e.withColumn("day", day).groupBy("day").agg(F.count("*").alias("n"))
    dom = F.dayofmonth("day")
    stamp = F.date_format("day", "yyyyMMdd")
    per = per.withColumn("store", F.concat(F.lit("ev_3H_zoom8_"), stamp, F.lit("_"), stamp))
    data = per.select("day", "store", F.lit("part-0.parquet").alias("name"), F.when(dom % 5 == 0, F.lit(1000).cast("bigint")).otherwise(F.col("n") * 100000).alias("bytes"))
    marks = per.filter(dom % 6 != 1).select("day", "store", F.lit("_SUCCESS").alias("name"), F.lit(0).cast("bigint").alias("bytes"))
    return data.unionByName(marks)


def day_stores_sql() -> str:
    return """(WITH per AS (SELECT day, count(*) AS n FROM (SELECT CAST(ts AS DATE) -
            CASE WHEN day(ts) BETWEEN 20 AND 22 THEN CAST(day(ts) - 19 AS INTEGER) WHEN day(ts) % 7 = 3 THEN 1 ELSE 0 END AS day FROM events) GROUP BY 1),
        kept AS (SELECT day, n, 'ev_3H_zoom8_' || strftime(day, '%Y%m%d') || '_' || strftime(day, '%Y%m%d') AS store FROM per)
        SELECT day, store, 'part-0.parquet' AS name, CASE WHEN day(day) % 5 = 0 THEN 1000 ELSE n * 100000 END AS bytes FROM kept
        UNION ALL SELECT day, store, '_SUCCESS', 0 FROM kept WHERE day(day) % 6 <> 1)"""


def cube_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in exchange form: the event type picks variable name and dimensions."""
    e = table(spark, sf_dir, "events")
    kind = (F.col("event_id") % 6).cast("int")
    name = F.element_at(F.array(*[F.lit(v) for v in ("pr", "time_bnds", "ta", "areas", "p_levs", "pr_err")]), kind + 1)
    dims = F.element_at(
        F.array(*[F.array(*[F.lit(d) for d in ds]) for ds in (("time", "lat", "lon"), ("time", "nv"), ("time", "lev", "lat", "lon"), ("lat", "lon"), ("lev",), ("time", "lon", "lat"))]),
        kind + 1,
    )
    return e.select(
        F.lit("ev").alias("dataset"), name.alias("var"), dims.alias("dims"), F.col("ts").alias("time"),
        F.lit(None).cast("double").alias("level"), F.col("event_id").alias("src_idx"), "value",
    )


def cube_long_sql() -> str:
    return """(SELECT 'ev' AS dataset, list_value('pr', 'time_bnds', 'ta', 'areas', 'p_levs', 'pr_err')[event_id % 6 + 1] AS var,
        list_value(['time','lat','lon'], ['time','nv'], ['time','lev','lat','lon'], ['lat','lon'], ['lev'], ['time','lon','lat'])[event_id % 6 + 1] AS dims,
        ts AS time, CAST(NULL AS DOUBLE) AS level, event_id AS src_idx, value FROM events)"""
