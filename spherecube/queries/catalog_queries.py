"""File and store catalogs: discovery, names, progress."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from spherecube.functions import names
from spherecube.functions.healpix import npix
from spherecube.operators import quality, variables
from spherecube.queries import fixtures as fx
from spherecube.queries.registry import query, rounded
from spherecube.session import scratch_path
from spherecube.sources import catalog, cubes, stores

START, END = dt.datetime(1996, 3, 1), dt.datetime(1997, 10, 31)
RANGE_SQL = "TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-10-31'"
SPAN_START, SPAN_END = dt.datetime(1996, 3, 10), dt.datetime(1996, 6, 20)


def _date_sql(pattern: str, form: str) -> str:
    return f"try_strptime(nullif(regexp_extract(name, '{pattern}', 1), ''), '{form}')"


@query(
    "S1_file_discovery",
    f"""SELECT path, {_date_sql(r"\.(\d{8})-", "%Y%m%d")} AS file_date FROM {fx.file_names_sql()}
    WHERE CAST(regexp_extract(path, '^/data/(\\d+)/', 1) AS INTEGER) BETWEEN 1996 AND 1997 AND name LIKE '3B-HHR%'
      AND {_date_sql(r"\.(\d{8})-", "%Y%m%d")} BETWEEN {RANGE_SQL}""",
)
def s1(spark, sf_dir):
    """Year folders, then the name wildcard, then the date in the name."""
    files = fx.file_names(spark, sf_dir)
    year = F.regexp_extract("path", r"^/data/(\d+)/", 1).cast("int")
    listed = files.filter(year.between(START.year, END.year) & F.col("name").rlike(names.glob_to_regex("3B-HHR*")))
    found = catalog.filter_files_by_date(listed, START, END, r"\.(\d{8})-", "%Y%m%d")
    return found.select("path", "file_date")


@query(
    "S2_filter_files_by_date",
    f"""SELECT path, name, bytes, {_date_sql(r"_(\d{10})_", "%Y%m%d%H")} AS file_date FROM {fx.file_names_sql()}
    WHERE {_date_sql(r"_(\d{10})_", "%Y%m%d%H")} BETWEEN {RANGE_SQL}""",
)
def s2(spark, sf_dir):
    return catalog.filter_files_by_date(fx.file_names(spark, sf_dir), START, END, r"_(\d{10})_", "%Y%m%d%H")


_SPAN_SQL = f"""(SELECT path, v AS var, CAST(file_start AS TIMESTAMP) AS file_start, CAST(file_end AS TIMESTAMP) AS file_end, month FROM
    (SELECT *, regexp_extract(path, '/(\\d{{6}})/', 1) AS month,
      strptime(regexp_extract(name, '\\.(\\d{{8}})\\d{{2}}_(\\d{{8}})\\d{{2}}\\.nc', 1), '%Y%m%d') AS file_start,
      strptime(regexp_extract(name, '\\.(\\d{{8}})\\d{{2}}_(\\d{{8}})\\d{{2}}\\.nc', 2), '%Y%m%d') AS file_end FROM {fx.span_files_sql()}) f
    JOIN (VALUES ('T', 'e5.oper.an.pl.128_130_t.ll025sc.%'), ('Q', 'e5.oper.an.pl.128_133_q.ll025sc.%'), ('U', 'e5.oper.an.pl.128_131_u.ll025uv.%')) q(v, pat)
      ON f.name LIKE q.pat
    WHERE file_start <= TIMESTAMP '1996-06-20' AND file_end >= TIMESTAMP '1996-03-10' AND month BETWEEN '199603' AND '199606')"""

_SPAN_TEMPLATE = "e5.oper.an.pl.{var_code}.ll025{grid_type}.{date_start}_{date_end}.nc"


@query("S3_variable_span_files", f"SELECT path, var, file_start, file_end FROM {_SPAN_SQL}")
def s3(spark, sf_dir):
    found = catalog.variable_span_files(fx.span_files(spark, sf_dir), fx.SPAN_VARIABLES, _SPAN_TEMPLATE, SPAN_START, SPAN_END)
    return found.select("path", "var", "file_start", "file_end")


@query("S3_first_file_of_month", f"SELECT var, month, min(path) AS path FROM {_SPAN_SQL} GROUP BY 1, 2")
def s3_monthly(spark, sf_dir):
    found = catalog.variable_span_files(
        fx.span_files(spark, sf_dir), fx.SPAN_VARIABLES, _SPAN_TEMPLATE, SPAN_START, SPAN_END, monthly_files=True
    )
    return found.select("var", "month", "path")


@query(
    "S4_multi_file_read",
    """SELECT event_id AS source_key, ts, value, CAST(NULL AS DOUBLE) AS o_totalprice FROM events
    UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice FROM orders""",
)
def s4(spark, sf_dir):
    """Files with different variables read as one; a variable absent from a file is NULL there."""
    both = cubes.read_cube(spark, [f"{sf_dir}/events.parquet", f"{sf_dir}/orders.parquet"])
    return both.select(F.coalesce("event_id", "o_orderkey").alias("source_key"), "ts", "value", "o_totalprice")


@query(
    "S5_load_report",
    """SELECT CAST(sum(n) AS BIGINT) AS steps, count(*) AS files,
      CASE WHEN sum(n) < count(*) THEN 'incomplete' WHEN sum(n) > count(*) THEN 'more_steps_than_files' ELSE 'complete' END AS verdict
    FROM (SELECT CAST(ts AS DATE) AS f, count(DISTINCT time_bucket(INTERVAL 1 HOUR, ts)) AS n FROM events GROUP BY 1)""",
)
def s5(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    cube = e.select(F.window("ts", "1 hour").start.alias("time"), F.to_date("ts").alias("source_file"))
    return cubes.load_report(cube)


@query(
    "S5_files_read",
    """SELECT CAST(sum(n) AS BIGINT) AS steps, count(*) AS files,
      CASE WHEN sum(n) < count(*) THEN 'incomplete' WHEN sum(n) > count(*) THEN 'more_steps_than_files' ELSE 'complete' END AS verdict
    FROM (SELECT CAST(ts AS DATE) AS f, count(DISTINCT time_bucket(INTERVAL 1 HOUR, ts)) AS n FROM events GROUP BY 1)""",
)
def s5_files(spark, sf_dir):
    """Steps against files of a record with one file a day, told apart by the reader's own file metadata."""
    e = fx.table(spark, sf_dir, "events")
    path = scratch_path(spark, "daily")
    e.select(F.window("ts", "1 hour").start.alias("time"), "value", F.to_date("ts").alias("day")).repartition("day").write.partitionBy("day").parquet(path)
    files = catalog.path_list(catalog.list_files(spark, [path], "*.parquet", recursive=True))
    return cubes.file_report(spark, files)


@query(
    "S7_catalog_requests",
    """SELECT 'click' AS dataset, 9 AS zoom, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(CAST(value AS FLOAT)), 2) AS total
    FROM events WHERE event_type = 'click' AND day(ts) % 2 = 0 GROUP BY 3""",
)
def s7_requests(spark, sf_dir):
    """A catalog written by data set, resolution, zoom and day, pruned by a table of requested days."""
    e = fx.table(spark, sf_dir, "events")
    cube = e.select(F.col("ts").alias("time"), F.pmod("user_id", F.lit(npix(9))).alias("cell"), "value", "event_type")
    root = scratch_path(spark, "catalog")
    for zoom in (9, 8):
        stores.write_catalog(cube.withColumnRenamed("event_type", "kind"), root, F.col("kind"), "1H", zoom)
    asked = e.select(F.col("event_type").alias("dataset"), F.lit(9).alias("zoom"), F.to_date("ts").alias("day"))
    asked = asked.filter((F.col("dataset") == "click") & (F.day("day") % 2 == 0)).distinct()
    rows = cubes.scan_requests(spark, root, asked)
    total = F.round(F.sum(F.col("value").cast("double")), 2)
    return rows.groupBy("dataset", "zoom", "day").agg(F.count("*").alias("n"), total.alias("total"))


@query(
    "S7_catalog_scan",
    """SELECT event_id, ts, value FROM events WHERE event_type = 'click' AND user_id % 3 + 5 = 6
      AND CASE WHEN event_id % 2 = 0 THEN '1H' ELSE '1D' END = '1H'""",
)
def s7(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    parts = e.withColumns(
        {"dataset": F.col("event_type"), "zoom": F.col("user_id") % 3 + 5, "time_res": F.when(F.col("event_id") % 2 == 0, "1H").otherwise("1D")}
    )
    return cubes.scan_catalog_table(parts, "click", 6, "1H").select("event_id", "ts", "value")


@query(
    "S9_daily_stores",
    f"""SELECT o_orderkey, name, try_strptime(nullif(regexp_extract(name, '_(\\d{{8}})_', 1), ''), '%Y%m%d') AS store_date
    FROM {fx.store_names_sql()} WHERE try_strptime(nullif(regexp_extract(name, '_(\\d{{8}})_', 1), ''), '%Y%m%d') BETWEEN {RANGE_SQL}""",
)
def s9(spark, sf_dir):
    named = fx.store_names(spark, sf_dir).drop("made")
    return catalog.daily_stores(named, START, END)


@query(
    "K7_store_name_parts",
    f"""SELECT o_orderkey, name,
      CASE WHEN name LIKE 'IMERG%' THEN 'IMERG_V7' WHEN name LIKE 'run%' THEN 'run' WHEN name LIKE 'X%' THEN 'X_30MIN' END AS base_name,
      CASE WHEN name LIKE 'IMERG%' THEN '1H' END AS time_res,
      try_cast(nullif(regexp_extract(name, 'zoom(\\d+)_', 1), '') AS INTEGER) AS zoom,
      nullif(regexp_extract(name, '_(\\d{{8}})_(\\d{{8}})', 1), '') AS start_date, nullif(regexp_extract(name, '_(\\d{{8}})_(\\d{{8}})', 2), '') AS end_date
    FROM {fx.store_names_sql()} WHERE name NOT LIKE 'log%'""",
)
def k7(spark, sf_dir):
    parts = names.with_store_name_parts(fx.store_names(spark, sf_dir).drop("made"))
    return parts.filter("base_name is not null")


@query(
    "V6_date_match_report",
    f"""SELECT CASE WHEN d IS NULL THEN 'unmatched' WHEN d BETWEEN {RANGE_SQL} THEN 'matched' ELSE 'out_of_range' END AS status, count(*) AS files
    FROM (SELECT {_date_sql(r"\.(\d{8})-", "%Y%m%d")} AS d FROM {fx.file_names_sql()}) GROUP BY 1""",
)
def v6(spark, sf_dir):
    return catalog.date_match_report(fx.file_names(spark, sf_dir), r"\.(\d{8})-", "%Y%m%d", START, END)


@query(
    "C7_name_patterns",
    f"""SELECT path, coalesce(regexp_extract(name, '_(\\d{{4}}-\\d{{2}}-\\d{{2}})_', 1), '') AS date_text,
      name LIKE 'merg!_%.nc' ESCAPE '!' AS is_merged, format('{{}}/{{:08d}}.bin', name, bytes) AS copy_name FROM {fx.file_names_sql()}""",
)
def c7(spark, sf_dir):
    files = fx.file_names(spark, sf_dir)
    return files.select(
        "path", F.regexp_extract("name", r"_(\d{4}-\d{2}-\d{2})_", 1).alias("date_text"),
        F.col("name").rlike(names.glob_to_regex("merg_*.nc")).alias("is_merged"),
        F.format_string("%s/%08d.bin", "name", "bytes").alias("copy_name"),
    )


@query("O1_O2_first_paths", f"SELECT path FROM {fx.file_names_sql()} ORDER BY path LIMIT 10")
def o1(spark, sf_dir):
    """A sorted preview: Spark takes the first rows per partition and merges those."""
    return fx.file_names(spark, sf_dir).select("path").orderBy("path").limit(10)


# --- requested variables ------------------------------------------------------------------------


@query(
    "P7_requested_variables",
    f"SELECT path, var FROM {_SPAN_SQL} WHERE var IN (SELECT 'TQU'[CAST(l_linenumber % 2 + 1 AS INTEGER)] FROM lineitem)",
)
def p7(spark, sf_dir):
    found = catalog.variable_span_files(fx.span_files(spark, sf_dir), fx.SPAN_VARIABLES, _SPAN_TEMPLATE, SPAN_START, SPAN_END)
    wanted = fx.table(spark, sf_dir, "lineitem").select(
        F.substring(F.lit("TQU"), (F.col("l_linenumber") % 2 + 1).cast("int"), F.lit(1)).alias("var")
    )
    return variables.requested_variables(found, wanted.distinct()).select("path", "var")


@query(
    "P7_unknown_variables",
    f"SELECT DISTINCT 'V' || CAST(l_linenumber AS VARCHAR) AS var FROM lineitem WHERE 'V' || CAST(l_linenumber AS VARCHAR) NOT IN (SELECT 'V' || CAST(o_orderkey % 5 AS VARCHAR) FROM orders)",
)
def p7_unknown(spark, sf_dir):
    wanted = fx.table(spark, sf_dir, "lineitem").select(F.concat(F.lit("V"), F.col("l_linenumber").cast("string")).alias("var")).distinct()
    known = fx.table(spark, sf_dir, "orders").select(F.concat(F.lit("V"), (F.col("o_orderkey") % 5).cast("string")).alias("var"))
    return variables.unknown_variables(known, wanted)


# --- progress -----------------------------------------------------------------------------------

_STATES_SQL = f"""(SELECT day, store, CAST(sum(bytes) AS BIGINT) AS bytes, max(CASE WHEN name = '_SUCCESS' THEN 1 ELSE 0 END) = 1 AS has_marker,
    CASE WHEN max(CASE WHEN name = '_SUCCESS' THEN 1 ELSE 0 END) = 0 THEN 'no commit marker' WHEN sum(bytes) < 1048576 THEN 'too small' END AS problem
    FROM {fx.day_stores_sql()} GROUP BY 1, 2)"""

_STATUS_SQL = f"""(SELECT d.day, coalesce(s.bytes, 0) AS bytes, s.problem, CASE WHEN s.store IS NULL THEN 'missing' WHEN s.problem IS NULL THEN 'complete' ELSE 'incomplete' END AS status
    FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS day) d
    LEFT JOIN {_STATES_SQL} s ON d.day = s.day)"""


def _status(spark, sf_dir):
    files = fx.day_stores(spark, sf_dir)
    states = quality.store_states(files).join(files.select("store", "day").distinct(), "store")
    return quality.day_status(quality.expected_days(spark, dt.date(2024, 1, 1), dt.date(2024, 2, 3)), states)


@query("V2_store_states", f"SELECT store, bytes, has_marker, problem FROM {_STATES_SQL}")
def v2(spark, sf_dir):
    return quality.store_states(fx.day_stores(spark, sf_dir))


@query("V1_day_status", f"SELECT * FROM {_STATUS_SQL}")
def v1(spark, sf_dir):
    return _status(spark, sf_dir)


@query(
    "V1_progress_summary",
    f"""SELECT status, count(*) AS days, CAST(sum(bytes) AS BIGINT) AS total_bytes, round(avg(bytes), 4) AS mean_bytes,
      round(count(*) * 100.0 / (SELECT count(*) FROM {_STATUS_SQL}), 6) AS percent FROM {_STATUS_SQL} GROUP BY 1""",
)
def v1_summary(spark, sf_dir):
    return rounded(rounded(quality.progress_summary(_status(spark, sf_dir)), "mean_bytes", digits=4), "percent")


@query(
    "W3_day_ranges",
    f"""SELECT min(day) AS start_day, max(day) AS end_day, count(*) AS n_days FROM
    (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS g FROM {_STATUS_SQL} WHERE status <> 'complete') GROUP BY g""",
)
def w3(spark, sf_dir):
    return quality.day_ranges(_status(spark, sf_dir).filter("status <> 'complete'"))


@query(
    "V7_daily_tasks",
    """SELECT strftime(day, '%Y-%m-%d') AS start_date, strftime(day, '%Y-%m-%d') AS end_date, 8 AS zoom, 3 AS factor
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""",
)
def v7(spark, sf_dir):
    days = fx.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return quality.daily_tasks(days, 8, 3)
