"""Time selection, averaging, levels, masks and scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spherecube.functions import fields, healpix, times
from spherecube.operators import levels, masks, stats, timeops
from spherecube.operators import coarsen as co
from spherecube.queries import fixtures as fx
from spherecube.queries.registry import query, rounded

Z = 5


@query(
    "hourly_parent_mean",
    f"""SELECT time, cell >> 4 AS cell, round(avg(value), 6) AS value
    FROM {fx.hp_hourly_sql(Z)} GROUP BY 1, 2""",
)
def hourly_parent_mean(spark, sf_dir):
    """Hourly means on cells, then the mean of each parent two zooms up."""
    return rounded(co.coarsen(fx.hp_hourly(spark, sf_dir, Z), Z, Z - 2), "value")


@query(
    "F1_minute_of_hour",
    f"""SELECT event_id, time, cell, value FROM {fx.hp_events_sql(Z)}
    WHERE minute(time) <= 5 OR minute(time) >= 55""",
)
def f1(spark, sf_dir):
    return timeops.keep_minute(fx.hp_events(spark, sf_dir, Z), "00min").select("event_id", "time", "cell", "value")


@query(
    "F1_half_hour",
    f"""SELECT event_id, time, cell, value FROM {fx.hp_events_sql(Z)} WHERE minute(time) BETWEEN 25 AND 35""",
)
def f1b(spark, sf_dir):
    return timeops.keep_minute(fx.hp_events(spark, sf_dir, Z), "30min").select("event_id", "time", "cell", "value")


LEVEL_REQUEST = [500.005, 100.0, 300.0, 999.0, 100.0]


@query(
    "F2_level_selection",
    f"""SELECT time, l.level, cell, ord AS level_order, round(ta, 6) AS ta, round(hus, 6) AS hus
    FROM {fx.lev_lineitem_sql(Z)} l
    JOIN (VALUES (0, CAST(500.005 AS DOUBLE)), (1, 100.0), (2, 300.0), (3, 999.0), (4, 100.0)) q(ord, req)
      ON abs(l.level - q.req) < 0.01""",
)
def f2(spark, sf_dir):
    return rounded(levels.keep_levels(fx.lev_lineitem(spark, sf_dir, Z), LEVEL_REQUEST), "ta", "hus")


@query(
    "F3_every_interval",
    f"""SELECT time, cell, round(value, 6) AS value FROM {fx.hp_hourly_sql(Z)}
    WHERE time IN (SELECT time FROM (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i
      FROM (SELECT DISTINCT time FROM {fx.hp_hourly_sql(Z)})) WHERE i %
      (SELECT 21600 // date_diff('second', min(time), max(time)) FROM
        (SELECT DISTINCT time FROM {fx.hp_hourly_sql(Z)} ORDER BY time LIMIT 2)) = 0)""",
)
def f3(spark, sf_dir):
    return rounded(timeops.every_interval(fx.hp_hourly(spark, sf_dir, Z), "6h"), "value")


@query(
    "F4_every_nth",
    f"""SELECT time, cell, round(value, 6) AS value FROM {fx.hp_hourly_sql(Z)}
    WHERE time IN (SELECT time FROM (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i
      FROM (SELECT DISTINCT time FROM {fx.hp_hourly_sql(Z)})) WHERE i % 5 = 0)""",
)
def f4(spark, sf_dir):
    return rounded(timeops.every_nth(fx.hp_hourly(spark, sf_dir, Z), 5), "value")


@query(
    "F5_date_range",
    f"""SELECT event_id, time, cell, value FROM {fx.hp_events_sql(Z)}
    WHERE time >= TIMESTAMP '2024-01-05' AND time <= TIMESTAMP '2024-01-11 23:59:59'""",
)
def f5(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    return timeops.keep_dates(e, "2024-01-05", "20240111").select("event_id", "time", "cell", "value")


_F6_TEXT = """CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d ') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0')
    ELSE strftime(o_orderdate, '%d/%m/%Y') END"""


@query(
    "F6_parse_date",
    f"""SELECT o_orderkey, text,
      CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_orderdate
        ELSE o_orderdate + to_hours(o_orderkey % 24) END AS start_time,
      CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 86399 SECOND
        ELSE o_orderdate + to_hours(o_orderkey % 24) + INTERVAL 3599 SECOND END AS end_time
    FROM (SELECT o_orderkey, o_orderdate, {_F6_TEXT} AS text FROM orders)""",
)
def f6(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    kind, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    hour = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    text = (
        F.when(kind == 0, day)
        .when(kind == 1, F.concat(day, F.lit("T"), hour))
        .when(kind == 2, F.concat(day, F.lit(" "), hour))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    named = o.select("o_orderkey", text.alias("text"))
    return named.select(
        "o_orderkey", "text", times.parse_date(F.col("text")).alias("start_time"),
        times.parse_date(F.col("text"), end_of_period=True).alias("end_time"),
    )


@query(
    "F7_region",
    f"""SELECT event_id, cell, value, round(lon, 6) AS lon, round(lat, 6) AS lat
    FROM {fx.cells_sql(6, fx.hp_events_sql(6))} WHERE lat BETWEEN -30 AND 45 AND lon BETWEEN 100 AND 250""",
)
def f7(spark, sf_dir):
    placed = healpix.with_cell_centers(fx.hp_events(spark, sf_dir, 6), 6)
    kept = masks.keep_region(placed, (-30, 45), (100, 250))
    return rounded(kept.select("event_id", "cell", "value", "lon", "lat"), "lon", "lat")


@query(
    "F8_quality_mask",
    f"""SELECT event_id, time, cell, CASE WHEN quality >= 0.8 THEN value END AS value, quality
    FROM {fx.hp_events_sql(Z)}""",
)
def f8(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    masked = masks.quality_mask(e, "quality", 0.8, values=["value"])
    return masked.select("event_id", "time", "cell", "value", "quality")


@query(
    "F8_quality_mask_value",
    f"""SELECT event_id, CASE WHEN quality >= 0.5 THEN value ELSE -999.0 END AS value FROM {fx.hp_events_sql(Z)}""",
)
def f8b(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    return masks.quality_mask(e, "quality", 0.5, mask_value=-999.0, values=["value"]).select("event_id", "value")


@query(
    "F9_where",
    f"""SELECT event_id, cell, CASE WHEN lat > -30 AND lat < 30 AND value > 0 THEN value END AS value
    FROM {fx.cells_sql(Z, fx.hp_events_sql(Z))}""",
)
def f9(spark, sf_dir):
    placed = healpix.with_cell_centers(fx.hp_events(spark, sf_dir, Z), Z)
    tropics = (F.col("lat") > -30) & (F.col("lat") < 30) & (F.col("value") > 0)
    return masks.where(placed, tropics, ["value"]).select("event_id", "cell", "value")


@query(
    "F10_time_slice",
    f"""SELECT event_id, time, value FROM {fx.hp_events_sql(Z)}
    WHERE time >= TIMESTAMP '2024-01-03 06:00:00' AND time < TIMESTAMP '2024-01-10 00:00:00'""",
)
def f10(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    return timeops.slice_labels(e, "2024-01-03T06", "2024-01-09T23").select("event_id", "time", "value")


@query(
    "F11_index_pick",
    f"""WITH t AS (SELECT time, row_number() OVER (ORDER BY time) AS n, count(*) OVER () AS c
      FROM (SELECT DISTINCT time FROM {fx.hp_hourly_sql(Z)}))
    SELECT h.time, h.cell, round(h.value, 6) AS value FROM {fx.hp_hourly_sql(Z)} h JOIN t ON h.time = t.time
    WHERE n = 11 OR n = c""",
)
def f11(spark, sf_dir):
    h = fx.hp_hourly(spark, sf_dir, Z)
    return rounded(timeops.step_at(h, 10).unionByName(timeops.step_at(h, -1)), "value")


@query(
    "A1_temporal_average",
    f"""SELECT time_bucket(INTERVAL 3 HOUR, time) AS time, cell, round(avg(value), 6) AS value
    FROM {fx.hp_events_sql(Z)} GROUP BY 1, 2""",
)
def a1(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    return rounded(timeops.resample_mean(e, "3h", ["cell"], values=["value"]), "value")


@query(
    "A1_uneven_bins_filled",
    f"""WITH e AS (SELECT time_bucket(INTERVAL 2 HOUR, time) + to_minutes(minute(time) % 40) AS time, cell, value FROM {fx.hp_events_sql(2)}),
    b AS (SELECT o + to_seconds(CAST(floor(date_diff('second', o, time) / 2400) * 2400 AS BIGINT)) AS time, cell, value FROM e,
      (SELECT date_trunc('day', min(time)) AS o FROM e)),
    m AS (SELECT time, cell, avg(value) AS value FROM b GROUP BY 1, 2),
    g AS (SELECT unnest(generate_series((SELECT min(time) FROM b), (SELECT max(time) FROM b), INTERVAL 2400 SECOND)) AS time
      EXCEPT SELECT time FROM b)
    SELECT time, cell, round(value, 6) AS value FROM m
    UNION ALL SELECT g.time, k.cell, NULL FROM g, (SELECT DISTINCT cell FROM b) k""",
)
def a1_fill(spark, sf_dir):
    """Forty-minute bins, of which two in three are empty: empty bins come out as NULL rows."""
    moved = F.window("time", "2 hours")["start"] + F.make_dt_interval(mins=(F.minute("time") % 40).cast("int"))
    e = fx.hp_events(spark, sf_dir, 2).withColumn("time", moved)
    return rounded(timeops.resample_mean(e, "40min", ["cell"], values=["value"], fill=True), "value")


@query(
    "A1_bins_from_first_day",
    f"""WITH e AS (SELECT * FROM {fx.hp_events_sql(Z)})
    SELECT o + to_seconds(CAST(floor(date_diff('second', o, time) / 18000) * 18000 AS BIGINT)) AS time, cell,
      round(avg(value), 6) AS value
    FROM e, (SELECT date_trunc('day', min(time)) AS o FROM e) GROUP BY 1, 2""",
)
def a1_anchor(spark, sf_dir):
    """Five-hour bins do not divide the day, so they count from the first midnight."""
    return rounded(timeops.resample_mean(fx.hp_events(spark, sf_dir, Z), "5h", ["cell"], values=["value"]), "value")


@query(
    "A2_target_hours",
    f"""SELECT time_bucket(INTERVAL 6 HOUR, time, INTERVAL 3 HOUR) AS time, cell, round(avg(value), 6) AS value
    FROM {fx.hp_events_sql(Z)} GROUP BY 1, 2""",
)
def a2(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z).select("time", "cell", "value")
    return rounded(timeops.target_hours_mean(e, [3, 9, 15, 21], ["cell"], fill=False), "value")


@query(
    "A2_alignment_check",
    f"""SELECT DISTINCT CAST(hour(time_bucket(INTERVAL 6 HOUR, time, INTERVAL 3 HOUR)) AS INTEGER) AS hour
    FROM {fx.hp_events_sql(Z)}
    WHERE hour(time_bucket(INTERVAL 6 HOUR, time, INTERVAL 3 HOUR)) NOT IN (3, 9)""",
)
def a2_check(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z).select("time", "cell", "value")
    return timeops.misaligned_hours(timeops.target_hours_mean(e, [3, 9], ["cell"], fill=False), [3, 9])


@query(
    "A3_block_mean",
    f"""WITH h AS (SELECT * FROM {fx.hp_hourly_sql(Z)}),
    t AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT time FROM h)),
    b AS (SELECT time, i // 7 AS block FROM t WHERE (i // 7 + 1) * 7 <= n),
    s AS (SELECT block, min(time) AS start FROM b GROUP BY 1)
    SELECT s.start AS time, h.cell, round(avg(h.value), 6) AS value
    FROM h JOIN b ON h.time = b.time JOIN s ON b.block = s.block GROUP BY 1, 2""",
)
def a3(spark, sf_dir):
    return rounded(timeops.block_mean(fx.hp_hourly(spark, sf_dir, Z), 7, ["cell"]), "value")


@query(
    "A4_resolution_label",
    """SELECT l_orderkey, label, factor,
      CASE WHEN label LIKE '%H' AND n >= 24 AND n % 24 = 0 THEN CAST(n // 24 AS VARCHAR) || 'D'
           WHEN label LIKE '%H' THEN CAST(n AS VARCHAR) || 'H'
           WHEN label LIKE '%D' THEN CAST(n AS VARCHAR) || 'D' ELSE label END AS new_label
    FROM (SELECT *, CASE WHEN label LIKE '%N' THEN 0 ELSE CAST(l_linenumber AS BIGINT) * factor END AS n FROM
      (SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) || CASE l_orderkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'D' ELSE 'MIN' END AS label,
        8 AS factor FROM lineitem))""",
)
def a4(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    unit = F.element_at(F.array(F.lit("H"), F.lit("D"), F.lit("MIN")), (F.col("l_orderkey") % 3 + 1).cast("int"))
    labelled = li.select("l_orderkey", F.concat(F.col("l_linenumber").cast("string"), unit).alias("label"), F.lit(8).alias("factor"))
    return labelled.withColumn("new_label", times.coarser_label(F.col("label"), 8))


@query(
    "W1_step_index",
    f"""SELECT time, row_number() OVER (ORDER BY time) - 1 AS idx, CAST(count(*) OVER () AS BIGINT) AS n_steps
    FROM (SELECT DISTINCT time FROM {fx.hp_events_sql(Z)})""",
)
def w1(spark, sf_dir):
    return timeops.time_index(fx.hp_events(spark, sf_dir, Z))


@query(
    "W2_step_spacing",
    f"""SELECT time, round(date_diff('microsecond', lag(time) OVER (ORDER BY time), time) / 1e6, 6) AS spacing_s
    FROM (SELECT DISTINCT time FROM {fx.hp_events_sql(Z)})""",
)
def w2(spark, sf_dir):
    return rounded(timeops.step_spacing(fx.hp_events(spark, sf_dir, Z)), "spacing_s")


@query(
    "C4_brightness_temperature",
    """SELECT o_orderkey, round((sqrt(1.228 * 1.228 + 4 * -0.001106 * pow(olr / 5.67e-8, 0.25)) - 1.228) / (2 * -0.001106), 6) AS tb
    FROM (SELECT o_orderkey, CAST(80 AS DOUBLE) + CAST(o_orderkey % 250 AS DOUBLE) AS olr FROM orders)""",
)
def c4(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    olr = F.lit(80.0) + (F.col("o_orderkey") % 250).cast("double")
    return o.select("o_orderkey", F.round(fields.brightness_temperature(olr), 6).alias("tb"))


@query(
    "C5_calendar_fields",
    """SELECT o_orderkey, try_cast(printf('%04d-%02d-%02d %02d:30:15', y, m, d, h) AS TIMESTAMP) AS time
    FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey % 31 + 1 AS d, o_orderkey % 24 AS h FROM orders)""",
)
def c5(spark, sf_dir):
    """Day 1..31 in every month: dates that do not exist become NULL."""
    o = fx.table(spark, sf_dir, "orders")
    day, hour = (F.col("o_orderkey") % 31 + 1).cast("int"), (F.col("o_orderkey") % 24).cast("int")
    made = times.from_calendar_fields(F.year("o_orderdate"), F.month("o_orderdate"), day, hour, F.lit(30), F.lit(15))
    return o.select("o_orderkey", made.alias("time"))


@query(
    "C6_date_format",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS minute_text,
      CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month FROM events""",
)
def c6(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return e.select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("day"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute_text"),
        F.hour("ts").alias("hour"), F.month("ts").alias("month"),
    )


@query(
    "P11_field_arithmetic",
    f"""SELECT time, level, cell, round(ta - 273.15, 6) AS ta_celsius, round(hus * 3600000, 4) AS hus_scaled,
      round(ta - hus, 6) AS diff FROM {fx.lev_lineitem_sql(Z)}""",
)
def p11(spark, sf_dir):
    lev = fx.lev_lineitem(spark, sf_dir, Z)
    return lev.select(
        "time", "level", "cell", F.round(fields.rescale(F.col("ta"), offset=-273.15), 6).alias("ta_celsius"),
        F.round(fields.rescale(F.col("hus"), 3_600_000), 4).alias("hus_scaled"), F.round(F.col("ta") - F.col("hus"), 6).alias("diff"),
    )


@query(
    "A17_retention",
    f"""SELECT a AS n_before, b AS n_after, round(b * 100.0 / a, 6) AS percent_kept FROM
    (SELECT count(DISTINCT time) AS a, count(DISTINCT CASE WHEN minute(time) <= 5 OR minute(time) >= 55 THEN time END) AS b
     FROM {fx.hp_events_sql(Z)})""",
)
def a17(spark, sf_dir):
    e = fx.hp_events(spark, sf_dir, Z)
    return rounded(stats.retention(e, timeops.keep_minute(e, "00min")), "percent_kept")


@query(
    "A17_quality_count",
    f"""SELECT count(*) AS points, count(CASE WHEN quality >= 0.8 THEN 1 END) AS passed FROM {fx.hp_events_sql(Z)}""",
)
def a17b(spark, sf_dir):
    return stats.passing_quality(fx.hp_events(spark, sf_dir, Z), "quality", 0.8)
