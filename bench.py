"""Headline queries with timings; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) set data and cores.
Each query runs in full into Spark's no-op sink. ``rates`` are cell values (or rows) per second; the
published figure to set them against is about 2 million cell values per second and worker.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from spherecube.functions import healpix  # noqa: E402
from spherecube.operators import coarsen as co  # noqa: E402
from spherecube.operators import gather, grids, remap, stats, timeops, triangulation, weights  # noqa: E402
from spherecube.queries import fixtures as fx  # noqa: E402
from spherecube.session import prepare, scratch_path  # noqa: E402
from spherecube.sources import cubes, stores  # noqa: E402


TENTH_STEPS = 4


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("spherecube-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # inputs that several queries share are written once, outside the timings
    hourly_path = scratch_path(spark, "hourly")
    fx.hp_hourly(spark, sf_dir, 9).write.parquet(hourly_path)
    hourly = spark.read.parquet(hourly_path)
    obs_path = scratch_path(spark, "obs")
    fx.obs_orders(spark, sf_dir).write.parquet(obs_path)
    obs = spark.read.parquet(obs_path)
    points = obs.select("src_idx", "iy", "ix", "lon", "lat").distinct()
    n_obs, n_hourly = obs.count(), hourly.count()
    n_steps = obs.select("time").distinct().count()
    events = fx.hp_events(spark, sf_dir, 9)
    n_events = events.count()

    # weights are built once and cached, as in a production run; J1 times the building
    weights_path = scratch_path(spark, "weights")
    for zoom in (5, 6, 7, 8):
        stores.write_weights(weights.regular_weights(points, zoom, "bench"), weights_path)

    def remap_at(zoom: int):
        w = spark.read.parquet(weights_path).filter(f"zoom = {zoom}")
        return remap.apply_weights(obs.select("time", "src_idx", "pr"), w, zoom)

    def written() -> None:
        stores.write_store(hourly, scratch_path(spark, "bench-store"), 9)

    tenth, layout = _tenth_degree(spark, sf_dir)

    def tenth_written() -> None:
        stores.write_store(remap.apply_weights(tenth, layout, 9), scratch_path(spark, "bench-tenth"), 9)

    cases = {
        "A1_hourly_mean": (lambda: run(timeops.resample_mean(events, "1h", ["cell"], values=["value"])), n_events),
        "A3_block_mean": (lambda: run(timeops.block_mean(hourly, 6, ["cell"])), n_hourly),
        "A5_coarsen_9_to_5": (lambda: run(co.coarsen(hourly, 9, 5)), n_hourly),
        "A6_pyramid_9_to_5": (lambda: run(co.all_levels(hourly, 9, 5)), n_hourly),
        "A12_month_climatology": (lambda: run(stats.month_climatology(fx.lev_lineitem(spark, sf_dir, 9))), None),
        "J1_regular_weights_z8": (lambda: run(weights.regular_weights(points, 8, "bench")), healpix.npix(8)),
        "J1_scattered_weights_z4": (
            lambda: run(triangulation.triangulated_weights(fx.points_customers(spark, sf_dir), 4, "bench", wrap=True)), healpix.npix(4)
        ),
        "J1_scattered_weights_z7": (
            lambda: run(triangulation.triangulated_weights(fx.points_customers(spark, sf_dir), 7, "bench", wrap=True)), healpix.npix(7)
        ),
        "J4_remap_z5": (lambda: run(remap_at(5)), n_steps * healpix.npix(5)),
        "J4_remap_z6": (lambda: run(remap_at(6)), n_steps * healpix.npix(6)),
        "J4_remap_z7": (lambda: run(remap_at(7)), n_steps * healpix.npix(7)),
        "J4_remap_z8": (lambda: run(remap_at(8)), n_steps * healpix.npix(8)),
        # a grid as published runs have it: 6.5 million points, output written
        "J4_tenth_degree_z9_written": (tenth_written, TENTH_STEPS * healpix.npix(9)),
        "J7_merge": (lambda: run(_merge(spark, sf_dir)), None),
        "K1_write_store": (written, n_hourly),
        "S4_read_concat": (lambda: run(cubes.read_cube(spark, [hourly_path, hourly_path])), 2 * n_hourly),
        "U1_concat": (lambda: run(cubes.concat_time([hourly, hourly])), 2 * n_hourly),
    }
    seconds, rates = {}, {}
    run(grids.grid_summary(points))  # warm up the session
    for name, (job, amount) in cases.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        if amount:
            rates[name] = round(amount / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "rates_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
            }
        )
    )


def _tenth_degree(spark, sf_dir):
    """Some steps of a 0.1-degree grid, stored by step, and its gather layout for zoom 9; built outside the timings."""
    points = spark.range(1800 * 3600).select(F.col("id").alias("src_idx"), F.floor(F.col("id") / 3600).alias("iy"), (F.col("id") % 3600).alias("ix"))
    points = points.withColumns({"lat": F.col("iy") * 0.1 - 89.95, "lon": F.col("ix") * 0.1 + 0.05})
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    steps = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(hour.alias("time")).agg(F.avg("value").alias("level_of_step"))
    steps = steps.orderBy("time").limit(TENTH_STEPS)
    cube = points.crossJoin(F.broadcast(steps)).select("time", "src_idx", (F.sin("lat") * F.col("level_of_step")).cast("float").alias("pr"))
    path = scratch_path(spark, "tenth")
    cube.repartition("time").write.parquet(path)
    built = weights.regular_weights(points, 9, "tenth")
    layout = stores.cached_layout(spark, scratch_path(spark, "layouts"), "tenth", 9, built, gather.Numbering(3600, 0))
    return spark.read.parquet(path), layout


def _merge(spark, sf_dir):
    from spherecube.operators.combine import merge_surface_levels

    return merge_surface_levels(fx.sfc_orders(spark, sf_dir, 5), fx.lev_lineitem(spark, sf_dir, 5)).withColumn("day", F.to_date("time"))


if __name__ == "__main__":
    main()
