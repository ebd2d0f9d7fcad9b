"""Time the headline queries; prints one JSON line.

Every query runs in full into a sink that keeps nothing. ``BENCH_SF_DIR``,
``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma-separated ids, or ``all``) choose the run.
"""

import json
import os
import time

from pyspark.sql import functions as F

from tessella.plans.planning import grid_tiles, plan_tiles
from tessella.queries import load
from tessella.session import local_session

HEADLINE = (
    "src_tile_catalog win_last_wins set_union_tiles join_overlay_wins join_nearest_ancestor agg_tile_dedup "
    "join_plan_scenes win_scene_stack pipe_scene_manifest top_best_at_point flt_region_polygon "
    "agg_pixel_median win_priority_pixel ras_dilate ras_median_rgb ras_overzoom_stack ras_stitch ras_overviews pipe_clean_mosaic pipe_planet pipe_tileset"
).split()


def plan_z10(spark, _):
    """The whole z10 land plan by shard and season (876,790 tiles)."""
    return plan_tiles(grid_tiles(spark, 10), 2024).groupBy("shard", "season").agg(F.count("*").alias("tiles"))


def main():
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    queries, _ = load()
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    run = {"plan_z10": plan_z10, **{n: queries[n] for n in names}} if chosen is None else {n: queries[n] for n in names}
    # start the JVM's code paths and the Python workers once, outside the timing
    spark.range(0, 1000, 1, int(cpus) if cpus.isdigit() else 8).mapInArrow(lambda batches: batches, "id long").selectExpr("sum(id)").collect()
    times = {}
    for name, fn in run.items():
        start = time.perf_counter()
        fn(spark, base).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(base.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
