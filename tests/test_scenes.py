import datetime as dt
import random

from pyspark.sql import functions as F

from tessella.functions.grid import Box
from tessella.operators import gridjoin as GJ
from tessella.operators import scenes as SC
from tessella.operators.ranking import ranked_in_group
from tessella.plans import aoi, manifests
from tessella.plans.planning import grid_tiles, land_tiles, plan_tiles

SCHEMA = "tile int, collection_id string, item_id string, acq_date date, cloud double"


def scene(item, day, cloud, tile=1):
    return (tile, "c", item, dt.date.fromisoformat(day), cloud)


def picked(df):
    return [r.item_id for r in df.orderBy("pos").collect()]


def test_stack_takes_the_clearest_of_each_date_bin(spark):
    """Seven scenes in three bins of 2, 2 and 3: ties go to the earlier day, unknown cloud loses."""
    days = [("k", "2023-01-10", 40.0), ("l", "2023-01-12", 40.0), ("m", "2023-03-01", None), ("n", "2023-03-09", 77.0), ("o", "2023-06-02", 12.0), ("p", "2023-06-03", 3.0), ("q", "2023-06-30", 3.0)]
    rows = spark.createDataFrame([scene(*d) for d in reversed(days)], SCHEMA)
    assert picked(SC.scene_stack(rows, 3, ["tile"])) == ["k", "n", "p"]
    assert picked(SC.scene_stack(rows, 1, ["tile"])) == ["p"]
    for keep in (0, -2, 7, 30):
        assert picked(SC.scene_stack(rows, keep, ["tile"])) == list("klmnopq")


def test_stack_matches_slices_for_many_sizes(spark):
    """Every (n, keep) against plain list slices."""
    rows, want = [], {}
    for n in range(1, 40, 3):
        group = [(f"s{i:02d}", i, None if i % 5 == 0 else float((i * 7) % 11)) for i in range(n)]
        rows += [(n, "c", item, dt.date(2024, 1, 1) + dt.timedelta(days=day // 2), cloud) for item, day, cloud in group]
        ordered = sorted(group, key=lambda g: (g[1] // 2, float("inf") if g[2] is None else g[2], g[0]))
        keep = 5
        if n <= keep:
            want[n] = {g[0] for g in ordered}
        else:
            bins = [ordered[i * n // keep : (i + 1) * n // keep] for i in range(keep)]
            want[n] = {min(b, key=lambda g: float("inf") if g[2] is None else g[2])[0] for b in bins}
    got = {}
    for r in SC.scene_stack(spark.createDataFrame(rows, SCHEMA), 5, ["tile"]).collect():
        got.setdefault(r.tile, set()).add(r.item_id)
    assert got == want


def test_deep_stack_spans_the_season(spark):
    rows = [scene(f"s{i:02d}", str(dt.date(2024, 4, 1) + dt.timedelta(days=6 * i)), float(i * 7 % 40)) for i in range(30)]
    days = [r.acq_date for r in SC.scene_stack(spark.createDataFrame(rows, SCHEMA), 12, ["tile"]).collect()]
    assert len(days) == 12 and (max(days) - min(days)).days > 120


def ranks(df, keys=("g",)):
    return {(*(r[k] for k in keys), r["id"]): (r["r"], r["n"]) for r in df.collect()}


def test_ranks_of_large_groups_equal_a_plain_window(spark):
    """One key and one leading value with a third of all rows and more, nulls and ties."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 40).alias("g"),
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 5 < 4, 1).otherwise(F.col("id") % 11).alias("d"), (F.col("id") * 7919 % 6000).alias("id"),
    )
    order = [F.col("d").asc_nulls_last(), F.col("id").desc()]
    whole = ranked_in_group(rows, ["g"], order, "r", "n")
    split = ranked_in_group(rows, ["g"], order, "r", "n", hot_rows=150)
    assert ranks(split) == ranks(whole) and split.count() == 6000
    by_key = {}
    for r in rows.collect():
        by_key.setdefault(r.g, []).append((r.d is None, r.d or 0, -r.id))
    want = {(g, -k[2]): (i, len(v)) for g, v in by_key.items() for i, k in enumerate(sorted(v), 1)}
    assert ranks(split) == want
    # rows of the hot key lie in many partitions
    places = split.filter("g = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    assert places > 1


def test_equal_rows_of_a_large_group_get_all_ranks(spark):
    rows = spark.range(1000).select(F.lit(1).alias("g"), F.lit(2).alias("d"))
    got = ranked_in_group(rows, ["g"], [F.col("d")], "r", hot_rows=60)
    assert sorted(r.r for r in got.collect()) == list(range(1, 1001)) and got.columns == ["g", "d", "r"]


def test_large_groups_in_stacks(spark):
    rows = [(i % 2, "c", f"s{i:04d}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 9), None if i % 7 == 0 else float(i % 13)) for i in range(900)]
    table = spark.createDataFrame(rows, SCHEMA)
    plain, split = (SC.scene_stack(table, 12, ["tile"], hot_rows=h) for h in (10**6, 50))
    assert plain.count() == 24 and plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_mosaic_cap(spark):
    clouds = [("e", 62.0), ("f", None), ("g", 8.5), ("h", 8.5), ("i", 33.0)]
    rows = spark.createDataFrame([scene(i, "2023-02-03", c) for i, c in clouds], SCHEMA)
    keep = lambda n: {r.item_id for r in SC.mosaic_cap(rows, ["tile"], n).collect()}
    assert keep(1) == {"g"} and keep(3) == {"g", "h", "i"} and keep(4) == {"e", "g", "h", "i"}
    assert keep(0) == keep(-3) == {"e", "f", "g", "h", "i"}


def test_hot_cell_is_salted_and_loses_nothing(spark, views):
    plan = plan_tiles(grid_tiles(spark, 4), 2024)
    # a third of all scenes over one place
    scenes = views.fx_scenes.withColumns({c: F.when(F.substring("item_id", 2, 9).cast("int") % 3 == 0, F.lit(val)).otherwise(F.col(c)) for c, val in (("minx", 5.0), ("miny", 45.0), ("maxx", 7.0), ("maxy", 47.0))})
    keys = ["z", "x", "y", "role", "item_id"]
    plain = SC.match_plan_scenes(plan, scenes).select(*keys)
    for limits in ({"hot_rows": 5, "small_plan": 0}, {"small_plan": 0}):
        split = SC.match_plan_scenes(plan, scenes, **limits).select(*keys)
        assert plain.count() == split.count() == plain.distinct().count() and plain.exceptAll(split).count() == 0


def boxes(spark, rows, prefix):
    return spark.createDataFrame(rows, ", ".join([f"{prefix}id int", *[f"{prefix}{n} double" for n in ("minx", "miny", "maxx", "maxy")]]))


def test_boxes_of_all_sizes_meet_once_with_few_rows(spark):
    """Boxes from 0.01 to 360 degrees, points, shared borders, against all pairs."""
    rng = random.Random(8)

    def made(n):
        rows = [(0, -180.0, -90.0, 180.0, 90.0), (1, 0.0, 0.0, 45.0, 45.0), (2, 45.0, 45.0, 90.0, 90.0), (3, 45.0, 10.0, 45.0, 10.0)]
        for i in range(4, n):
            size = 10 ** rng.uniform(-2, 2)
            x, y = rng.uniform(-180, 179), rng.uniform(-90, 89)
            rows.append((i, x, y, min(180.0, x + size * rng.random()), min(90.0, y + size * rng.random())))
        return rows

    a, b = made(300), made(200)
    sides = boxes(spark, a, "l_"), boxes(spark, b, "r_")
    levels = GJ.levels_of((sides[0], GJ.box_level("l_")), (sides[1], GJ.box_level("r_")))
    left, right = GJ.spread_boxes(*sides, "l_", "r_", levels)
    assert left.count() <= GJ.most_rows(*levels) and right.count() <= GJ.most_rows(*levels[::-1])
    met = left.join(right, GJ.KEYS).filter(GJ.met_once("l_", "r_")).filter("l_minx <= r_maxx AND r_minx <= l_maxx AND l_miny <= r_maxy AND r_miny <= l_maxy")
    got = [(r.l_id, r.r_id) for r in met.collect()]
    want = [(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]]
    assert sorted(got) == sorted(want)
    for side, key in ((left, "l_id"), (right, "r_id")):
        assert side.groupBy(key, "_kind", "_level").count().agg(F.max("count")).first()[0] <= 4


def test_days_meet_in_blocks_of_the_spans(spark):
    spans = spark.createDataFrame([(1, "2024-03-01", "2024-03-01"), (2, "2023-12-20", "2024-03-05"), (3, "1969-12-25", "1970-01-10"), (4, "2024-01-01", "2024-12-31")], "id int, a string, b string")
    spans = spans.select("id", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    days = spark.sql("SELECT explode(sequence(DATE'1969-12-01', DATE'2025-01-31', INTERVAL 3 DAY)) AS day")
    left, right = GJ.spread_days(spans, days, "a", "b", "day", GJ.levels_of((spans, GJ.block_level("a", "b")))[0])
    assert left.groupBy("id").count().agg(F.max("count")).first()[0] <= 5
    got = left.join(right, ["_blocks", "_block"]).filter("day BETWEEN a AND b").select("id", "day")
    want = spans.crossJoin(days).filter("day BETWEEN a AND b").select("id", "day")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_manifest_summary_and_fallback(spark, views):
    plan = plan_tiles(grid_tiles(spark, 5), 2024, buffer_km=1e6)  # the whole grid
    scenes, summary = manifests.scene_manifest(plan, views.fx_scenes, 3)
    s = summary.first()
    assert s.tiles_evaluated == 1024 and s.max_scenes_per_tile == 3
    assert s.unique_scenes == scenes.count() == scenes.select("collection_id", "item_id").distinct().count()
    assert s.fallback_tiles == 1024 - 236  # tiles with a primary candidate at this scale
    pairs = SC.match_plan_scenes(plan, views.fx_scenes)
    only = SC.pick_role(pairs).filter("role = 'fallback'").select("x", "y").distinct()
    assert only.count() == 103


def test_one_scene_for_two_tiles_is_listed_once(spark):
    plan = plan_tiles(grid_tiles(spark, 6), 2024).filter("x in (32, 33) and y = 22")
    scenes = spark.createDataFrame([("hls2-s30", "one", dt.date(2024, 6, 1), 1.0, 1.0, 45.0, 10.0, 52.0)], "collection_id string, item_id string, acq_date date, cloud double, minx double, miny double, maxx double, maxy double")
    found, summary = manifests.scene_manifest(plan, scenes)
    assert plan.count() == 2 and found.count() == 1 and summary.first().fallback_tiles == 0


def test_finest_images(spark):
    rows = spark.createDataFrame([("u1", 0.12, "2020-01-01", 1), ("u2", 0.05, "2021-07-06", 1), ("u3", 0.05, None, 1), ("u4", 0.05, "2022-01-01", 1)], "url string, gsd double, acquisition_start string, k int")
    got = SC.finest_images(rows, ["k"], 3, 0.1)
    assert {r.url for r in got.collect()} == {"u2", "u3", "u4"}
    assert {r.url for r in SC.finest_images(rows, ["k"], 2).collect()} == {"u3", "u4"}


def test_search_is_open_ended_and_drops_unknown_cloud(spark, views):
    box = Box(-180.0, -90.0, 180.0, 90.0)
    every = SC.search_scenes(views.fx_scenes, ("hls2-s30", "hls2-l30", "landsat-c2-l2"), box, None, None)
    assert every.count() == views.fx_scenes.count()
    limited = SC.search_scenes(views.fx_scenes, ("hls2-s30",), box, "2024-06-01", None, 100.0)
    assert limited.filter("cloud IS NULL OR acq_date < '2024-06-01'").count() == 0


def test_aoi_rules(spark, views):
    rows = [("box", 10.0, 0.0, 20.0, 5.0, None, None, False, 0.0), ("wrap", 170.0, 0.0, -170.0, 5.0, None, None, False, 0.0), ("two", 10.0, 0.0, 20.0, 5.0, "01", None, False, 0.0), ("none", None, None, None, None, None, None, False, 0.0), ("sea", -25.0, -58.0, -24.0, -57.0, None, None, True, 0.0)]
    aois = spark.createDataFrame(rows, "aoi_id string, minx double, miny double, maxx double, maxy double, shard string, region_id bigint, land_only boolean, buffer_km double")
    assert {r.aoi_id for r in aoi.aoi_issues(aois).collect()} == {"two", "none"}
    land = land_tiles(grid_tiles(spark, 5)).filter("x > 20")
    got = {(r.aoi_id, r.part): (r.minx, r.maxx) for r in aoi.resolve_aois(aois, views.fx_edges, land, 5).collect()}
    assert got["box", 0] == (10.0, 20.0)
    assert got["wrap", 0] == (170.0, 180.0) and got["wrap", 1] == (-180.0, -170.0)
    assert got["sea", 0] == (56.25, 180.0)  # no land there: the whole land


def test_scenes_over_the_antimeridian(spark):
    scenes = spark.createDataFrame(
        [("c", "over", "2024-05-01", 3.0, 178.0, -1.0, -178.5, 1.0), ("c", "plain", "2024-05-01", 4.0, 10.0, -1.0, 12.0, 1.0)],
        "collection_id string, item_id string, d string, cloud double, minx double, miny double, maxx double, maxy double",
    ).withColumn("acq_date", F.col("d").cast("date")).drop("d")
    tiles = [(1, -180.0, -179.0), (2, 179.0, 180.0), (3, 9.0, 11.0), (4, -180.0, 180.0), (5, -178.0, -177.0), (6, 170.0, 177.0)]
    plan = spark.createDataFrame([(8, i, 0, a, -0.5, b, 0.5) for i, a, b in tiles], "z int, x int, y int, minx double, miny double, maxx double, maxy double")
    plan = plan.selectExpr(
        "*", "DATE'2024-01-01' AS start_date", "DATE'2024-12-31' AS end_date", "array('c') AS collections", "array('c') AS fallback_collections",
        "50.0 AS max_cloud", "60.0 AS fallback_max_cloud",
    )
    got = SC.match_plan_scenes(plan, scenes).filter("role = 'primary'").collect()
    assert sorted((r.x, r.item_id) for r in got) == [(1, "over"), (2, "over"), (3, "plain"), (4, "over"), (4, "plain")]
    assert {(r.s_minx, r.s_maxx) for r in got if r.item_id == "over"} == {(178.0, -178.5)}


def shuffled(spark, frame):
    """Rows of a frame, and the bytes that its jobs wrote to shuffles."""
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    rows = frame().collect()
    return rows, written() - before


def test_boxes_in_any_region_make_no_pairs(spark):
    """Boxes over many regions are settled without a row for each box and region."""
    from tessella.operators.regions import boxes_in_any_region, boxes_in_regions

    # 400 squares over one place, a lone triangle, and boxes in, across and outside of them
    ends = ("-20D - id % 7", "-20D", "20D", "-20D"), ("20D", "-20D", "20D", "20D"), ("20D", "20D", "-20D - id % 7", "20D"), ("-20D - id % 7", "20D", "-20D - id % 7", "-20D")
    square = "inline(array(" + ", ".join("named_struct('x1', {}, 'y1', {}, 'x2', {}, 'y2', {})".format(*e) for e in ends) + "))"
    squares = spark.range(400).selectExpr("CAST(id AS int) AS region", square)
    lone = spark.createDataFrame([(900, 100.0, 1.0, 100.9, 1.0), (900, 100.9, 1.0, 100.4, 1.9), (900, 100.4, 1.9, 100.0, 1.0)], squares.schema)
    edges = squares.unionByName(lone)
    boxes = spark.range(3000).selectExpr("concat('S', id) AS item", "id * 7 % 60 - 30D AS minx", "id * 11 % 50 - 25D AS miny", "id * 7 % 60 - 29.5D AS maxx", "id * 11 % 50 - 24.5D AS maxy")
    small = spark.createDataFrame([("in", 100.3, 1.2, 100.4, 1.3), ("beside", 100.02, 1.7, 100.1, 1.8), ("bad", 5.0, 0.0, 4.0, 1.0)], boxes.schema)
    boxes = boxes.unionByName(small)
    rows, moved = shuffled(spark, lambda: boxes_in_any_region(boxes, edges, "region", "item"))
    want, pairs_moved = shuffled(spark, lambda: boxes_in_regions(boxes, edges, "region", "item").select("item").distinct())
    assert sorted(r.item for r in rows) == sorted(r.item for r in want) and "in" in {r.item for r in rows}
    assert len(rows) == len({r.item for r in rows}) and "beside" not in {r.item for r in rows}
    assert moved * 2 < pairs_moved


def test_a_footprint_meets_the_points_once(spark, monkeypatch):
    """Scenes that repeat a footprint do not multiply the points' rows."""
    from tessella.functions.grid import box_from_point

    points = spark.range(200).selectExpr("id AS point_id", "id % 50 / 25D AS lon", "id % 40 / 20D AS lat")
    scenes = spark.range(3000).selectExpr(
        "'c' AS collection_id", "concat('S', id) AS item_id", "DATE '2024-06-01' + CAST(id % 60 AS INT) AS acq_date", "CAST((id * 37 + 5) % 89 AS DOUBLE) AS cloud",
        "0D AS minx", "0D AS miny", "2D AS maxx", "2D AS maxy")
    met, boxes_of = [], SC.boxes_of
    monkeypatch.setattr(SC, "boxes_of", lambda left, right, *rest: met.append(right.count()) or boxes_of(left, right, *rest))
    got = SC.best_at_points(points, scenes, box_from_point("lon", "lat", 3000.0, 3000.0), "2024-06-01", "2024-07-30", 50.0).collect()
    best = scenes.orderBy("cloud", "acq_date", "collection_id", "item_id").first()
    assert len(got) == 200 and {r.item_id for r in got} == {best.item_id} and met == [1]
