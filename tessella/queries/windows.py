"""Window-like picks and orderings."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.functions.grid import box_from_point
from tessella.operators import scenes as SC
from tessella.operators import tiles as T
from tessella.operators.pixels import first_clear, last_painted
from tessella.operators.ranking import ranked_in_group, top_in_group
from tessella.queries import query
from tessella.session import cut_lineage

CELL = "concat(CAST(floor(minx / 30) AS INT), '_', CAST(floor(miny / 30) AS INT))"


def gridded(v):
    return v.sql(f"SELECT *, {CELL} AS cell FROM {{fx_scenes}}")


@query("win_scene_stack", f"""
    SELECT cell, collection_id, item_id, acq_date FROM (
      SELECT *, row_number() OVER (PARTITION BY cell, bin ORDER BY coalesce(cloud, 1e9), r) AS pick FROM (
        SELECT *, CASE WHEN n <= 12 THEN r - 1 ELSE (r * 12 - 1) // n END AS bin FROM (
          SELECT *, row_number() OVER (PARTITION BY cell ORDER BY acq_date, coalesce(cloud, 1e9), collection_id, item_id) AS r,
                 count(*) OVER (PARTITION BY cell) AS n FROM (SELECT *, {CELL} AS cell FROM {{fx_scenes}}) AS a) AS b) AS c) AS d WHERE pick = 1""")
def _(v):
    return SC.scene_stack(gridded(v), 12, ["cell"]).select("cell", "collection_id", "item_id", "acq_date")


@query("win_fallback", f"""
    SELECT cell, item_id FROM (SELECT *, max(CASE WHEN role = 'primary' THEN 1 ELSE 0 END) OVER (PARTITION BY cell) AS p
      FROM (SELECT *, {CELL.replace('30', '3')} AS cell, CASE WHEN collection_id = 'landsat-c2-l2' THEN 'fallback' ELSE 'primary' END AS role FROM {{fx_scenes}}) AS a) AS b
    WHERE (p = 1) = (role = 'primary')""")
def _(v):
    cells = v.fx_scenes.select(
        F.lit(0).alias("z"),
        F.floor(F.col("minx") / 3).cast("int").alias("x"),
        F.floor(F.col("miny") / 3).cast("int").alias("y"),
        F.when(F.col("collection_id") == "landsat-c2-l2", "fallback").otherwise("primary").alias("role"),
        "item_id",
    )
    return SC.pick_role(cells, capped=False).select(F.concat("x", F.lit("_"), "y").alias("cell"), "item_id")


@query("win_search_cap", f"""
    SELECT cell, collection_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY cell, collection_id ORDER BY cloud NULLS FIRST, acq_date, item_id) AS r
      FROM (SELECT *, {CELL} AS cell FROM {{fx_scenes}}) AS a) AS b WHERE r <= 25""")
def _(v):
    order = [F.col("cloud"), F.col("acq_date"), F.col("item_id")]
    return top_in_group(gridded(v), ["cell", "collection_id"], order, 25).select("cell", "collection_id", "item_id")


@query("win_last_wins", """
    SELECT z, x, y, seq, payload FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY seq DESC) AS r FROM {fx_tiles}) AS t WHERE r = 1""")
def _(v):
    return T.last_wins(v.fx_tiles, ["seq"]).select("z", "x", "y", "seq", "payload")


@query("win_first_wins", """
    SELECT z, x, y, src, seq FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY src, seq) AS r FROM {fx_tiles}) AS t WHERE r = 1""")
def _(v):
    return T.first_wins(v.fx_tiles, ["src", "seq"]).select("z", "x", "y", "src", "seq")


PIXEL = "z, x, y, px, py, band"


@query("win_priority_pixel", f"""
    SELECT {PIXEL}, dn FROM (SELECT *, row_number() OVER (PARTITION BY {PIXEL} ORDER BY coalesce(cloud, 1e9), scene DESC, seq DESC, dn DESC) AS r
      FROM {{fx_obs}} WHERE dn <> 0) AS t WHERE r = 1""")
def _(v):
    keys = PIXEL.split(", ")
    return first_clear(v.fx_obs, keys, F.struct("scene", "seq", "dn")).select(*keys, "dn")


@query("win_partition_cut", """
    SELECT src, min_by(x, struct_pack(d := abs(cum - total * 5.0 / 18.0), x := x)) AS cut, min(abs(cum - total * 5.0 / 18.0)) AS gap FROM (
      SELECT src, x, sum(w) OVER (PARTITION BY src ORDER BY x) AS cum, sum(w) OVER (PARTITION BY src) AS total FROM (
        SELECT src, x >> (z - 6) AS x, count(*) AS w FROM {fx_tiles} GROUP BY 1, 2) AS l) AS c GROUP BY src""")
def _(v):
    from tessella.operators.partitioning import best_cut

    lines = v.fx_tiles.groupBy("src", F.call_function("shiftright", F.col("x"), F.col("z") - 6).alias("x")).agg(
        F.count("*").alias("w")
    )
    return best_cut(lines, ["src"], "x", "w", share_num=5.0, share_den=18.0)


@query("top_scene_hls_order", """
    SELECT collection_id, item_id, row_number() OVER (PARTITION BY collection_id ORDER BY coalesce(cloud, 100), acq_date, item_id) AS rank FROM {fx_scenes}""")
def _(v):
    cloud = F.coalesce("cloud", F.lit(100.0))
    order = [cloud, F.col("acq_date"), F.col("item_id")]
    ranked = ranked_in_group(v.fx_scenes, ["collection_id"], order, "rank")
    return ranked.select("collection_id", "item_id", "rank")


@query("top_scene_s2", f"""
    SELECT cell, item_id FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY coalesce(cloud, 100), acq_date DESC, item_id) AS r
      FROM (SELECT *, {CELL} AS cell FROM {{fx_scenes}}) AS a) AS b WHERE r <= 10""")
def _(v):
    return SC.order_newest(gridded(v), ["cell"], 10).select("cell", "item_id")


@query("top_mosaic_cap", f"""
    SELECT cell, item_id FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY cloud NULLS LAST, item_id) AS r
      FROM (SELECT *, {CELL} AS cell FROM {{fx_scenes}}) AS a) AS b WHERE r <= 3""")
def _(v):
    return SC.mosaic_cap(gridded(v), ["cell"], 3).select("cell", "item_id")


@query("top_oam_items", """
    SELECT family, image_id FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY gsd, acquisition_start DESC NULLS FIRST, url) AS r
      FROM {fx_images} WHERE gsd <= 2.5) AS t WHERE r <= 4""")
def _(v):
    return SC.finest_images(v.fx_images, ["family"], 4, 2.5).select("family", "image_id")


@query("top_best_at_point", """
    SELECT point_id, cloud, item_id FROM (
      SELECT event_id AS point_id, cloud, item_id, row_number() OVER (PARTITION BY event_id ORDER BY cloud, acq_date, collection_id, item_id) AS r
      FROM (SELECT *, 3000.0 / 2 / 111320.0 AS dy, 3000.0 / 2 / greatest(1e-6, 111320.0 * cos(radians(lat))) AS dx FROM {fx_points}) AS p
      JOIN {fx_scenes} AS s ON minx <= least(180.0, lon + dx) AND maxx >= greatest(-180.0, lon - dx) AND miny <= least(90.0, lat + dy) AND maxy >= greatest(-90.0, lat - dy)
      WHERE cloud <= 50 AND acq_date BETWEEN DATE '2024-03-01' AND DATE '2024-11-30') AS t WHERE r = 1""")
def _(v):
    points = v.fx_points.withColumnRenamed("event_id", "point_id")
    box = box_from_point("lon", "lat", 3000.0, 3000.0)
    best = SC.best_at_points(points, v.fx_scenes, box, "2024-03-01", "2024-11-30", 50.0)
    return best.select("point_id", "cloud", "item_id")


@query("top_plan_head", """
    SELECT z, x, y FROM {fx_tiles} GROUP BY z, x, y ORDER BY z, x, y LIMIT 100""")
def _(v):
    return v.fx_tiles.select("z", "x", "y").distinct().orderBy("z", "x", "y").limit(100)


@query("top_cluster_layout", """
    SELECT z, x, y, seq, true AS spread, true AS apart, true AS ordered FROM {fx_tiles}""")
def _(v):
    """Rows with what the layout promises: several files, no key range in two, keys in order."""
    placed = {"part": F.spark_partition_id(), "row": F.monotonically_increasing_id(), "key": F.struct("z", "cluster")}
    laid = cut_lineage(T.clustered(v.fx_tiles, 8).select("z", "x", "y", "seq", "cluster").withColumns(placed))
    ranges = laid.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    in_files = Window.orderBy("part")  # one row per file
    before = F.lag("last").over(in_files)
    facts = ranges.select("part", (F.count("*").over(Window.partitionBy()) > 1).alias("spread"), (before.isNull() | (before <= F.col("first"))).alias("apart"))
    previous = F.lag("key").over(Window.partitionBy("part").orderBy("row"))
    rows = laid.withColumn("ordered", previous.isNull() | (previous <= F.col("key"))).join(F.broadcast(facts), "part")
    return rows.select("z", "x", "y", "seq", "spread", "apart", "ordered")
