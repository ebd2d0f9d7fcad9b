"""Filters and checks."""

from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import Box, box_from_point, quadrant_of_tile
from tessella.operators import scenes as SC
from tessella.operators import stats
from tessella.operators.regions import polygon_cover
from tessella.plans.planning import land_tiles
from tessella.queries import query
from tessella.queries.scalars import LAT, QUADRANT
from tessella.queries.sources import CATALOG
from tessella.sources.catalogs import parse_catalog_lines

NORTH, SOUTH = LAT.format(row="y"), LAT.format(row="y + 1")
BOUNDS = f"""x / power(2, z) * 360.0 - 180.0 AS w, (x + 1) / power(2, z) * 360.0 - 180.0 AS e,
    greatest({SOUTH}, -85.0511287798066) AS s, least({NORTH}, 85.0511287798066) AS n"""
LAND_VALUES = ", ".join(str(b) for b in C.LAND_BOXES)
LAND = f"""(n > 75.0 OR s < -75.0 OR EXISTS (SELECT 1 FROM (VALUES {LAND_VALUES}) AS l(w0, s0, e0, n0)
    WHERE e >= w0 - 20.0 / 111.32 AND w <= e0 + 20.0 / 111.32 AND n >= s0 - 20.0 / 111.32 AND s <= n0 + 20.0 / 111.32))"""


@query("flt_zoom", f"SELECT z, x, y, size FROM ({CATALOG}) AS c WHERE z BETWEEN 8 AND 16")
def _(v):
    return parse_catalog_lines(v.fx_catalog).filter(F.col("z").between(8, 16)).select("z", "x", "y", "size")


@query("flt_quadrant", f"SELECT seq FROM {{fx_tiles}} WHERE {QUADRANT} = 'east'")
def _(v):
    return v.fx_tiles.filter(quadrant_of_tile("z", "x", "y") == "east").select("seq")


@query("flt_land_approx", f"SELECT seq FROM (SELECT seq, {BOUNDS} FROM {{fx_tiles}}) AS t WHERE {LAND}")
def _(v):
    return land_tiles(v.fx_tiles).select("seq")


# every edge against every distinct tile: an edge crosses the box when it is not
# wholly on one side and the box corners are not all on one side of its line
CROSS = """greatest(x1, x2) >= w AND least(x1, x2) <= e AND greatest(y1, y2) >= s AND least(y1, y2) <= n
    AND NOT ((x2-x1)*(s-y1)-(y2-y1)*(w-x1) > 0 AND (x2-x1)*(s-y1)-(y2-y1)*(e-x1) > 0 AND (x2-x1)*(n-y1)-(y2-y1)*(w-x1) > 0 AND (x2-x1)*(n-y1)-(y2-y1)*(e-x1) > 0)
    AND NOT ((x2-x1)*(s-y1)-(y2-y1)*(w-x1) < 0 AND (x2-x1)*(s-y1)-(y2-y1)*(e-x1) < 0 AND (x2-x1)*(n-y1)-(y2-y1)*(w-x1) < 0 AND (x2-x1)*(n-y1)-(y2-y1)*(e-x1) < 0)"""
INSIDE = """(y1 > cy) <> (y2 > cy) AND x1 + (cy - y1) * (x2 - x1) / (y2 - y1) > cx"""


def region_tiles(source):
    return f"""SELECT DISTINCT z, x, y FROM (
      SELECT t.z, t.x, t.y, region_id, bool_or({CROSS}) AS crossed, count(*) FILTER (WHERE {INSIDE}) AS n_right
      FROM (SELECT *, (w + e) / 2 AS cx, {LAT.format(row='y + 0.5')} AS cy FROM (SELECT z, x, y, {BOUNDS} FROM {source}) AS b) AS t, {{fx_edges}} AS g
      GROUP BY t.z, t.x, t.y, region_id) AS r WHERE crossed OR n_right % 2 = 1"""


POINT_TILES = """(SELECT DISTINCT 7 AS z, CAST(floor((lon + 180.0) / 360.0 * 128) AS BIGINT) AS x,
    CAST(floor((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * 128) AS BIGINT) AS y FROM {fx_points})"""


def point_tiles(v, z=7):
    from tessella.functions.grid import lonlat_to_tile

    x, y = lonlat_to_tile("lon", "lat", z)
    return v.fx_points.select(F.lit(z).alias("z"), x.alias("x"), y.alias("y")).distinct()


@query("flt_region_polygon", region_tiles(POINT_TILES + " AS p"))
def _(v):
    cover = polygon_cover(v.fx_edges, "region_id", 7)
    return point_tiles(v).join(cover, ["z", "x", "y"], "left_semi")


@query("flt_land_polygon", f"SELECT z, x, y FROM (SELECT z, x, y, {BOUNDS} FROM ({region_tiles(POINT_TILES + ' AS p')}) AS k) AS t WHERE {LAND}")
def _(v):
    cover = polygon_cover(v.fx_edges, "region_id", 7)
    return land_tiles(point_tiles(v)).join(cover, ["z", "x", "y"], "left_semi")


@query("flt_scene_search", """
    SELECT item_id, collection_id FROM {fx_scenes} WHERE collection_id IN ('hls2-s30', 'hls2-l30') AND cloud <= 40
      AND acq_date BETWEEN DATE '2024-04-01' AND DATE '2024-10-31' AND minx <= 40 AND maxx >= -60 AND miny <= 50 AND maxy >= 5""")
def _(v):
    found = SC.search_scenes(
        v.fx_scenes, ("hls2-s30", "hls2-l30"), Box(-60.0, 5.0, 40.0, 50.0), "2024-04-01", "2024-10-31", 40.0
    )
    return found.select("item_id", "collection_id")


@query("flt_scene_region", """
    SELECT item_id FROM (SELECT item_id, region_id, bool_or(""" + CROSS + """) AS crossed, count(*) FILTER (WHERE """ + INSIDE + """) AS n_right
      FROM (SELECT item_id, minx AS w, maxx AS e, miny AS s, maxy AS n, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM {fx_scenes}) AS t, {fx_edges} AS g
      GROUP BY item_id, region_id) AS r WHERE crossed OR n_right % 2 = 1 GROUP BY item_id""")
def _(v):
    from tessella.operators.regions import boxes_in_any_region

    return boxes_in_any_region(v.fx_scenes, v.fx_edges, "region_id", "item_id")


@query("flt_scene_cover", "SELECT item_id FROM {fx_scenes} WHERE minx <= 10.2 AND miny <= 20.1 AND maxx >= 10.9 AND maxy >= 20.7")
def _(v):
    return SC.covering_scenes(v.fx_scenes, Box(10.2, 20.1, 10.9, 20.7)).select("item_id")


@query("flt_gsd", "SELECT image_id, gsd FROM {fx_images} WHERE gsd <= 1.5")
def _(v):
    return v.fx_images.filter(F.col("gsd") <= 1.5).select("image_id", "gsd")


@query("flt_visible_tile", """
    SELECT ord, x, y FROM (SELECT ord, x * 4 + px // 2 AS x, y * 4 + py // 2 AS y, a FROM {fx_rgba}) AS t GROUP BY ord, x, y HAVING max(a) > 0""")
def _(v):
    from tessella.operators.pixels import visible_tiles

    # the pixels as tiles of two by two
    small = v.fx_rgba.select(
        "ord", (F.col("x") * 4 + F.floor(F.col("px") / 2)).alias("x"), (F.col("y") * 4 + F.floor(F.col("py") / 2)).alias("y"), "a"
    )
    return visible_tiles(small, ["ord", "x", "y"])


LAYERS = """SELECT seq, z, x, y, concat('layer', src) AS layer, CASE src WHEN 0 THEN 'modis' WHEN 1 THEN 'hls' ELSE 'private' END AS source FROM {fx_tiles}"""


@query("chk_oversample", f"""
    SELECT layer, source, max(z) AS max_zoom, max(c) AS ceiling, count(*) FILTER (WHERE z > c) AS above
    FROM (SELECT *, CASE source WHEN 'modis' THEN 8 WHEN 'hls' THEN 12 END AS c FROM ({LAYERS}) AS l) AS t GROUP BY layer, source""")
def _(v):
    return stats.oversampled(stats.with_ceiling(v.sql(LAYERS)))


@query("chk_manifest", """
    SELECT day, count(*) AS scenes, max(CASE WHEN k % 3 <> 0 THEN 1 ELSE 0 END) = 1 AS valid
    FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey AS k FROM {orders}) AS o GROUP BY day""")
def _(v):
    extra = F.when(F.col("o_orderkey") % 3 != 0, F.lit("b03")).otherwise("thumb")
    scenes = v.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.create_map(F.lit("b02"), F.lit("u"), extra, F.lit("u")).alias("assets"),
    )
    return stats.manifest_check(scenes, ["day"], ("B02", "B03"))


@query("chk_tileset", """
    SELECT src, count(*) AS tiles, count(*) > 0 AS valid, CASE WHEN src = 1 THEN 'bounds' ELSE '' END AS missing FROM {fx_tiles} GROUP BY src""")
def _(v):
    from tessella.sources.metadata import tilejson

    sets = v.fx_tiles.groupBy("src").agg(
        F.count("*").alias("tiles"), F.min("z").alias("minzoom"), F.max("z").alias("maxzoom")
    )
    sets = sets.withColumn("valid", F.col("tiles") > 0).withColumn("name", F.lit("n")).withColumn("format", F.lit("png"))
    docs = tilejson(sets, ["src", "tiles", "valid"])
    text = F.when(F.col("src") == 1, F.replace("tilejson", F.lit('"bounds"'), F.lit('"b"'))).otherwise(F.col("tilejson"))
    checked = stats.tilejson_check(docs.withColumn("tilejson", text).withColumnRenamed("valid", "has_tiles"))
    return checked.select("src", "tiles", F.col("has_tiles").alias("valid"), "missing")


@query("chk_payload", """
    SELECT vec_id, label <> 3 AND vec_id % 10 <> 0 AS valid FROM {embeddings}""")
def _(v):
    data = F.transform("embedding", lambda e: F.floor(e * 1000).cast("int"))
    chunks = v.embeddings.select(
        "vec_id",
        "label",
        F.when(F.col("vec_id") % 10 == 0, F.slice(data, 1, 5)).otherwise(data).alias("data"),
        F.size("embedding").alias("w"),
        F.lit(1).alias("h"),
    )
    digest = F.sha2(F.array_join("data", ",").cast("binary"), 256)
    stored = chunks.withColumn("checksum", F.when(F.col("label") == 3, "0").otherwise(digest))
    return stats.chunk_check(stored).select("vec_id", "valid")
