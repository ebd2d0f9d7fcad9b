"""Compositions."""

from pyspark.sql import functions as F

from tessella.functions.grid import Box
from tessella.operators import chunks as CH
from tessella.operators import pixels as PX
from tessella.operators import stats
from tessella.plans import aoi, manifests, mosaics, planet
from tessella.plans.planning import plan_tiles, grid_tiles, land_tiles
from tessella.queries import query
from tessella.queries.filters import BOUNDS, LAND, POINT_TILES, point_tiles
from tessella.queries.joins import CANDIDATES, Z5_PLAN, z5_plan
from tessella.queries.raster import (
    CELLS, GROWN, LON, PLAT, clear_rows, layer_chunks, marked_chunks, overzoom_ctes, overzoom_sql, plane_columns, qa_chunks, stack_chunks,
    visible_pixels,
)
from tessella.queries.scalars import PRODUCT, ROW, SHARDS, clip

Z10 = POINT_TILES.replace("7 AS z", "10 AS z").replace("128", "1024")


@query("pipe_plan", f"""
    SELECT CAST(z AS INT) AS z, x, y, CASE WHEN (s + n) / 2 >= 0 THEN 'northern_growing_season' ELSE 'southern_growing_season' END AS season,
           CASE WHEN (s + n) / 2 >= 0 THEN DATE '2024-04-01' ELSE DATE '2023-10-01' END AS start_date, shard, round(w, 9) AS minx, round(n, 9) AS maxy
    FROM (SELECT z, x, y, {BOUNDS} FROM {Z10} AS p) AS t JOIN {SHARDS} ON x >> 4 BETWEEN x0 AND x1 AND y >> 4 BETWEEN y0 AND y1 WHERE {LAND}""")
def _(v):
    plan = plan_tiles(point_tiles(v, 10), 2024)
    return plan.select(
        "z", "x", "y", "season", "start_date", "shard", F.round("minx", 9).alias("minx"), F.round("maxy", 9).alias("maxy")
    )


AOIS = """SELECT s_suppkey AS aoi_id, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 3 % 340 - 170.5E0 END AS minx, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 7 % 140 - 70.5E0 END AS miny,
    CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 3 % 340 - 166.25E0 END AS maxx, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 7 % 140 - 68.25E0 END AS maxy,
    CASE WHEN s_suppkey % 3 = 1 THEN lpad(CAST(s_suppkey % 18 AS VARCHAR(8)), 2, '0') END AS shard,
    CASE WHEN s_suppkey % 3 = 2 OR s_suppkey % 12 = 3 THEN s_suppkey END AS region_id, s_suppkey % 2 = 0 AS land_only, s_suppkey % 5 * 11.5E0 AS buffer_km FROM {supplier}"""


@query("pipe_aoi", f"""
    WITH aois AS ({AOIS}),
    shards AS (SELECT shard, x0 / 64.0 * 360.0 - 180.0 AS a, degrees(atan(sinh(pi() * (1.0 - 2.0 * (y1 + 1) / 64.0)))) AS b, (x1 + 1) / 64.0 * 360.0 - 180.0 AS c, degrees(atan(sinh(pi() * (1.0 - 2.0 * y0 / 64.0)))) AS d FROM {SHARDS}),
    regions AS (SELECT region_id, min(x1) AS a, min(y1) AS b, max(x1) AS c, max(y1) AS d FROM {{fx_edges}} GROUP BY region_id),
    boxes AS (SELECT aoi_id, land_only, buffer_km, r.region_id IS NOT NULL AS polygon, coalesce(minx, s.a, r.a) AS a, coalesce(miny, s.b, r.b) AS b, coalesce(maxx, s.c, r.c) AS c, coalesce(maxy, s.d, r.d) AS d
      FROM aois LEFT JOIN shards AS s USING (shard) LEFT JOIN regions AS r USING (region_id) WHERE NOT (minx IS NOT NULL AND aois.region_id IS NOT NULL)),
    grown AS (SELECT aoi_id, land_only, CASE WHEN polygon THEN a - g WHEN buffer_km > 0 THEN greatest(a - h, -180.0) ELSE a END AS a, CASE WHEN polygon THEN b - g WHEN buffer_km > 0 THEN greatest(b - g, -90.0) ELSE b END AS b,
        CASE WHEN polygon THEN c + g WHEN buffer_km > 0 THEN least(c + h, 180.0) ELSE c END AS c, CASE WHEN polygon THEN d + g WHEN buffer_km > 0 THEN least(d + g, 90.0) ELSE d END AS d
      FROM (SELECT *, buffer_km / 111.32 AS g, buffer_km / 111.32 / greatest(cos(radians((b + d) / 2)), 0.01) AS h FROM boxes) AS k),
    spans AS (SELECT *, {clip('(a + 180.0) / 360.0 * 32', '5')} AS tx0, {clip('(c + 180.0) / 360.0 * 32', '5')} AS tx1,
        {clip(ROW.format(lat='greatest(-85.0511287798066, least(85.0511287798066, d))', z='5'), '5')} AS ty0, {clip(ROW.format(lat='greatest(-85.0511287798066, least(85.0511287798066, b))', z='5'), '5')} AS ty1 FROM grown WHERE land_only),
    cut AS (SELECT aoi_id, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, any_value(d) AS d, min(w) AS w, min(s) AS s, max(e) AS e, max(n) AS n FROM spans JOIN {Z5_PLAN} AS l ON l.x BETWEEN tx0 AND tx1 AND l.y BETWEEN ty0 AND ty1 GROUP BY aoi_id)
    SELECT aoi_id, round(a, 7) AS minx, round(b, 7) AS miny, round(c, 7) AS maxx, round(d, 7) AS maxy FROM grown WHERE NOT land_only
    UNION ALL SELECT aoi_id, round(greatest(a, w), 7), round(greatest(b, s), 7), round(least(c, e), 7), round(least(d, n), 7) FROM cut
    UNION ALL SELECT g.aoi_id, round(l.w, 7), round(l.s, 7), round(l.e, 7), round(l.n, 7) FROM grown AS g, (SELECT min(w) AS w, min(s) AS s, max(e) AS e, max(n) AS n FROM {Z5_PLAN} AS q) AS l
      WHERE g.land_only AND g.aoi_id NOT IN (SELECT aoi_id FROM cut)""")
def _(v):
    land = land_tiles(grid_tiles(v.spark, 5))
    boxes = aoi.resolve_aois(v.sql(AOIS), v.fx_edges, land, 5)
    return boxes.select("aoi_id", *[F.round(c, 7).alias(c) for c in aoi.BOX])


@query("pipe_scene_manifest", f"""
    SELECT collection_id, item_id, acq_date, cloud, x, y FROM (
      SELECT *, row_number() OVER (PARTITION BY collection_id, item_id ORDER BY x, y) AS seen FROM (
        SELECT *, row_number() OVER (PARTITION BY x, y, bin ORDER BY cloud, r) AS pick FROM (
          SELECT *, CASE WHEN n <= 3 THEN r - 1 ELSE (r * 3 - 1) // n END AS bin FROM (
            SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY acq_date, cloud, collection_id, item_id) AS r, count(*) OVER (PARTITION BY x, y) AS n FROM (
              SELECT *, max(CASE WHEN role = 'primary' THEN 1 ELSE 0 END) OVER (PARTITION BY x, y) AS has_primary FROM {CANDIDATES} AS c) AS b
            WHERE (role = 'primary') = (has_primary = 1)) AS d) AS e) AS f WHERE pick = 1) AS g WHERE seen = 1""")
def _(v):
    scenes, _ = manifests.scene_manifest(z5_plan(v), v.fx_scenes, 3)
    return scenes.select("collection_id", "item_id", "acq_date", "cloud", "x", "y")


TARGETS = """SELECT s_suppkey AS ord, CASE WHEN s_suppkey % 3 = 0 THEN 'hls' ELSE 'sentinel2' END AS source, s_suppkey * 7 % 358 - 179.6E0 AS minx, s_suppkey * 11 % 168 - 83.7E0 AS miny,
    s_suppkey * 7 % 358 - 179.1E0 AS maxx, s_suppkey * 11 % 168 - 83.2E0 AS maxy FROM {supplier}"""
COVERING = f"""(SELECT ord, source, collection_id, item_id FROM (SELECT t.ord, t.source, c.collection_id, c.item_id, row_number() OVER (PARTITION BY ord ORDER BY coalesce(cloud, 100), acq_date DESC, item_id) AS r
    FROM ({TARGETS}) AS t JOIN {{fx_scenes}} AS c ON c.minx <= t.minx AND c.miny <= t.miny AND c.maxx >= t.maxx AND c.maxy >= t.maxy) AS k WHERE r <= LIMIT_N)"""


@query("pipe_s2_manifest", f"SELECT ord, collection_id, item_id FROM {COVERING.replace('LIMIT_N', '10')} AS m")
def _(v):
    found = manifests.covering_manifest(v.sql(TARGETS).drop("source"), v.fx_scenes, "ord", 10)
    return found.select("ord", "collection_id", "item_id")


CACHED = "SELECT collection_id, item_id, 'B03' AS asset FROM {fx_scenes} WHERE has_qa"


@query("pipe_prefetch_list", f"""
    SELECT collection_id, item_id, asset, min(ord) AS priority FROM {COVERING.replace('LIMIT_N', '4')} AS m, (VALUES ('B02'), ('B03')) AS a(asset)
    WHERE source = 'sentinel2' AND NOT EXISTS (SELECT 1 FROM ({CACHED}) AS k WHERE k.item_id = m.item_id AND k.asset = a.asset AND k.collection_id = m.collection_id) GROUP BY 1, 2, 3""")
def _(v):
    todo = manifests.prefetch_list(v.sql(TARGETS), v.fx_scenes, ("B02", "B03"), v.sql(CACHED), 4)
    return todo.select("collection_id", "item_id", "asset", "priority")


@query("pipe_product_worklist", f"""
    SELECT family, make_date(CAST(substr(code, 1, 4) AS INT), 1, 1) + (CAST(substr(code, 5, 3) AS INT) - 1) AS acquired,
           coalesce(string_agg(DISTINCT CASE WHEN NOT have THEN tile END, ',' ORDER BY CASE WHEN NOT have THEN tile END), '') AS tiles, count(*) FILTER (WHERE have) AS reused
    FROM (SELECT *, product_id IN (SELECT product_id FROM {{fx_products}} WHERE o_orderstatus = 'F') AS have FROM ({PRODUCT}) AS q WHERE ok) AS t GROUP BY 1, 2""")
def _(v):
    existing = v.fx_products.filter(F.col("o_orderstatus") == "F")
    parts = []
    for prefix in ("modis_mcd43a4_", "viirs_vnp09ga_"):
        work = manifests.product_worklist(v.fx_products, existing, prefix)
        parts.append(work.select(F.lit(prefix.split("_")[0]).alias("family"), "acquired", F.array_join("tiles", ",").alias("tiles"), "reused"))
    return parts[0].unionByName(parts[1])


@query("pipe_clean_mosaic", f"""
    SELECT x, y, band, px, py, dn FROM (SELECT x, y, band, px, py, CAST(round_even(255 * pow(least(1.0, round_even(median(dn), 0) / 3000.0), 0.8), 0) AS INT) AS dn FROM (
      SELECT s.x, s.y, s.band, s.px, s.py, dn FROM {{fx_stack}} AS s
      WHERE dn <> 0 AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM {GROWN} AS g SEMI JOIN {{fx_qa}} AS k USING (scene, x, y)) AS m WHERE m.scene = s.scene AND m.x = s.x AND m.y = s.y AND m.px = s.px AND m.py = s.py)) AS c
    GROUP BY x, y, band, px, py) AS t WHERE dn <> 0""")
def _(v):
    done = mosaics.clean_mosaic(stack_chunks(v), qa_chunks(v), ("cirrus", "cloud", "adjacent_cloud", "cloud_shadow"), 1, "median")
    return clear_rows(done, ["x", "y", "band"])


S2_BOX = (-179.9, 85.0445, -179.5, 85.0505)


@query("pipe_s2_mosaic", f"""
    SELECT x, y, band, px, py, CAST(round_even(255 * least(1.0, dn / 10000.0), 0) AS INT) AS dn FROM (
      SELECT *, row_number() OVER (PARTITION BY x, y, band, px, py ORDER BY cloud NULLS LAST, scene DESC) AS r FROM {{fx_stack}} SEMI JOIN (SELECT scene FROM {{fx_stack}} WHERE {LON} BETWEEN {S2_BOX[0]} AND {S2_BOX[2]} AND {PLAT} BETWEEN {S2_BOX[1]} AND {S2_BOX[3]} GROUP BY scene, cloud ORDER BY cloud NULLS LAST, scene LIMIT 3) AS k USING (scene)
      WHERE dn <> 0 AND {LON} BETWEEN {S2_BOX[0]} AND {S2_BOX[2]} AND {PLAT} BETWEEN {S2_BOX[1]} AND {S2_BOX[3]}) AS t WHERE r = 1""")
def _(v):
    keys = ["scene", "cloud", "band", "z", "x", "y"]
    done = mosaics.visual_mosaic(marked_chunks(v, keys), 3, Box(*S2_BOX), 14)
    shown = plane_columns(done, ["x", "y", "band"], ["dn", "alpha"])
    return shown.filter("alpha > 0").drop("alpha")


AREA = (-61.0, -28.0, 71.0, 54.0)
AREA_TILES = " UNION ALL ".join(
    f"""SELECT {z} AS z, a.i AS x, b.i AS y FROM range({1 << z}) AS a(i), range({1 << z}) AS b(i)
    WHERE a.i BETWEEN floor(({AREA[0]} + 180.0) / 360.0 * {1 << z}) AND floor(({AREA[2]} + 180.0) / 360.0 * {1 << z})
      AND b.i BETWEEN floor({ROW.format(lat=AREA[3], z=z)}) AND floor({ROW.format(lat=AREA[1], z=z)})"""
    for z in (4, 5, 6)
)


@query("pipe_planet", f"""
    WITH {overzoom_ctes(AREA_TILES)} {overzoom_sql(AREA_TILES)} UNION ALL SELECT z, x, y, px, py, r, g, b FROM {{fx_layers}} WHERE src = 0 AND a = 255""")
def _(v):
    overlay = planet.Overlay("detail", "sentinel2", 1, (AREA,), 6)
    done = planet.build_planet(layer_chunks(v), 0, "bmng", 3, [overlay], 8)
    return visible_pixels(done, ["z", "x", "y"]).drop("a")


@query("pipe_tileset", f"""
    WITH finest AS (SELECT DISTINCT gx // 16 AS x, gy // 16 AS y FROM (
        SELECT a.i AS gx, b.i AS gy, floor((a.i + 0.5) / 512 * 360.0 - 180.0) AS lon, ceil(degrees(atan(sinh(pi() * (1.0 - 2.0 * (b.i + 0.5) / 512))))) AS lat
        FROM range(512) AS a(i), range(512) AS b(i)) AS g JOIN ({CELLS}) AS c USING (lon, lat)),
    box AS (SELECT min(x) / 32.0 * 360.0 - 180.0 AS minx, (max(x) + 1) / 32.0 * 360.0 - 180.0 AS maxx,
                   degrees(atan(sinh(pi() * (1.0 - 2.0 * (max(y) + 1) / 32.0)))) AS miny, degrees(atan(sinh(pi() * (1.0 - 2.0 * min(y) / 32.0)))) AS maxy FROM finest)
    SELECT CAST(z AS INT) AS z, CAST(count(*) AS BIGINT) AS tiles, count(*) > 0 AS valid, 2 AS minzoom, 5 AS maxzoom, round(any_value(minx), 7) AS minx, round(any_value(miny), 7) AS miny,
           round(any_value(maxx), 7) AS maxx, round(any_value(maxy), 7) AS maxy, round(any_value(minx + maxx) / 2, 7) AS center_lon, round(any_value(miny + maxy) / 2, 7) AS center_lat
    FROM (SELECT DISTINCT z, x >> (5 - z) AS x, y >> (5 - z) AS y FROM finest, range(2, 6) AS l(z)) AS t, box GROUP BY z""")
def _(v):
    pixels = PX.raster_to_tiles(v.sql(CELLS), [], 1.0, 5, 16)
    chunks = CH.assemble_chunks(pixels, ["z", "x", "y"], 16, 16)
    done = CH.pyramid(chunks, [], 5, 2, "average", nodata=0)
    found = planet.tileset_summary(done, planes=1)
    places = [F.round(c, 7).alias(c) for c in ("minx", "miny", "maxx", "maxy", "center_lon", "center_lat")]
    return found.select("z", "tiles", "valid", "minzoom", "maxzoom", *places)


@query("pipe_incremental", """
    SELECT output, bool_and(CASE WHEN was IS NOT NULL AND now IS NOT NULL AND was = now THEN true ELSE false END) AS reuse, count(now) AS sources FROM (
      SELECT concat('o', o_custkey % 700) AS output, concat('s', o_orderkey) AS source, CASE WHEN o_orderkey % 97 <> 0 THEN md5(o_orderpriority) END AS was,
             CASE WHEN o_orderkey % 89 <> 0 THEN md5(CASE WHEN o_orderkey % 101 = 0 THEN 'x' ELSE o_orderpriority END) END AS now FROM {orders}) AS t
    WHERE was IS NOT NULL OR now IS NOT NULL GROUP BY output""")
def _(v):
    key = F.concat(F.lit("o"), F.col("o_custkey") % 700).alias("output"), F.concat(F.lit("s"), "o_orderkey").alias("source")
    k = F.col("o_orderkey")
    recorded = v.orders.filter(k % 97 != 0).select(*key, F.md5("o_orderpriority").alias("digest"))
    content = F.when(k % 101 == 0, "x").otherwise(F.col("o_orderpriority"))
    current = v.orders.filter(k % 89 != 0).select(*key, F.md5(content).alias("digest"))
    counts = current.groupBy("output").agg(F.count("*").alias("sources"))
    return stats.reuse_outputs(recorded, current).join(counts, "output", "left").select(
        "output", "reuse", F.coalesce("sources", F.lit(0)).alias("sources")
    )
