"""Joins of plans, scenes, tiles, assets and sources."""

from pyspark.sql import functions as F

from tessella.functions.grid import shard_of_tile
from tessella.operators import scenes as SC
from tessella.operators import stats
from tessella.operators import tiles as T
from tessella.operators.chunks import assemble_chunks, composite_tiles
from tessella.operators.pixels import mask_pixels
from tessella.plans.planning import grid_tiles, plan_tiles
from tessella.queries import query
from tessella.session import cut_lineage
from tessella.queries.filters import BOUNDS, LAND, POINT_TILES, point_tiles
from tessella.queries.scalars import SHARDS

Z5_PLAN = f"""(SELECT z, x, y, w, s, e, n, CASE WHEN (s + n) / 2 >= 0 THEN DATE '2024-04-01' ELSE DATE '2023-10-01' END AS d0,
    CASE WHEN (s + n) / 2 >= 0 THEN DATE '2024-10-31' ELSE DATE '2024-04-30' END AS d1
    FROM (SELECT z, x, y, {BOUNDS} FROM (SELECT 5 AS z, a.i AS x, b.i AS y FROM range(32) AS a(i), range(32) AS b(i)) AS g) AS t WHERE {LAND})"""
CANDIDATES = f"""(SELECT p.z, p.x, p.y, CASE WHEN collection_id = 'landsat-c2-l2' THEN 'fallback' ELSE 'primary' END AS role, collection_id, item_id, acq_date, cloud
    FROM {Z5_PLAN} AS p JOIN {{fx_scenes}} AS c ON e >= minx AND w <= maxx AND n >= miny AND s <= maxy AND acq_date BETWEEN d0 AND d1
      AND cloud <= CASE WHEN collection_id = 'landsat-c2-l2' THEN 60 ELSE 40 END)"""


def z5_plan(v):
    return plan_tiles(grid_tiles(v.spark, 5), 2024)


@query("join_plan_scenes", f"SELECT CAST(z AS INT) AS z, x, y, role, item_id, cloud FROM {CANDIDATES} AS c")
def _(v):
    pairs = SC.match_plan_scenes(z5_plan(v), v.fx_scenes)
    return pairs.select("z", "x", "y", "role", "item_id", "cloud")


@query("join_shard", f"""
    SELECT seq, shard FROM {{fx_tiles}} JOIN {SHARDS} ON (x >> (z - 6)) BETWEEN x0 AND x1 AND (y >> (z - 6)) BETWEEN y0 AND y1""")
def _(v):
    return v.fx_tiles.select("seq", shard_of_tile("z", "x", "y").alias("shard")).dropna()


@query("join_known_tiles", """
    SELECT seq, z, x, y FROM {fx_tiles} AS t WHERE src <> 0 AND NOT EXISTS (SELECT 1 FROM {fx_tiles} AS k WHERE k.src = 0 AND k.z = t.z AND k.x = t.x AND k.y = t.y)""")
def _(v):
    known = v.fx_tiles.filter(F.col("src") == 0)
    return T.missing_tiles(v.fx_tiles.filter(F.col("src") != 0), known).select("seq", "z", "x", "y")


NEWEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, z, x, y ORDER BY seq DESC) AS d FROM {fx_tiles}) AS a WHERE d = 1)"


@query("join_overlay_wins", f"""
    SELECT z, x, y, seq, payload FROM {NEWEST} AS o WHERE src = 1
    UNION ALL SELECT z, x, y, seq, payload FROM {NEWEST} AS b WHERE src = 0
      AND NOT EXISTS (SELECT 1 FROM {{fx_tiles}} AS k WHERE k.src = 1 AND k.z = b.z AND k.x = b.x AND k.y = b.y)""")
def _(v):
    newest = T.last_wins(v.fx_tiles, ["seq"], ["src", "z", "x", "y"]).select("src", "z", "x", "y", "seq", "payload")
    base, overlay = (newest.filter(F.col("src") == i).drop("src") for i in (0, 1))
    return T.overlay_wins(base, cut_lineage(overlay))


@query("join_alpha_composite", """
    SELECT x, y, px, py, CASE WHEN t.a = 255 THEN t.r ELSE b.r END AS r, CASE WHEN t.a = 255 THEN t.g ELSE b.g END AS g,
           CASE WHEN t.a = 255 THEN t.b ELSE b.b END AS b
    FROM (SELECT * FROM {fx_rgba} WHERE ord = 0 AND a = 255) AS b FULL JOIN (SELECT * FROM {fx_rgba} WHERE ord = 1 AND a = 255) AS t USING (x, y, px, py)""")
def _(v):
    from tessella.queries.raster import rgba_chunks, visible_pixels

    chunks = rgba_chunks(v.fx_rgba, ["ord", "z", "x", "y"], 8)
    done = composite_tiles(chunks.filter(F.col("ord") == 0), chunks.filter(F.col("ord") == 1), 8)
    return visible_pixels(done, ["x", "y"]).drop("a")


@query("join_nearest_ancestor", f"""
    SELECT src, CAST(z AS INT) AS z, x, y, anc_z, x - ((x >> (z - anc_z)) << (z - anc_z)) AS off_x, y - ((y >> (z - anc_z)) << (z - anc_z)) AS off_y FROM (
      SELECT k.src, p.z, p.x, p.y, CAST(max(k.z) AS INT) AS anc_z FROM {POINT_TILES.replace('7 AS z', '12 AS z').replace('128', '4096')} AS p
      JOIN (SELECT DISTINCT src, z, x, y FROM {{fx_tiles}}) AS k ON k.z <= p.z AND k.x = p.x >> (p.z - k.z) AND k.y = p.y >> (p.z - k.z)
      GROUP BY k.src, p.z, p.x, p.y) AS t""")
def _(v):
    requests = T.for_sources(point_tiles(v, 12), [0, 1, 2])
    best = T.nearest_ancestor(requests, v.fx_tiles, ["src"])
    return best.select("src", "z", "x", "y", "anc_z", "off_x", "off_y")


@query("join_children", """
    SELECT z - 1 AS z, x >> 1 AS x, y >> 1 AS y, max(CASE WHEN x % 2 = 0 AND y % 2 = 0 THEN seq END) AS nw, max(CASE WHEN x % 2 = 1 AND y % 2 = 0 THEN seq END) AS ne,
           max(CASE WHEN x % 2 = 0 AND y % 2 = 1 THEN seq END) AS sw, max(CASE WHEN x % 2 = 1 AND y % 2 = 1 THEN seq END) AS se FROM {fx_tiles} GROUP BY 1, 2, 3""")
def _(v):
    return T.children_of(v.fx_tiles, "seq")


@query("join_scene_qa", """
    SELECT s.scene, s.x, s.y, s.band, s.px, s.py, CASE WHEN qa & 15 <> 0 THEN 0 ELSE dn END AS dn
    FROM {fx_stack} AS s LEFT JOIN {fx_qa} AS q USING (scene, z, x, y, px, py)""")
def _(v):
    done = mask_pixels(v.fx_stack, v.fx_qa, ["scene", "z", "x", "y"], 15)
    return done.select("scene", "x", "y", "band", "px", "py", "dn")


@query("join_asset_verify", """
    SELECT coalesce(a.asset_id, f.asset_id) AS asset_id, CASE WHEN a.asset_id IS NULL THEN 'unknown' WHEN f.asset_id IS NULL THEN 'missing'
           WHEN sha256(expected) <> sha256(content) THEN 'mismatch' ELSE 'ok' END AS status
    FROM {fx_assets} AS a FULL JOIN {fx_files} AS f ON a.asset_id = f.asset_id""")
def _(v):
    catalog = v.fx_assets.withColumn("checksum", F.sha2(F.col("expected").cast("binary"), 256))
    return stats.verify_assets(catalog, v.fx_files)


@query("join_source_ceiling", """
    SELECT image_id, source, CASE WHEN gsd IS NOT NULL THEN CAST(greatest(0, least(24, floor(log2(156543.03392804097 / gsd)))) AS INT)
           WHEN source = 'openaerialmap' THEN 22 WHEN source = 'modis' THEN 8 END AS ceiling
    FROM (SELECT *, CASE image_id % 3 WHEN 0 THEN 'openaerialmap' WHEN 1 THEN 'modis' ELSE 'unlisted' END AS source FROM {fx_images}) AS i""")
def _(v):
    named = F.when(F.col("image_id") % 3 == 0, "openaerialmap").when(F.col("image_id") % 3 == 1, "modis")
    images = v.fx_images.withColumn("source", named.otherwise("unlisted"))
    return stats.with_ceiling(images, "gsd").select("image_id", "source", "ceiling")
