"""Scans and sinks over text, JSON, XML and file listings."""

import uuid

from pyspark.sql import functions as F

from tessella import constants as C
from tessella.operators import tiles as T
from tessella.plans.planning import plan_tiles
from tessella.queries import query
from tessella.session import shared_folder
from tessella.sources import catalogs, records

CATALOG = """
    SELECT CAST(split_part(p, '/', 1) AS INT) AS z, CAST(split_part(p, '/', 2) AS BIGINT) AS x,
           CAST(split_part(split_part(p, '/', 3), '.', 1) AS BIGINT) AS y, 'jpg' AS ext,
           CAST(split_part(line, ',', 2) AS BIGINT) AS mtime, CAST(split_part(line, ',', 3) AS BIGINT) AS size,
           split_part(line, ',', 4) AS md5
    FROM (SELECT line, split_part(line, ',', 1) AS p FROM {fx_catalog}) AS c
    WHERE regexp_matches(line, '^[0-9]+/[0-9]+/[0-9]+[.]jpg,[0-9]+,[0-9]+(,.*)?$')"""


@query("src_tile_catalog", CATALOG)
def _(v):
    return catalogs.parse_catalog_lines(v.fx_catalog)


PATHS = """
    SELECT event_id, event_type AS layer, concat('file:/cache/', event_type, '/', CASE WHEN event_id % 41 = 0 THEN 'tmp' ELSE CAST(3 + event_id % 6 AS VARCHAR(8)) END, '/',
           event_id % 97, '/', event_id % 89, CASE event_id % 7 WHEN 0 THEN '.txt' WHEN 1 THEN '.JPG' WHEN 2 THEN '.jpeg' WHEN 3 THEN 'a.png' WHEN 4 THEN '.tmp.webp' ELSE '.png' END) AS path FROM {events}"""
KEYS = """CAST(split_part(path, '/', 4) AS INT) AS z, CAST(split_part(path, '/', 5) AS BIGINT) AS x,
          CAST(split_part(split_part(path, '/', 6), '.', 1) AS BIGINT) AS y, substr(split_part(path, '/', 6), strpos(split_part(path, '/', 6), '.') + 1) AS ext"""
GOOD = "regexp_matches(path, '/[0-9]+/[0-9]+/[0-9]+[.][^/]+$')"


@query("src_xyz_dir", f"SELECT event_id, {KEYS} FROM ({PATHS}) AS p WHERE {GOOD}")
def _(v):
    return catalogs.tile_paths(v.sql(PATHS)).select("event_id", "z", "x", "y", "ext")


@query("src_cached_layer_tiles", f"""
    SELECT event_id, layer, z, x, y FROM (
      SELECT *, max(z) OVER (PARTITION BY layer) AS best FROM (
        SELECT event_id, layer, {KEYS} FROM ({PATHS}) AS p WHERE {GOOD}) AS k
      WHERE lower(split_part(ext, '.', -1)) IN ('jpg', 'jpeg', 'png', 'webp') AND z BETWEEN 2 AND 7) AS m WHERE z = best""")
def _(v):
    tiles = catalogs.cached_layer_tiles(v.sql(PATHS), 2, 7)
    return tiles.select("event_id", "layer", "z", "x", "y")


PLAN_TEXT = """
    SELECT o_orderkey, concat('{"z":', 6 + o_orderkey % 6, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat(',"x":', o_orderkey % 64) END, ',"y":', o_custkey % 64,
           ',"bbox":[', CASE WHEN o_orderkey % 31 = 0 THEN '1.5,2.5' ELSE concat(o_custkey % 170, '.5,1.0,', 1 + o_custkey % 170, '.5,2.0') END, ']',
           ',"start_date":"', CASE WHEN o_orderkey % 37 = 0 THEN 'soon' ELSE '2024-04-01' END, '","end_date":"2024-10-31"',
           CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ',"season":"s","max_cloud":40.0' END,
           CASE WHEN o_orderkey % 5 = 0 THEN ',"shard":"03"' ELSE '' END,
           CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE '}' END) AS value
    FROM {orders}"""


@query("src_plan", """
    SELECT CAST(6 + o_orderkey % 6 AS INT) AS z, o_orderkey % 64 AS x, o_custkey % 64 AS y, o_custkey % 170 + 0.5E0 AS minx,
           DATE '2024-04-01' AS start_date, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE 's' END AS season, 'global' AS hemisphere,
           CASE WHEN o_orderkey % 3 = 0 THEN 100.0E0 ELSE 40.0E0 END AS max_cloud, CASE WHEN o_orderkey % 3 = 0 THEN 100.0E0 ELSE 40.0E0 END AS fallback_max_cloud,
           CASE WHEN o_orderkey % 5 = 0 THEN '03' END AS shard
    FROM {orders} WHERE o_orderkey % 29 <> 0 AND o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0 AND o_orderkey % 41 <> 0""")
def _(v):
    plan = records.parse_plan(v.sql(PLAN_TEXT))
    return plan.select(
        "z", "x", "y", "minx", "start_date", "season", "hemisphere", "max_cloud", "fallback_max_cloud", "shard"
    )


@query("snk_plan", """
    SELECT z, x, y, round(w, 9) AS minx, round(s, 9) AS miny, round(e, 9) AS maxx, round(n, 9) AS maxy,
           CASE WHEN north THEN DATE '2024-04-01' ELSE DATE '2023-10-01' END AS start_date, CASE WHEN north THEN DATE '2024-10-31' ELSE DATE '2024-04-30' END AS end_date,
           CASE WHEN north THEN 'northern_growing_season' ELSE 'southern_growing_season' END AS season, CASE WHEN north THEN 'north' ELSE 'south' END AS hemisphere,
           'hls2-s30,hls2-l30' AS collections, 'landsat-c2-l2' AS fallback_collections, 40.0E0 AS max_cloud, 60.0E0 AS fallback_max_cloud, shard
    FROM (SELECT *, (s + n) / 2 >= 0 AS north FROM (
      SELECT DISTINCT z, x, y, x / power(2, z) * 360.0 - 180.0 AS w, (x + 1) / power(2, z) * 360.0 - 180.0 AS e,
             degrees(atan(sinh(pi() * (1.0 - 2.0 * (y + 1) / power(2, z))))) AS s, degrees(atan(sinh(pi() * (1.0 - 2.0 * y / power(2, z))))) AS n FROM {fx_tiles}) AS b) AS t
    JOIN (VALUES """ + ", ".join(f"('{i:02d}', {a}, {b}, {c}, {d})" for i, (a, b, c, d) in enumerate(C.SHARD_RECTANGLES)) + """) AS r(shard, x0, y0, x1, y1)
      ON x >> (z - 6) BETWEEN x0 AND x1 AND y >> (z - 6) BETWEEN y0 AND y1
    WHERE EXISTS (SELECT 1 FROM (VALUES """ + ", ".join(str(b) for b in C.LAND_BOXES) + """) AS l(w0, s0, e0, n0)
      WHERE (e >= w0 - 20.0 / 111.32 AND w <= e0 + 20.0 / 111.32 AND n >= s0 - 20.0 / 111.32 AND s <= n0 + 20.0 / 111.32) OR n > 75.0 OR s < -75.0)""")
def _(v):
    plan = plan_tiles(v.fx_tiles.select("z", "x", "y").distinct(), 2024)
    back = records.parse_plan(records.plan_json(plan))
    box = {n: F.round(n, 9) for n in ("minx", "miny", "maxx", "maxy")}
    return back.withColumns({**box, **{n: F.array_join(n, ",") for n in ("collections", "fallback_collections")}})


@query("snk_plan_by_shard", """
    SELECT shard, count(*) AS tiles FROM (
      SELECT coalesce(CASE WHEN o_orderkey % 5 = 0 THEN '03' END, s.shard) AS shard
      FROM {orders} JOIN (VALUES """ + ", ".join(
    f"('{i:02d}', {a}, {b}, {c}, {d})"
    for i, (a, b, c, d) in enumerate(C.SHARD_RECTANGLES)
) + """) AS s(shard, x0, y0, x1, y1)
        ON (o_orderkey % 64) >> (o_orderkey % 6) BETWEEN x0 AND x1 AND (o_custkey % 64) >> (o_orderkey % 6) BETWEEN y0 AND y1
      WHERE o_orderkey % 29 <> 0 AND o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0 AND o_orderkey % 41 <> 0) AS p GROUP BY shard""")
def _(v):
    folder = f"{shared_folder(v.spark)}/{uuid.uuid4().hex}"
    records.write_plan_by_shard(records.parse_plan(v.sql(PLAN_TEXT)), folder)
    back = v.spark.read.schema("z int, x bigint, y bigint, shard string").json(folder)
    return back.filter("z IS NOT NULL").groupBy("shard").agg(F.count("*").alias("tiles"))


ITEMS = """
    SELECT o_orderkey, o_custkey % 170 + 0.25E0 AS t_minx, 1.5E0 AS t_miny, o_custkey % 170 + 1.25E0 AS t_maxx, 2.5E0 AS t_maxy,
           concat('{"id":"S', o_orderkey, '","collection":"hls2-s30"', CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat(',"bbox":[', o_custkey % 170, '.0,1.0,', o_custkey % 170 + 2, '.0,3.0]') END,
           ',"properties":{"datetime":"2024-0', 1 + o_orderkey % 9, '-15T10:00:00Z","eo:cloud_cover":', CASE o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"n/a"' ELSE concat(o_orderkey % 101, '.5') END, '}',
           ',"assets":{', CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE '"B02":{"href":"http://a/2"},' END, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '"B03":{"href":"http://a/3"},' END,
           CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '"Fmask":{"href":"http://a/q"},' END, '"thumb":{"href":"http://a/t"}}}') AS value
    FROM {orders}"""


@query("src_scene_items", """
    SELECT concat('S', o_orderkey) AS item_id, 'hls2-s30' AS collection_id, make_date(2024, CAST(1 + o_orderkey % 9 AS INT), 15) AS acq_date,
           CASE WHEN o_orderkey % 4 > 1 THEN o_orderkey % 101 + 0.5E0 END AS cloud,
           CASE WHEN o_orderkey % 6 = 0 THEN o_custkey % 170 + 0.25E0 ELSE o_custkey % 170 + 0.0E0 END AS minx,
           CAST(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END + CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS INT) AS n_bands,
           CASE WHEN o_orderkey % 3 <> 0 THEN 'http://a/q' END AS qa_href
    FROM {orders} WHERE o_orderkey % 10 <> 0""")
def _(v):
    items = records.parse_items(v.sql(ITEMS))
    scenes = records.scene_items(items, ("B02", "B03"), "Fmask", ("t_minx", "t_miny", "t_maxx", "t_maxy"))
    return scenes.select(
        "item_id", "collection_id", "acq_date", "cloud", "minx", F.size("bands").alias("n_bands"), "qa_href"
    )


@query("src_scene_items_strict", """
    SELECT concat('S', o_orderkey) AS item_id, CAST(epoch(make_timestamp(2024, 1 + o_orderkey % 9, 15, 10, 0, 0)) AS BIGINT) AS acquired,
           o_custkey % 170 + 2.0E0 AS maxx, 'http://a/2,http://a/3' AS hrefs
    FROM {orders} WHERE o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 0""")
def _(v):
    scenes = records.scene_items_strict(records.parse_items(v.sql(ITEMS)), ("B02", "B03"))
    hrefs = F.array_join(F.array_sort(F.map_values("assets")), ",")
    return scenes.select("item_id", F.unix_seconds("acquired").alias("acquired"), "maxx", hrefs.alias("hrefs"))


@query("src_manifest", """
    SELECT collection_id, item_id, cloud FROM {fx_scenes}""")
def _(v):
    scenes = v.fx_scenes.select(F.date_format("acq_date", "yyyyMMdd").alias("day"), "collection_id", "item_id", "cloud")
    entries = F.concat_ws(",", F.collect_list(F.to_json(F.struct("collection_id", "item_id", "cloud"))))
    text = F.concat(F.lit('{"summary":{"n":'), F.count("*").cast("string"), F.lit('},"scenes":["text",7,'), entries, F.lit("]}"))
    docs = scenes.groupBy("day").agg(text.alias("value"))
    return records.parse_manifest(docs, "collection_id string, item_id string, cloud double")


@query("snk_manifest", """
    SELECT strftime(acq_date, '%Y%m%d') AS day, count(*) OVER (PARTITION BY acq_date) AS n, collection_id, item_id, cloud FROM {fx_scenes}""")
def _(v):
    scenes = v.fx_scenes.select(F.date_format("acq_date", "yyyyMMdd").alias("day"), "item_id", "collection_id", "cloud")
    folder = f"{shared_folder(v.spark)}/{uuid.uuid4().hex}"
    records.write_manifests(scenes.groupBy("day").agg(F.count("*").alias("n")), scenes, "day", folder)
    lines = v.spark.read.schema("value string, day string").text(folder)
    summary = records.parse_manifest_lines(lines, "summary", "n bigint")
    return records.parse_manifest_lines(lines, "scene", "collection_id string, item_id string, cloud double").join(summary, "day")


@query("src_oam_items", """
    SELECT url, gsd, minx, maxy, acquisition_start, CASE WHEN image_id % 4 <> 0 THEN 'CC-BY' END AS license
    FROM {fx_images} WHERE gsd IS NOT NULL AND image_id % 17 <> 0""")
def _(v):
    box = F.when(F.col("image_id") % 17 == 0, F.array("minx")).otherwise(F.array("minx", "miny", "maxx", "maxy"))
    license = F.struct(F.when(F.col("image_id") % 4 != 0, "CC-BY").alias("license")).alias("properties")
    row = F.struct(F.col("url").alias("uuid"), "gsd", box.alias("bbox"), "acquisition_start", license)
    docs = v.fx_images.select(F.to_json(F.struct(F.array(row).alias("results"))).alias("value"))
    return records.parse_images(docs).select("url", "gsd", "minx", "maxy", "acquisition_start", "license")


@query("src_asset_catalog", """
    SELECT asset_id, name, CASE WHEN size > 0 THEN license ELSE '' END AS license, 'unknown' AS media_type, checksum, 'raw' AS destination FROM {fx_assets}""")
def _(v):
    body = F.struct("name", F.when(F.col("size") > 0, F.col("license")).alias("license"), "checksum", F.lit("raw").alias("destination"))
    docs = v.fx_assets.select(F.to_json(F.create_map("asset_id", body)).alias("value"))
    parsed = catalogs.parse_asset_catalog(docs)
    return parsed.select("asset_id", "name", "license", "media_type", "checksum", "destination")


@query("src_layers_xml", """
    SELECT p_partkey, p_brand AS name, p_type AS title FROM {part}
    UNION ALL SELECT p_partkey, p_name, p_name FROM {part}
    UNION ALL SELECT p_partkey, concat('deep_', p_size), 'Deep' FROM {part}""")
def _(v):
    docs = v.part.select(
        "p_partkey",
        F.format_string(
            '<W xmlns="http://www.opengis.net/wms"><Capability><Layer><Title>root</Title><Layer><Name> %s </Name><Title>%s</Title></Layer>'
            "<Layer><Name>%s</Name><Layer><Name>deep_%d</Name><Title>Deep</Title></Layer></Layer></Layer></Capability></W>",
            "p_brand", "p_type", "p_name", "p_size",
        ).alias("xml"),
    )
    return catalogs.parse_layers_xml(docs)


@query("src_features", """
    SELECT region_id, count(*) AS edges, round(sum(x1 * y2 - x2 * y1), 6) AS twice_area FROM {fx_edges} WHERE nation < 20 GROUP BY region_id""")
def _(v):
    points = F.array_sort(F.collect_list(F.struct("corner", "lon", "lat")))
    rings = v.fx_corners.groupBy("region_id", "nation").agg(points.alias("p")).withColumn(
        "ring", F.transform("p", lambda c: F.array(c.lon, c.lat))
    )
    closed = F.concat("ring", F.slice("ring", 1, 1))
    feature = F.struct(
        F.struct(F.col("region_id").cast("string").alias("region"), F.col("nation").cast("string").alias("nation")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"),
    )
    docs = rings.select("region_id", F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    where = F.col("properties.nation").cast("int") < 20
    edges = records.parse_features(docs, where=where)
    names = docs.select(F.from_json("value", records.FEATURE_SCHEMA)["features"][0].alias("f")).select(
        F.xxhash64("f.geometry.coordinates", F.to_json("f.properties")).alias("feature_id"),
        F.col("f.properties.region").cast("bigint").alias("region_id"),
    )
    area = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    return edges.join(names, "feature_id").groupBy("region_id").agg(
        F.count("*").alias("edges"), F.round(area, 6).alias("twice_area")
    )


BAND_PATHS = """
    SELECT concat('file:/in/', tile, '/', 'MCD43A4_', band, '_doy', day, '_aid1.tif') AS path, tile, band, day FROM (
      SELECT concat('h', lpad(CAST(o_custkey % 36 AS VARCHAR(8)), 2, '0'), 'v', lpad(CAST(o_custkey % 18 AS VARCHAR(8)), 2, '0')) AS tile,
             concat('Band', 1 + o_orderkey % 4) AS band, concat('2024', lpad(CAST(1 + o_orderkey % 5 AS VARCHAR(8)), 3, '0')) AS day FROM {orders}) AS o"""


@query("src_band_files", f"""
    SELECT e.tile, b.band, e.day AS date, min(f.path) AS path FROM (SELECT DISTINCT tile, day FROM ({BAND_PATHS}) AS a) AS e
    CROSS JOIN (VALUES ('Band1'), ('Band3'), ('Band4')) AS b(band)
    LEFT JOIN ({BAND_PATHS}) AS f ON f.tile = e.tile AND f.day = e.day AND f.band = b.band GROUP BY 1, 2, 3""")
def _(v):
    files = v.sql(BAND_PATHS)
    expected = files.select("tile", F.col("day").alias("date")).distinct().withColumn(
        "band", F.explode(F.array(F.lit("Band1"), F.lit("Band3"), F.lit("Band4")))
    )
    return catalogs.band_files(files.select("path"), expected)


@query("src_tileset_meta", """
    SELECT src, CASE WHEN src = 1 THEN 3 ELSE min(z) END AS minzoom, max(z) AS maxzoom,
           CASE WHEN src = 2 THEN NULL ELSE -10.5E0 END AS west, CASE WHEN src = 2 THEN 'here' ELSE '-10.5, 1,20 ,30' END AS bounds_text
    FROM {fx_tiles} GROUP BY src""")
def _(v):
    from tessella.sources.metadata import read_meta

    per = v.fx_tiles.select("src").distinct()
    pair = lambda n, val: F.struct(F.lit(n).alias("name"), val.alias("value"))
    meta = per.select(
        "src",
        F.explode(
            F.array(
                pair("bounds", F.when(F.col("src") == 2, "here").otherwise("-10.5, 1,20 ,30")),
                pair("minzoom", F.when(F.col("src") == 1, "3")),
            )
        ).alias("m"),
    ).select("src", "m.*").filter("value IS NOT NULL")
    table = read_meta(meta, v.fx_tiles, ["src"])
    return table.select("src", "minzoom", "maxzoom", F.get("bounds", F.lit(0)).alias("west"), "bounds_text")


@query("snk_tilejson", """
    SELECT src, '3.0.0' AS version, concat('pmtiles://set', src, '.pmtiles') AS tiles, min(z) AS minzoom, max(z) AS maxzoom,
           CASE src WHEN 0 THEN 'Imagery: NASA Blue Marble (2004).' WHEN 1 THEN 'Imagery: NASA MODIS MCD43A4 (LP DAAC).' ELSE 'Imagery: Copernicus Sentinel-2 (European Space Agency).' END AS attribution
    FROM {fx_tiles} GROUP BY src""")
def _(v):
    from tessella.sources.metadata import credits, tilejson

    zooms = T.zoom_range(v.fx_tiles, ["src"])
    source = F.when(F.col("src") == 0, "other").when(F.col("src") == 1, "modis").otherwise("sentinel2")
    label, credit = credits(source)
    sets = zooms.select(
        "src", F.format_string("set%d", "src").alias("name"), label.alias("description"), credit.alias("attribution"),
        "minzoom", "maxzoom", F.lit("jpg").alias("format"),
    )
    docs = tilejson(sets, ["src"])
    at = lambda path: F.get_json_object("tilejson", path)
    return docs.select(
        "src",
        at("$.tilejson").alias("version"),
        at("$.tiles[0]").alias("tiles"),
        at("$.minzoom").cast("int").alias("minzoom"),
        at("$.maxzoom").cast("int").alias("maxzoom"),
        at("$.attribution").alias("attribution"),
    )


@query("snk_asset_manifest", """
    SELECT a.asset_id, a.name, sha256(f.content) AS sha256, length(f.content) AS file_size, a.license IS NOT NULL AND a.size > 0 AS has_license
    FROM {fx_assets} AS a JOIN {fx_files} AS f ON a.asset_id = f.asset_id""")
def _(v):
    from tessella.sources.metadata import asset_manifest

    catalog = v.fx_assets.withColumn("license", F.when(F.col("size") > 0, F.col("license")))
    docs = asset_manifest(catalog.select("asset_id", "name", "license"), v.fx_files)
    at = lambda path: F.get_json_object("source", path)
    return docs.select(
        "asset_id",
        at("$.name").alias("name"),
        at("$.sha256").alias("sha256"),
        at("$.file_size").cast("bigint").alias("file_size"),
        F.col("source").contains('"license"').alias("has_license"),
    )


NEWEST = """(SELECT z, x, y, payload FROM (SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY seq DESC) AS r FROM {fx_tiles}) AS t WHERE r = 1)"""


def _archived(v):
    """Newest tiles written as one archive per shard in the shared folder."""
    from tessella.functions.grid import shard_of_tile
    from tessella.sources import archives

    folder = f"{shared_folder(v.spark)}/{uuid.uuid4().hex}"
    tiles = T.last_wins(v.fx_tiles, ["seq"]).withColumn("shard", shard_of_tile("z", "x", "y"))
    archives.write_archives(tiles, folder, meta={"name": "fixture", "format": "json"})
    return archives, folder


@query("src_mbtiles", f"SELECT CAST(z AS INT) AS z, x, y, payload FROM {NEWEST} AS n")
def _(v):
    archives, folder = _archived(v)
    tiles = archives.read_archives(v.spark, folder)
    return tiles.select("z", "x", "y", F.col("payload").cast("string").alias("payload"))


@query("snk_mbtiles_shards", f"""
    SELECT concat(shard, '_0.mbtiles') AS archive, CAST(min(z) AS VARCHAR) AS minzoom, CAST(max(z) AS VARCHAR) AS maxzoom, 'fixture' AS name, count(*) AS tiles
    FROM {NEWEST} AS n JOIN (VALUES """ + ", ".join(
    f"('{i:02d}', {a}, {b}, {c}, {d})"
    for i, (a, b, c, d) in enumerate(C.SHARD_RECTANGLES)
) + """) AS s(shard, x0, y0, x1, y1) ON (x >> (z - 6)) BETWEEN x0 AND x1 AND (y >> (z - 6)) BETWEEN y0 AND y1 GROUP BY 1""")
def _(v):
    archives, folder = _archived(v)
    counts = archives.read_archives(v.spark, folder).groupBy("archive").agg(F.count("*").alias("tiles"))
    value = lambda name: F.max(F.when(F.col("name") == name, F.col("value"))).alias(name)
    meta = archives.read_archive_meta(v.spark, folder).groupBy("archive").agg(value("minzoom"), value("maxzoom"), value("name"))
    return meta.join(counts, "archive").select("archive", "minzoom", "maxzoom", "name", "tiles")
