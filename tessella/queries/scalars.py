"""Column expressions of the grid, text, URL and time functions."""

from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions import grid as G
from tessella.functions import scalars as S
from tessella.queries import query
from tessella.session import pinned

LAT = "degrees(atan(sinh(pi() * (1.0 - 2.0 * ({row}) / power(2, z)))))"


def rounded(box, digits=9, prefix=""):
    return [F.round(c, digits).alias(prefix + n) for n, c in box._asdict().items()]


@query("fn_tile_bounds", f"""
    SELECT seq, round(x / power(2, z) * 360.0 - 180.0, 9) AS minx, round(greatest({LAT.format(row='y + 1')}, -85.0511287798066), 9) AS miny,
           round((x + 1) / power(2, z) * 360.0 - 180.0, 9) AS maxx, round(least({LAT.format(row='y')}, 85.0511287798066), 9) AS maxy,
           round({LAT.format(row='y + 1')}, 9) AS raw_miny
    FROM {{fx_tiles}}""")
def _(v):
    return v.fx_tiles.select(
        "seq",
        *rounded(G.tile_bounds("z", "x", "y")),
        F.round(G.tile_bounds("z", "x", "y", clamp_lat=False).miny, 9).alias("raw_miny"),
    )


@query("fn_tile_bounds_merc", """
    SELECT seq, round(-20037508.342789244 + x * (40075016.685578488 / power(2, z)), 6) AS minx,
           round(20037508.342789244 - y * (40075016.685578488 / power(2, z)) - 40075016.685578488 / power(2, z), 6) AS miny,
           round(-20037508.342789244 + x * (40075016.685578488 / power(2, z)) + 40075016.685578488 / power(2, z), 6) AS maxx,
           round(20037508.342789244 - y * (40075016.685578488 / power(2, z)), 6) AS maxy FROM {fx_tiles}""")
def _(v):
    return v.fx_tiles.select("seq", *rounded(G.tile_bounds_merc("z", "x", "y"), 6))


@query("fn_tile_center", f"""
    SELECT seq, round((x + 0.5) / power(2, z) * 360.0 - 180.0, 9) AS lon, round({LAT.format(row='y + 0.5')}, 9) AS lat
    FROM {{fx_tiles}}""")
def _(v):
    lon, lat = G.tile_center("z", "x", "y")
    return v.fx_tiles.select("seq", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


ROW = "(1.0 - asinh(tan(radians({lat}))) / pi()) / 2.0 * power(2, {z})"


def clip(value, z):
    return f"CAST(greatest(0, least(power(2, {z}) - 1, floor({value}))) AS BIGINT)"


@query("fn_lonlat_to_tile", f"""
    SELECT event_id, {clip('(lon + 180.0) / 360.0 * power(2, 10)', '10')} AS x,
           {clip(ROW.format(lat='greatest(-85.0511287798066, least(85.0511287798066, lat))', z='10'), '10')} AS y
    FROM {{fx_points}}""")
def _(v):
    x, y = G.lonlat_to_tile("lon", "lat", 10)
    return v.fx_points.select("event_id", x.alias("x"), y.alias("y"))


def _range_sql(mode):
    limit = {"inset": 85.05112878, "plain": 85.0511, "corner": 85.0511287798066}[mode]
    west, east = "greatest(-180.0, least(180.0, minx))", "greatest(-180.0, least(180.0, maxx))"
    south, north = (f"greatest(-{limit}, least({limit}, {c}))" for c in ("miny", "maxy"))
    if mode == "inset":
        west, east = f"least({west}, {east})", f"greatest({west}, {east}) - 1e-9"
        south, north = f"least({south}, {north})", f"greatest({south}, {north}) - 1e-9"
    if mode == "corner":
        west, east = "minx", "maxx"
    lo = lambda lon: clip(f"({lon} + 180.0) / 360.0 * power(2, z)", "z")
    la = lambda lat: clip(ROW.format(lat=f"greatest(-{limit}, least({limit}, {lat}))", z="z"), "z")
    xmax, ymax = lo(east), la(south)
    if mode == "plain":
        xmax = f"CASE WHEN {east} < {west} OR {north} < {south} THEN -1 ELSE {xmax} END"
        ymax = f"CASE WHEN {east} < {west} OR {north} < {south} THEN -1 ELSE {ymax} END"
    return f"SELECT '{mode}' AS mode, box_id, {lo(west)} AS xmin, {xmax} AS xmax, {la(north)} AS ymin, {ymax} AS ymax FROM {{fx_boxes}}"


@query("fn_tile_range", " UNION ALL ".join(_range_sql(m) for m in ("inset", "plain", "corner")))
def _(v):
    def one(mode):
        span = G.tile_range("minx", "miny", "maxx", "maxy", "z", mode)
        return v.fx_boxes.select(
            F.lit(mode).alias("mode"), "box_id", *[c.alias(n) for n, c in span._asdict().items()]
        )

    return one("inset").unionByName(one("plain")).unionByName(one("corner"))


@query("fn_ancestor", """
    SELECT seq, x >> (z - 4) AS ax, y >> (z - 4) AS ay, x - ((x >> (z - 4)) << (z - 4)) AS sx,
           y - ((y >> (z - 4)) << (z - 4)) AS sy FROM {fx_tiles}""")
def _(v):
    ax, ay = G.ancestor("z", "x", "y", 4)
    sx, sy = G.sub_position("z", "x", "y", 4)
    return v.fx_tiles.select("seq", ax.alias("ax"), ay.alias("ay"), sx.alias("sx"), sy.alias("sy"))


@query("fn_tms_flip", "SELECT seq, CAST(power(2, z) AS BIGINT) - 1 - y AS tms_row FROM {fx_tiles}")
def _(v):
    return v.fx_tiles.select("seq", G.tms_flip("z", "y").alias("tms_row"))


@query("fn_bbox_from_point", """
    SELECT event_id, round(CASE WHEN w > 0 THEN greatest(-180.0, lon - w / 2.0 / greatest(1e-6, 111320.0 * cos(radians(lat)))) END, 9) AS minx,
           round(CASE WHEN w > 0 THEN greatest(-90.0, lat - 1500.0 / 2.0 / 111320.0) END, 9) AS miny,
           round(CASE WHEN w > 0 THEN least(180.0, lon + w / 2.0 / greatest(1e-6, 111320.0 * cos(radians(lat)))) END, 9) AS maxx,
           round(CASE WHEN w > 0 THEN least(90.0, lat + 1500.0 / 2.0 / 111320.0) END, 9) AS maxy
    FROM (SELECT *, (event_id % 40 - 1) * 1000.0E0 AS w FROM {fx_points}) AS p""")
def _(v):
    width = (F.col("event_id") % 40 - 1) * 1000.0
    return v.fx_points.select("event_id", *rounded(G.box_from_point("lon", "lat", width, 1500.0)))


@query("fn_bbox_buffer", """
    SELECT box_id, round(CASE WHEN km > 0 THEN greatest(minx - d, -180.0) ELSE minx END, 9) AS minx,
           round(CASE WHEN km > 0 THEN greatest(miny - km / 111.32, -90.0) ELSE miny END, 9) AS miny,
           round(CASE WHEN km > 0 THEN least(maxx + d, 180.0) ELSE maxx END, 9) AS maxx,
           round(CASE WHEN km > 0 THEN least(maxy + km / 111.32, 90.0) ELSE maxy END, 9) AS maxy
    FROM (SELECT *, km / 111.32 / greatest(cos(radians((miny + maxy) / 2.0)), 0.01) AS d
          FROM (SELECT *, (box_id % 30 - 2) * 5.0E0 AS km FROM {fx_boxes}) AS a) AS b""")
def _(v):
    km = (F.col("box_id") % 30 - 2) * 5.0
    return v.fx_boxes.select("box_id", *rounded(G.box_buffer("minx", "miny", "maxx", "maxy", km)))


@query("fn_bbox_normalize", """
    SELECT box_id, printf('%.6f,%.6f,%.6f,%.6f', least(minx, maxx), least(miny, maxy), greatest(minx, maxx), greatest(miny, maxy)) AS bbox
    FROM {fx_boxes}""")
def _(v):
    box = G.box_normalize("minx", "miny", "maxx", "maxy")
    return v.fx_boxes.select("box_id", G.box_text(*box).alias("bbox"))


@query("fn_bbox_intersects", """
    SELECT box_id, minx <= 60.5 AND maxx >= -10.5 AND miny <= 45.5 AND maxy >= -20.5 AS hit FROM {fx_boxes}""")
def _(v):
    box = G.Box("minx", "miny", "maxx", "maxy")
    hit = G.boxes_intersect(box, G.Box(-10.0, -20.0, 60.0, 45.0), 0.5)
    return v.fx_boxes.select("box_id", hit.alias("hit"))


@query("fn_bbox_covers", """
    SELECT item_id, minx <= -20.5 AND maxx >= -20.0 AND miny <= 10.0 AND maxy >= 10.5 AS covers,
           minx <= mx AND maxx >= mx + 1 AND miny <= my AND maxy >= my + 1 AS covers_own
    FROM (SELECT *, floor(minx / 3) * 3.0 AS mx, floor(miny / 2) * 2.0 AS my FROM {fx_scenes}) AS s""")
def _(v):
    box = G.Box("minx", "miny", "maxx", "maxy")
    mx, my = F.floor(F.col("minx") / 3) * 3.0, F.floor(F.col("miny") / 2) * 2.0
    return v.fx_scenes.select(
        "item_id",
        G.box_covers(box, G.Box(-20.5, 10.0, -20.0, 10.5)).alias("covers"),
        G.box_covers(box, G.Box(mx, my, mx + 1, my + 1)).alias("covers_own"),
    )


@query("fn_bbox_center", """
    SELECT box_id, round(0.5 * (minx + maxx), 9) AS lon, round(0.5 * (miny + maxy), 9) AS lat FROM {fx_boxes}""")
def _(v):
    lon, lat = G.box_center("minx", "miny", "maxx", "maxy")
    return v.fx_boxes.select("box_id", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query("fn_zoom_resolution", """
    SELECT seq, round(156543.03392804097 / power(2, z), 9) AS resolution FROM {fx_tiles}""")
def _(v):
    return v.fx_tiles.select("seq", F.round(G.zoom_resolution("z"), 9).alias("resolution"))


@query("fn_gsd_to_zoom", """
    SELECT image_id, CASE WHEN gsd IS NULL OR gsd <= 0 THEN 24
           ELSE CAST(greatest(0, least(24, floor(log2(156543.03392804097 / gsd)))) AS INT) END AS zoom
    FROM {fx_images}""")
def _(v):
    return v.fx_images.select("image_id", G.gsd_to_zoom("gsd").alias("zoom"))


QUADRANT = f"""CASE WHEN floor({LAT.format(row='y + 0.5')} * 1.5) >= 62 THEN 'north'
    WHEN floor((x + 0.5) / power(2, z) * 360.0 - 180.0) - 100 >= 38 THEN 'east'
    WHEN floor((x + 0.5) / power(2, z) * 360.0 - 180.0) - 100 <= 32 THEN 'south' ELSE 'west' END"""


@query("fn_quadrant_of_tile", f"SELECT seq, {QUADRANT} AS quadrant FROM {{fx_tiles}}")
def _(v):
    return v.fx_tiles.select("seq", G.quadrant_of_tile("z", "x", "y").alias("quadrant"))


SHARDS = "(VALUES " + ", ".join(
    f"('{i:02d}', {a}, {b}, {c}, {d})" for i, (a, b, c, d) in enumerate(C.SHARD_RECTANGLES)
) + ") AS s(shard, x0, y0, x1, y1)"


@query("fn_shard_of_tile", f"""
    SELECT seq, shard FROM {{fx_tiles}} LEFT JOIN {SHARDS}
      ON (x >> (z - 6)) BETWEEN x0 AND x1 AND (y >> (z - 6)) BETWEEN y0 AND y1
    UNION ALL SELECT seq, NULL FROM {{fx_tiles}}""")
def _(v):
    low = v.fx_tiles.select("seq", G.shard_of_tile(F.lit(5), "x", "y").alias("shard"))
    return v.fx_tiles.select("seq", G.shard_of_tile("z", "x", "y").alias("shard")).unionByName(low)


@query("fn_shard_bbox", f"""
    SELECT seq, round(x0 / 64.0 * 360.0 - 180.0, 9) AS minx, round(degrees(atan(sinh(pi() * (1.0 - 2.0 * (y1 + 1) / 64.0)))), 9) AS miny,
           round((x1 + 1) / 64.0 * 360.0 - 180.0, 9) AS maxx, round(degrees(atan(sinh(pi() * (1.0 - 2.0 * y0 / 64.0)))), 9) AS maxy
    FROM {{fx_tiles}} JOIN {SHARDS} ON (x >> (z - 6)) BETWEEN x0 AND x1 AND (y >> (z - 6)) BETWEEN y0 AND y1""")
def _(v):
    from tessella.plans.planning import shard_boxes

    tagged = v.fx_tiles.select("seq", G.shard_of_tile("z", "x", "y").alias("shard"))
    return tagged.join(shard_boxes(v.spark), "shard").select(
        "seq", *[F.round(n, 9).alias(n) for n in ("minx", "miny", "maxx", "maxy")]
    )


@query("fn_shard_id_norm", """
    SELECT c_custkey, CASE WHEN trim(raw) = '' THEN NULL WHEN regexp_matches(trim(raw), '^[0-9]+$') AND length(trim(raw)) < 2
           THEN lpad(trim(raw), 2, '0') ELSE trim(raw) END AS shard
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE concat(' ', c_custkey % 120) END AS raw FROM {customer}) AS t""")
def _(v):
    raw = v.sql("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 5 = 0 THEN c_mktsegment
                   ELSE concat(' ', c_custkey % 120) END AS raw FROM {customer}""")
    return raw.select("c_custkey", S.shard_id("raw").alias("shard"))


@query("fn_modis_tile_polygon", """
    SELECT o_orderkey, i AS corner, CASE WHEN abs(degrees(lat)) < 89.999 THEN round(degrees((CASE WHEN i IN (1, 2) THEN h + 1 ELSE h END * 1111950.5196666666 - 1111950.5196666666 * 36 / 2.0) / (6371007.181 * c)), 7) END AS lon,
           round(degrees(lat), 7) AS lat
    FROM (SELECT *, CASE WHEN abs(cos(lat)) < 1e-12 THEN CASE WHEN cos(lat) >= 0 THEN 1e-12 ELSE -1e-12 END ELSE cos(lat) END AS c
          FROM (SELECT *, (1111950.5196666666 * 18 / 2.0 - CASE WHEN i IN (2, 3) THEN v + 1 ELSE v END * 1111950.5196666666) / 6371007.181 AS lat
                FROM (SELECT o_orderkey, o_custkey % 40 AS h, o_custkey % 20 AS v FROM {orders}) AS o, (VALUES (0), (1), (2), (3), (4)) AS t(i)
                WHERE h < 36 AND v < 18) AS a) AS b""")
def _(v):
    tiles = v.sql("""SELECT o_orderkey, concat('h', lpad(CAST(o_custkey % 40 AS STRING), 2, '0'), 'v', lpad(CAST(o_custkey % 20 AS STRING), 2, '0')) AS tile
                     FROM {orders}""")
    return tiles.select("o_orderkey", F.posexplode(S.sinusoidal_ring("tile")).alias("corner", "p")).select(
        "o_orderkey",
        "corner",
        # at the poles longitude has no meaning
        F.when(F.abs("p.lat") < 89.999, F.round("p.lon", 7)).alias("lon"),
        F.round("p.lat", 7).alias("lat"),
    )


PRODUCT = """
    SELECT *, date_ok AND tile_ok AS ok FROM (
      SELECT product_id, split_part(product_id, '_', 1) AS family, o_orderkey, o_orderstatus, split_part(product_id, '_', 3) AS code, split_part(product_id, '_', 4) AS tile,
             regexp_matches(split_part(product_id, '_', 3), '^[0-9]{7}$')
               AND TRY_CAST(substr(split_part(product_id, '_', 3), 5, 3) AS INT) BETWEEN 1 AND
                   CASE WHEN TRY_CAST(substr(split_part(product_id, '_', 3), 1, 4) AS INT) % 4 = 0 THEN 366 ELSE 365 END AS date_ok,
             split_part(product_id, '_', 4) LIKE 'h%v%' AS tile_ok
      FROM {fx_products} WHERE starts_with(product_id, 'modis_mcd43a4_') OR starts_with(product_id, 'viirs_vnp09ga_')) AS p"""


@query("fn_product_id_parse", f"""
    SELECT product_id, make_date(CAST(substr(code, 1, 4) AS INT), 1, 1) + (CAST(substr(code, 5, 3) AS INT) - 1) AS acquired, tile
    FROM ({PRODUCT}) AS q WHERE ok""")
def _(v):
    acquired, tile = S.product_parts("product_id", "modis_mcd43a4_", "viirs_vnp09ga_")
    return pinned(v.fx_products.select("product_id"), acquired=acquired, tile=tile).dropna()


@query("fn_season_window", """
    SELECT event_id, CASE WHEN lat >= 0 THEN 'northern_growing_season' ELSE 'southern_growing_season' END AS season,
           CASE WHEN lat >= 0 THEN 'north' ELSE 'south' END AS hemisphere,
           CASE WHEN lat >= 0 THEN DATE '2024-04-01' ELSE DATE '2023-10-01' END AS start_date,
           CASE WHEN lat >= 0 THEN DATE '2024-10-31' ELSE DATE '2024-04-30' END AS end_date FROM {fx_points}""")
def _(v):
    season, hemisphere, start, end = S.season_window("lat", 2024)
    return v.fx_points.select(
        "event_id", season.alias("season"), hemisphere.alias("hemisphere"),
        start.alias("start_date"), end.alias("end_date"),
    )


@query("fn_qa_mask_value", """
    SELECT o_orderkey, CAST((CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 0 END) | (CASE WHEN o_orderkey % 3 = 0 THEN 8 ELSE 0 END)
           | (CASE WHEN o_orderkey % 5 = 0 THEN 16 ELSE 0 END) AS INT) AS mask FROM {orders}""")
def _(v):
    k = F.col("o_orderkey")
    flags = F.array(
        F.when(k % 2 == 0, " Cloud ").otherwise("unknown"),
        F.when(k % 3 == 0, "CLOUD_SHADOW").otherwise(""),
        F.when(k % 5 == 0, "snow_ice").otherwise("none"),
        F.when(k % 5 == 0, "snow").otherwise("none"),
    )
    return v.orders.select("o_orderkey", S.qa_mask(flags).alias("mask"))


@query("fn_url_strip", "SELECT page_id, regexp_replace(concat(url, '?a=', page_id, '#top'), '[?#].*$', '') AS url FROM {pages}")
def _(v):
    url = F.concat("url", F.lit("?a="), "page_id", F.lit("#top"))
    return v.pages.select("page_id", S.strip_query(url).alias("url"))


@query("fn_url_sign", """
    SELECT page_id, concat(split_part(url, '#', 1), CASE WHEN contains(split_part(url, '#', 1), '?') THEN '&' ELSE '?' END, 'sig=', page_id,
           CASE WHEN contains(url, '#') THEN concat('#', split_part(url, '#', 2)) ELSE '' END) AS url
    FROM (SELECT page_id, concat(split_part(split_part(url, '#', 1), '?', 1), CASE WHEN page_id % 2 = 0 THEN '?v=1' ELSE '' END, CASE WHEN page_id % 3 = 0 THEN '#part' ELSE '' END) AS url FROM {pages}) AS p""")
def _(v):
    url = F.concat(
        S.strip_query("url"),
        F.when(F.col("page_id") % 2 == 0, "?v=1").otherwise(""),
        F.when(F.col("page_id") % 3 == 0, "#part").otherwise(""),
    )
    return v.pages.select("page_id", S.sign_url(url, F.concat(F.lit("?sig="), "page_id")).alias("url"))


@query("fn_url_tile", """
    SELECT seq, concat('https://t.example.org/photo/', z, '/', x, '/', y, '.jpg') AS url FROM {fx_tiles}""")
def _(v):
    template = F.lit("https://t.example.org/photo/{z}/{x}/{y}.jpg")
    return v.fx_tiles.select("seq", S.tile_url(template, "z", "x", "y").alias("url"))


@query("fn_url_refresh", """
    SELECT item_id, b.band AS band, concat('https://s/', item_id, '/', b.band, '.tif?', collection_id, '=new') AS href,
           CASE WHEN has_qa THEN concat('https://s/', item_id, '/Fmask.tif?', collection_id, '=new') END AS qa_href
    FROM {fx_scenes} CROSS JOIN (VALUES ('B02'), ('B03')) AS b(band)""")
def _(v):
    from tessella.sources.records import refresh_urls

    href = lambda band: F.concat(F.lit("https://s/"), "item_id", F.lit(f"/{band}.tif?old=1#x"))
    scenes = v.fx_scenes.select(
        "item_id",
        "collection_id",
        F.create_map(F.lit("B02"), href("B02"), F.lit("B03"), href("B03")).alias("bands"),
        F.when(F.col("has_qa"), href("Fmask")).alias("qa_href"),
    )
    tokens = v.fx_scenes.select("collection_id").distinct().withColumn(
        "token", F.concat(F.lit("?"), "collection_id", F.lit("=new"))
    )
    fresh = refresh_urls(scenes, tokens)
    return fresh.select("item_id", F.explode("bands").alias("band", "href"), "qa_href")


@query("fn_cache_key", """
    SELECT image_id, concat(substr(sha1(url), 1, 12), '_', regexp_replace(regexp_replace(split_part(url, '?', 1), '^.*/', ''), '\\.[^.]+$', ''), '.tif') AS name,
           sha256(concat_ws('|', 'v2', printf('%.5f', minx), printf('%.5f', miny), printf('%.5f', maxx), printf('%.5f', maxy))) AS search
    FROM {fx_images}""")
def _(v):
    box = [S.fixed5(n) for n in ("minx", "miny", "maxx", "maxy")]
    return v.fx_images.select(
        "image_id", S.cache_name("url").alias("name"), S.search_key(F.lit("v2"), *box).alias("search")
    )


@query("fn_recency_key", """
    SELECT image_id, row_number() OVER (PARTITION BY family ORDER BY gsd NULLS LAST, acquisition_start DESC NULLS FIRST, image_id) AS rank
    FROM {fx_images}""")
def _(v):
    from tessella.operators.ranking import ranked_in_group

    order = [F.col("gsd").asc_nulls_last(), F.col("acquisition_start").desc_nulls_first(), F.col("image_id")]
    ranked = ranked_in_group(v.fx_images, ["family"], order, "rank")
    return ranked.select("image_id", F.col("rank").cast("bigint").alias("rank"))


@query("fn_slug", """
    SELECT doc_id, CASE WHEN s = '' THEN 'layer' ELSE s END AS slug
    FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM {documents}) AS d
    UNION ALL SELECT p_partkey, trim(regexp_replace(lower(concat('-', p_name, '/', p_type, '!')), '[^a-z0-9]+', '_', 'g'), '_') FROM {part}""")
def _(v):
    layers = v.part.select(
        F.col("p_partkey").alias("doc_id"),
        S.slug(F.concat(F.lit("-"), "p_name", F.lit("/"), "p_type", F.lit("!"))).alias("slug"),
    )
    return v.documents.select("doc_id", S.slug("text").alias("slug")).unionByName(layers)


@query("fn_format_map", """
    SELECT p_partkey, m, CASE m WHEN 'image/jpeg' THEN 'jpg' WHEN 'image/jpg' THEN 'jpg' WHEN 'image/png' THEN 'png' WHEN 'image/webp' THEN 'webp' WHEN 'image/' THEN 'bin' ELSE 'tiff' END AS ext,
           CASE WHEN m IN ('image/jpeg', 'image/jpg') THEN 'JPEG' ELSE 'DEFLATE' END AS compression
    FROM (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/jpg' WHEN 2 THEN 'image/png' WHEN 3 THEN 'image/webp' WHEN 4 THEN 'image/' ELSE 'image/tiff' END AS m FROM {part}) AS t""")
def _(v):
    types = v.sql("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/jpg' WHEN 2 THEN 'image/png'
                     WHEN 3 THEN 'image/webp' WHEN 4 THEN 'image/' ELSE 'image/tiff' END AS m FROM {part}""")
    return types.select(
        "p_partkey", "m", S.media_extension("m").alias("ext"), S.media_compression("m").alias("compression")
    )


@query("fn_meta_center", """
    SELECT box_id, printf('%.6f', (minx + maxx) / 2.0) AS lon, printf('%.6f', (miny + maxy) / 2.0) AS lat,
           CAST(2 + (z - 2) // 2 AS INT) AS zoom FROM {fx_boxes}""")
def _(v):
    lon, lat, zoom = S.meta_center(("minx", "miny", "maxx", "maxy"), 2, "z")
    return v.fx_boxes.select(
        "box_id",
        F.format_string("%.6f", lon).alias("lon"),
        F.format_string("%.6f", lat).alias("lat"),
        zoom.cast("int").alias("zoom"),
    )


@query("fn_parse_time", """
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS instant, TRY_CAST(num AS DOUBLE) AS cloud
    FROM (SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 101 AS VARCHAR) END AS num FROM {events}) AS e""")
def _(v):
    text = v.sql("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'soon' ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END AS t,
                    CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 101 AS STRING) END AS num FROM {events}""")
    return text.select(
        "event_id", F.unix_seconds(S.to_instant("t")).alias("instant"), S.to_number("num").alias("cloud")
    )


@query("fn_layer_defaults", """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'SurfReflect_I1,SurfReflect_I2,SurfReflect_I3,SurfReflect_QC_I1,SurfReflect_QC_I2,SurfReflect_QC_I3'
           ELSE 'SurfReflect_I1_1,SurfReflect_I2_1,SurfReflect_I3_1' END AS layers FROM {part}""")
def _(v):
    product = F.concat(F.lit("VNP09GA.00"), (F.col("p_size") % 3 + 1).cast("string"))
    return v.part.select("p_partkey", F.array_join(S.default_layers(product), ",").alias("layers"))
